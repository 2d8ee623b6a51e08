"""Names of read and sequence files: sample, mate, format and compression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of paired read names, tried in this order; group 1 is the base, group 2 the mate
PAIR_PATTERNS = (
    r"(.+)_(R[12])_\d+$",
    r"(.+)_\d+_([12])$",
    r"(.+)_([12])_\d+$",
    r"(.+)_(R[12])_[A-Za-z0-9_]+$",
    r"(.+)_([12])_[A-Za-z0-9_]+$",
    r"(.+)(R[12])_[A-Za-z0-9_]+$",
    r"(.+)_(R[12])$",
    r"(.+)_([12])$",
    r"(.+)\.(R[12])$",
    r"(.+)\.([12])$",
    r"(.+)(R[12])$",
)
# The sample a read file belongs to
SAMPLE_PATTERN = r"^(.+?)(?:[_\.](S[0-9]+_L[0-9]+_)?(R[12]|[12]))?\.f(ast)?q\.gz$"

# Spellings of compressions and formats
CODINGS = {"gz": "GZIP", "gzip": "GZIP", "bz2": "BZIP2", "bzip2": "BZIP2"}
FORMATS = {
    "fa": "FASTA", "fasta": "FASTA", "fna": "FASTA", "genbank": "GENBANK", "gb": "GENBANK", "gbk": "GENBANK",
    "fq": "FASTQ", "fastq": "FASTQ", "bam": "BAM", "gff": "GFF", "gff3": "GFF", "gtf": "GTF", "gff2": "GTF", "bed": "BED",
}


def _last_suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1))


def coding(name: Column) -> Column:
    """GZIP, BZIP2 or NONE by the last suffix, whatever its case."""
    out = F.lit("NONE")
    for kind in ("GZIP", "BZIP2"):
        out = F.when(_last_suffix(name).isin(*(k for k, v in CODINGS.items() if v == kind)), kind).otherwise(out)
    return out


def _uncompressed(name: Column) -> Column:
    return F.when(coding(name) != "NONE", F.regexp_replace(name, r"\.[^./]+$", "")).otherwise(name)


def file_format(name: Column) -> Column:
    """The format by the suffix before the compression's; null for an unknown one."""
    suffix = _last_suffix(_uncompressed(name))
    out = F.lit(None).cast("string")
    for kind in dict.fromkeys(FORMATS.values()):
        out = F.when(suffix.isin(*(k for k, v in FORMATS.items() if v == kind)), kind).otherwise(out)
    return out


def base_name(name: Column) -> Column:
    """The name without its format suffix and, if it is compressed, that suffix too."""
    return F.regexp_replace(_uncompressed(name), r"\.[^./]+$", "")


def read_pair(base: Column) -> Column:
    """struct(base_name, read_number, detected): by the first pattern that fits; else the name itself and mate 1."""
    def first_fit(b: Column) -> Column:
        none = F.struct(b.alias("base_name"), F.lit(1).alias("read_number"), F.lit(False).alias("detected"))
        c = F.when(~b.rlike("[12]"), none)
        for p in PAIR_PATTERNS:
            mate = F.when(F.endswith(F.regexp_extract(b, "^" + p, 2), F.lit("1")), 1).otherwise(2)
            base_part = F.regexp_extract(b, "^" + p, 1)
            c = c.when(b.rlike("^" + p), F.struct(base_part.alias("base_name"), mate.alias("read_number"), F.lit(True).alias("detected")))
        return c.otherwise(none)

    # bound to a variable, so that the name is worked out once and not for every pattern
    return F.get(F.transform(F.array(base), first_fit), F.lit(0))


def sample_key(name: Column) -> Column:
    """The sample of a gzipped read file; null if the name is none."""
    return F.when(name.rlike(SAMPLE_PATTERN), F.regexp_extract(name, SAMPLE_PATTERN, 1))


def output_name(base: Column, suffix: str | None, fmt: str, coding_suffix: str = "", mate: Column | None = None) -> Column:
    """``base[_R<mate>][_suffix].fmt[.gz]``."""
    parts = [base]
    if mate is not None:
        parts.append(F.concat(F.lit("R"), mate.cast("string")))
    if suffix:
        parts.append(F.lit(suffix))
    return F.concat(F.concat_ws("_", *parts), F.lit(f".{fmt}{coding_suffix}"))
