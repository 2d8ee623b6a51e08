"""Sequence, read and annotation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuslathe.operators.prefix import running_rank

#: monotonically_increasing_id has the partition above these bits, so a tile of this width is a partition.
_PARTITION_BITS = 33
TRUST_READS = 10


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, seq_idx, id, description, seq) in file order; ``seq_idx`` rises within a file but has gaps.

    The file is split at record starts, so records of one file are read in parallel.
    """
    d = spark.read.option("lineSep", "\n>").text(path)
    d = d.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq_idx"), F.regexp_replace("value", "^>", "").alias("r"))
    d = d.where(F.trim("r") != "")
    head = F.regexp_replace(F.substring_index("r", "\n", 1), r"\s+$", "")
    body = F.when(F.col("r").contains("\n"), F.regexp_replace("r", r"^[^\n]*\n", "")).otherwise(F.lit(""))
    return d.select(
        "file", "seq_idx", F.regexp_extract(head, r"^(\S*)", 1).alias("id"), head.alias("description"),
        F.regexp_replace(body, r"\s", "").alias("seq"),
    )


def read_genbank(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, seq_idx, id, description, seq): version (or locus), definition and ORIGIN block of each record."""
    d = spark.read.option("lineSep", "\n//").text(path)
    d = d.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("seq_idx"), F.col("value").alias("r"))
    d = d.where(F.col("r").contains("LOCUS"))
    version, locus = F.regexp_extract("r", r"(?m)^VERSION\s+(\S+)", 1), F.regexp_extract("r", r"(?m)^\s*LOCUS\s+(\S+)", 1)
    definition = F.regexp_extract("r", r"(?ms)^DEFINITION\s+(.*?)^\S", 1)
    origin = F.regexp_extract("r", r"(?ms)^ORIGIN[^\n]*\n(.*)", 1)
    return d.select(
        "file", "seq_idx", F.coalesce(F.nullif(version, F.lit("")), locus).alias("id"),
        F.trim(F.regexp_replace(definition, r"\s+", " ")).alias("description"),
        F.upper(F.regexp_replace(origin, r"[^A-Za-z]", "")).alias("seq"),
    )


def read_fastq(spark: SparkSession, path: str | list[str], trust: bool = False) -> DataFrame:
    """(file, read_idx, id, description, seq, qual) of four-line records; with ``trust`` only the first ten of a file.

    Lines are numbered by the counts of the partitions before, so no partition waits for another to be read.
    """
    d = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("mid"), F.regexp_replace("value", "\r$", "").alias("line")
    )
    if trust:  # each partition keeps but its first lines before they are ranked
        first = F.row_number().over(Window.partitionBy("file").orderBy("mid"))
        d = d.withColumn("no", first - 1).where(F.col("no") < 4 * TRUST_READS)
    else:
        d = running_rank(d, ("file",), "mid", "no", _PARTITION_BITS)
    d = d.withColumns({"read_idx": F.expr("no div 4"), "part": F.expr("no % 4")})
    pick = lambda k: F.max(F.when(F.col("part") == k, F.col("line")))
    d = d.groupBy("file", "read_idx").agg(pick(0).alias("h"), pick(1).alias("seq"), pick(3).alias("qual"))
    head = F.regexp_replace("h", "^@", "")
    return d.select("file", "read_idx", F.regexp_extract(head, r"^(\S*)", 1).alias("id"), head.alias("description"), "seq", "qual")


def _line_no(lines: DataFrame) -> list[str]:
    return ["line_no"] if "line_no" in lines.columns else []


def parse_gff(lines: DataFrame) -> DataFrame:
    """Features of (value): blank and ``#`` lines, lines without nine fields and unreadable coordinates are left out.

    A ``line_no`` of the lines is kept.
    """
    f = F.split("value", "\t", -1)
    names = ("seqname", "source", "feature_type", "start", "end", "score", "strand", "frame", "attributes")
    d = lines.where(~F.col("value").startswith("#") & (F.size(f) == 9))
    d = d.select(*(F.trim(F.get(f, F.lit(i))).alias(n) for i, n in enumerate(names)), *_line_no(lines))
    return d.withColumns({c: F.col(c).try_cast("long") for c in ("start", "end")}).where("start is not null and end is not null")


def read_gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_gff(spark.read.text(path))


def parse_bed(lines: DataFrame) -> DataFrame:
    """Features of (value) in 0-based half-open columns, given 1-based inclusive coordinates; ``line_no`` is kept."""
    f = F.split("value", "\t", -1)
    part = lambda i, d: F.coalesce(F.get(f, F.lit(i)), F.lit(d))
    d = lines.where(~F.col("value").rlike("^(#|track|browser)") & (F.size(f) >= 3))
    return d.select(
        part(0, "").alias("seqname"), F.lit("bed").alias("source"), F.lit("region").alias("feature_type"),
        (part(1, "").try_cast("long") + 1).alias("start"), part(2, "").try_cast("long").alias("end"),
        part(4, ".").alias("score"), part(5, ".").alias("strand"), F.lit(".").alias("frame"),
        F.concat(F.lit("ID="), part(3, "region")).alias("attributes"), *_line_no(lines),
    ).where("start is not null and end is not null")


def gtf_to_gff3(features: DataFrame) -> DataFrame:
    """GTF attributes (key "value";) as GFF3 (key=value;), with the transcript or gene as ID."""
    pairs = F.regexp_replace(F.regexp_replace("attributes", r'\s*([A-Za-z_]\w*)\s+"([^"]*)"\s*;?', "$1=$2;"), ";$", "")
    own = F.coalesce(
        F.nullif(F.regexp_extract("attributes", r'transcript_id "([^"]+)"', 1), F.lit("")),
        F.nullif(F.regexp_extract("attributes", r'gene_id "([^"]+)"', 1), F.lit("")),
    )
    return features.withColumn("attributes", F.when(own.isNotNull(), F.concat(F.lit("ID="), own, F.lit(";"), pairs)).otherwise(pairs))
