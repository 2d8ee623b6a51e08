"""Validation of the input files of a run, over DataFrames: settings, validators, checks between files, parameters."""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import asdict, dataclass, fields, replace
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locuslathe import errors as X
from locuslathe.functions.names import CODINGS, read_pair
from locuslathe.operators import features as FT
from locuslathe.operators import genomes as G
from locuslathe.operators import reads as R
from locuslathe.operators import sequences as S
from locuslathe.sinks import files as K
from locuslathe.sources import sequences as SRC
from locuslathe.sources.config import InputFile
from locuslathe.sources.tables import numbered_lines

#: Features and reads that the trust level looks at.
SAMPLE = 10


@dataclass(frozen=True)
class Settings:
    """Unchangeable; ``update`` gives a changed copy. Unknown names raise ValueError."""

    coding_type: str | None = "NONE"
    output_filename_suffix: str | None = None
    output_subdir_name: str | None = None

    def __post_init__(self) -> None:
        c = (self.coding_type or "none").lower()
        object.__setattr__(self, "coding_type", CODINGS.get(c, "NONE"))

    def update(self, **changes: Any) -> Settings:
        unknown = set(changes) - {f.name for f in fields(self)}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        return replace(self, **changes)

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> Settings:
        return cls().update(**values)


@dataclass(frozen=True)
class GenomeSettings(Settings):
    allow_empty_sequences: bool = False
    allow_empty_id: bool = False
    is_plasmid: bool = False
    plasmid_split: bool = False
    plasmids_to_one: bool = False
    main_longest: bool = True
    main_first: bool = False
    replace_id_with: str | None = None
    replace_id_with_incremental: str | None = None
    min_sequence_length: int = 100

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.plasmid_split and self.plasmids_to_one:
            raise ValueError("plasmid_split and plasmids_to_one exclude each other")
        if self.main_longest and self.main_first:
            raise ValueError("main_longest and main_first exclude each other")


@dataclass(frozen=True)
class ReadSettings(Settings):
    check_invalid_chars: bool = False
    allow_empty_id: bool = False
    allow_duplicate_ids: bool = True
    ignore_bam: bool = True
    outdir_by_ngs_type: bool = False


@dataclass(frozen=True)
class FeatureSettings(Settings):
    sort_by_position: bool = True
    check_coordinates: bool = True
    replace_id_with: str | None = None


@dataclass
class Result:
    """What a validator found: the edited rows, further outputs by name, issues (level, message) and one metadata row."""

    data: DataFrame | None
    outputs: dict[str, DataFrame]
    issues: DataFrame | None
    metadata: dict[str, Any]

    def raise_on_error(self, kind: type[X.ValidationError]) -> Result:
        first = self.issues.where("level = 'ERROR'").head(1) if self.issues is not None else []
        if first:
            raise kind(first[0]["message"])
        return self


class BaseValidator(ABC):
    """``run`` checks the file, then reads, checks, edits and describes its rows by what the subclasses define."""

    def __init__(self, spark: SparkSession, file: InputFile, settings: Settings):
        self.spark, self.file, self.settings = spark, file, settings

    @property
    @abstractmethod
    def formats(self) -> tuple[str, ...]: ...

    @property
    @abstractmethod
    def error(self) -> type[X.ValidationError]: ...

    @abstractmethod
    def read(self) -> DataFrame: ...

    @abstractmethod
    def check(self, rows: DataFrame) -> DataFrame | None: ...

    @abstractmethod
    def edit(self, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]: ...

    @abstractmethod
    def describe(self, rows: DataFrame) -> dict[str, Any]: ...

    @abstractmethod
    def write(self, result: Result, folder: Path) -> dict[str, Any]:
        """Writes the outputs below ``folder``; what there is to know of them (output_file and the like)."""

    #: the suffix of the output's format
    extension: str

    @property
    def base(self) -> str:
        """The input's name without its suffixes."""
        return self.file.path.name.split(".", 1)[0] or self.file.path.name

    def folder(self, out: Path) -> Path:
        return out / self.settings.output_subdir_name if self.settings.output_subdir_name else out

    def target(self, out: Path, base: str | None = None, tail: str = "") -> Path:
        """``base[_suffix][tail].extension[.coding]`` in the folder of the settings."""
        stem = "_".join(x for x in (base or self.base, self.settings.output_filename_suffix) if x)
        return self.folder(out) / f"{stem}{tail}.{self.extension}{K.SUFFIXES[self.settings.coding_type]}"

    def write_minimal(self, out: Path) -> dict[str, Any]:
        """The file as it is, byte by byte."""
        return self._copied(self.target(out), self.file.coding)

    def _copied(self, target: Path, coding: str) -> dict[str, Any]:
        K.copy_files(self.spark, [(str(self.file.path), str(target), self.file.coding, coding)])
        return {"output_file": str(target), "output_filename": target.name}

    @property
    def level(self) -> str:
        return self.file.options.validation_level

    def run(self, raise_on_error: bool = True, out: str | Path | None = None) -> Result:
        """Checks, edits and describes the file; with ``out`` its outputs are written below that folder, too."""
        result = self._examine(raise_on_error)
        if out is not None:
            write = self.write_minimal(Path(out)) if result.data is None else self.write(result, Path(out))
            result.metadata |= write | {"validation_level": self.level}
        return result

    def _examine(self, raise_on_error: bool) -> Result:
        if not Path(self.file.path).is_file():
            raise X.InputFileNotFoundError(str(self.file.path))
        if self.file.fmt not in self.formats:
            raise X.FileFormatError(f"{self.file.path} is no {' or '.join(self.formats)} file")
        if self.level == "minimal":
            self.check_minimal()
            return Result(None, {}, None, {"input_file": str(self.file.path)})
        rows = self.read()
        issues = self.check(rows)
        if raise_on_error:
            Result(rows, {}, issues, {}).raise_on_error(self.error)
        data, outputs = self.edit(rows)
        return Result(data, outputs, issues, {"input_file": str(self.file.path)} | self.describe(data))

    def check_minimal(self) -> None:
        """Nothing is read; the file must already be as the output would be."""
        if self.file.coding != self.settings.coding_type:
            raise X.CompressionError(f"{self.file.path} is {self.file.coding}, not {self.settings.coding_type}")


class GenomeValidator(BaseValidator):
    extension = "fasta"
    formats = ("FASTA", "GENBANK")
    error = X.GenomeValidationError
    settings: GenomeSettings

    def read(self) -> DataFrame:
        read = SRC.read_fasta if self.file.fmt == "FASTA" else SRC.read_genbank
        rows = read(self.spark, str(self.file.path)).drop("file")
        if rows.isEmpty():
            raise (X.FastaFormatError if self.file.fmt == "FASTA" else X.GenBankFormatError)("No sequences found")
        return rows

    def _checked(self, rows: DataFrame) -> DataFrame:
        return rows.orderBy("seq_idx").limit(1) if self.level == "trust" else rows

    def check(self, rows: DataFrame) -> DataFrame:
        s = self.settings
        return S.check_ids(self._checked(rows), s.allow_empty_id, s.allow_empty_sequences)

    def fragmented(self, rows: DataFrame) -> bool:
        limit = self.file.n_sequence_limit
        return self.file.options.type == "eukaryote" or (limit is not None and rows.count() > limit)

    def edit(self, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        s = self.settings
        if self.fragmented(rows):
            return rows, {}
        d = S.filter_min_length(rows, s.min_sequence_length)
        if s.replace_id_with:
            d = S.replace_id(d, s.replace_id_with)
        if s.replace_id_with_incremental:
            d = S.replace_id_incremental(d, s.replace_id_with_incremental)
        if s.is_plasmid:
            return d.where("false"), {"plasmids": d}
        if not (s.plasmid_split or s.plasmids_to_one):
            return d, {}
        marked = S.mark_main(d, (), s.main_longest)
        rest = marked.where("not is_main").drop("is_main").orderBy(F.length("seq").desc(), "seq_idx")
        return marked.where("is_main").drop("is_main"), {"plasmids": rest}

    def describe(self, rows: DataFrame) -> dict[str, Any]:
        return S.sequence_stats(rows).head().asDict() | {"fragmented": self.fragmented(rows)}

    def write(self, result: Result, folder: Path) -> dict[str, Any]:
        s, codec = self.settings, K.CODECS[self.settings.coding_type]
        save = lambda rows, target: K.as_file(lambda f: K.write_fasta(rows, f, codec), target)
        out: dict[str, Any] = {"output_file": None, "output_filename": None}
        if result.metadata["num_sequences"]:
            target = self.target(folder)
            out |= {"output_file": save(result.data, target), "output_filename": target.name}
        plasmids = result.outputs.get("plasmids")
        n = plasmids.count() if plasmids is not None else 0
        if not n:
            return out
        infix = "" if s.is_plasmid and s.output_filename_suffix else "_plasmid"
        if not s.is_plasmid:  # the longest first; they are few, as a genome of more sequences than its limit isn't edited
            longest = Window.orderBy(F.length("seq").desc(), "seq_idx")
            plasmids = plasmids.withColumn("seq_idx", F.row_number().over(longest).cast("long"))
        if s.plasmid_split:
            name = lambda i: self.target(folder, tail=f"{infix}{i}").name
            targets = [Path(t) for t in K.write_each(plasmids, str(self.folder(folder)), name, s.coding_type)]
        else:
            targets = [self.target(folder, tail=infix)]
            save(plasmids, targets[0])
        if s.is_plasmid:  # the plasmids are what the file is about
            out |= {"output_file": str(targets[0]), "output_filename": targets[0].name}
        return out | {"plasmid_count": n, "plasmid_filenames": [t.name for t in targets]}


class ReadValidator(BaseValidator):
    extension = "fastq"
    formats = ("FASTQ", "BAM")
    error = X.ReadValidationError
    settings: ReadSettings

    def read(self) -> DataFrame:
        if self.file.fmt == "BAM":  # passed on as it is
            return self.spark.createDataFrame([], "file string, read_idx long, id string, description string, seq string, qual string")
        return SRC.read_fastq(self.spark, str(self.file.path))

    def _checked(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("read_idx") < SAMPLE) if self.level == "trust" else rows

    def check_minimal(self) -> None:
        super().check_minimal()
        r = R.fastq_read_count(self.spark.read.text(str(self.file.path))).head()
        if self.file.fmt == "FASTQ" and not r["valid"]:
            raise X.FastqFormatError(f"Invalid FASTQ: {r['num_lines']} lines not divisible by 4")

    def check(self, rows: DataFrame) -> DataFrame:
        s = self.settings
        rows = self._checked(rows)
        parts = []
        if not s.allow_empty_id:
            parts.append(rows.where("coalesce(id, '') = ''").select(F.lit("Sequence has no ID").alias("message")))
        if s.check_invalid_chars:
            parts.append(R.invalid_reads(rows).select(F.format_string("Contains %d invalid character(s): %s", "n_invalid", "characters").alias("message")))
        if not s.allow_duplicate_ids:
            parts.append(R.duplicate_ids(rows).select(F.format_string("Duplicate sequence IDs not allowed: %s", "id").alias("message")))
        out = self.spark.createDataFrame([], "message string")
        for p in parts:
            out = out.unionByName(p)
        return out.select(F.lit("ERROR").alias("level"), "message")

    def edit(self, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        return rows, {}

    def folder(self, out: Path) -> Path:
        if self.settings.outdir_by_ngs_type and self.file.ngs_type:
            return out / self.file.ngs_type
        return super().folder(out)

    def write(self, result: Result, folder: Path) -> dict[str, Any]:
        """Nothing of a read is edited, so its file is copied in the coding asked for, alignments as they are."""
        if self.file.fmt == "BAM":
            return self.write_minimal(folder)
        base = f"{result.metadata['base_name']}_R{result.metadata['read_number']}"
        return self._copied(self.target(folder, base), self.settings.coding_type)

    def write_minimal(self, out: Path) -> dict[str, Any]:
        own = self._named()
        if self.file.fmt != "BAM":
            return own | self._copied(self.target(out, f"{own['base_name']}_R{own['read_number']}"), self.file.coding)
        name, suffix = self.file.path.name, self.settings.output_filename_suffix
        if suffix:
            name = f"{self.base}_{suffix}{''.join(self.file.path.suffixes)}"
        return own | self._copied(self.folder(out) / name, self.file.coding)

    def _named(self) -> dict[str, Any]:
        """What is known of the file without reading it."""
        return self._pair() | {"ngs_type": self.file.ngs_type, "input_format": self.file.fmt}

    def _pair(self) -> dict[str, Any]:
        """The name and the number of the mate that the file's name tells; only pairs of one platform are named so."""
        name = self.file.path.name.removesuffix(".gz").removesuffix(".bz2").rsplit(".", 1)[0]
        if self.file.ngs_type != "illumina":
            return {"base_name": name, "read_number": 1, "illumina_pairing_detected": False}
        p = self.spark.createDataFrame([(name,)], "n string").select(read_pair(F.col("n")).alias("p")).head()["p"]
        return {"base_name": p["base_name"], "read_number": p["read_number"], "illumina_pairing_detected": True}

    def describe(self, rows: DataFrame) -> dict[str, Any]:
        own = self._named()
        if self.file.fmt == "BAM":
            return own | {"num_reads": None}
        stats = R.read_stats(self._checked(rows)).head().asDict()
        # a sample says nothing about the file's lengths
        return own | (stats if self.level == "strict" else {"num_reads": stats["num_reads"]})


class FeatureValidator(BaseValidator):
    extension = "gff"
    formats = ("GFF", "GTF", "BED")
    error = X.FeatureValidationError
    settings: FeatureSettings

    def read(self) -> DataFrame:
        lines = numbered_lines(self.spark, str(self.file.path))
        if self.file.fmt == "BED":
            rows = SRC.parse_bed(lines)
        else:
            rows = SRC.parse_gff(lines)
            rows = SRC.gtf_to_gff3(rows) if self.file.fmt == "GTF" else rows
        rows = FT.fit_parents(rows)
        if rows.isEmpty():  # what isn't written as its name says may still be lines of features
            rows = SRC.parse_gff(lines)
        if rows.isEmpty():
            raise (X.BedFormatError if self.file.fmt == "BED" else X.GffFormatError)("No features found")
        return rows

    def check(self, rows: DataFrame) -> DataFrame | None:
        if not self.settings.check_coordinates:
            return None
        return FT.coordinate_issues(rows.orderBy("line_no").limit(SAMPLE) if self.level == "trust" else rows)

    def write(self, result: Result, folder: Path) -> dict[str, Any]:
        target = self.target(folder)
        K.as_file(lambda f: K.write_gff3(result.data, f, K.CODECS[self.settings.coding_type]), target)
        return {"output_file": str(target), "output_filename": target.name}

    def edit(self, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
        rows = rows if self.settings.sort_by_position else rows.orderBy("line_no")
        d = FT.rename_features(rows, self.settings.replace_id_with) if self.settings.replace_id_with else rows
        return (FT.sort_features(d) if self.settings.sort_by_position else d), {}

    def describe(self, rows: DataFrame) -> dict[str, Any]:
        return FT.feature_summary(rows).head().asDict()


def validate_genome(spark: SparkSession, file: InputFile, settings: GenomeSettings | None = None, **kw: Any) -> Result:
    return GenomeValidator(spark, file, settings or GenomeSettings()).run(**kw)


def validate_reads(spark: SparkSession, file: InputFile, settings: ReadSettings | None = None, **kw: Any) -> Result:
    return ReadValidator(spark, file, settings or ReadSettings()).run(**kw)


def validate_features(spark: SparkSession, file: InputFile, settings: FeatureSettings | None = None, **kw: Any) -> Result:
    return FeatureValidator(spark, file, settings or FeatureSettings()).run(**kw)


def validate_all(spark: SparkSession, files: list[InputFile], settings: Settings, **kw: Any) -> list[Result]:
    """Several files of one kind, by the settings' type."""
    one = {GenomeSettings: validate_genome, ReadSettings: validate_reads, FeatureSettings: validate_features}[type(settings)]
    return [one(spark, f, settings, **kw) for f in files]


def check_reads(spark: SparkSession, results: list[Result], allow_missing_r1: bool = False) -> dict[str, Any]:
    """Whether every second mate has its first one; files that are alignments don't take part."""
    rows = [(r.metadata["base_name"], int(r.metadata["read_number"])) for r in results if r.metadata.get("input_format") != "BAM"]
    d = spark.createDataFrame(rows, "base_name string, read_number int")
    pairs = R.pair_completeness(d, (), allow_missing_r1)
    row = R.pair_summary(pairs).head().asDict()
    told = pairs.where("level <> 'ok'").orderBy("base_name").collect()
    missing = [p["base_name"] for p in told if p["status"] == "missing_r1"]
    out: dict[str, Any] = {"name": "read pairs", "errors": [], "warnings": []}
    if missing:
        out["warnings" if allow_missing_r1 else "errors"].append(f"Found R2 file(s) without matching R1: {', '.join(missing)}")
    for mate in (1, 2):
        several = [p["base_name"] for p in told if p[f"multiple_r{mate}"]]
        if several:
            out["warnings"].append(f"Multiple R{mate} files found: {', '.join(several)}")
    return out | {"passed": row["passed"], "metadata": row}


def check_genomes(ref: DataFrame, mod: DataFrame, same_number: bool = True, same_ids: bool = False, same_lengths: bool = False) -> dict[str, Any]:
    """Whether two genomes (id, seq) agree in number, ids and lengths, as far as asked."""
    a, b = (d.select("id", F.length("seq").cast("long").alias("length")) for d in (ref, mod))
    compared = G.compare_sequences(a, b)
    row = G.genome_check(compared, same_number, same_ids, same_lengths).head().asDict()
    errors = []
    if same_number and row["n_ref"] != row["n_mod"]:
        errors.append(f"Genome sequence count mismatch: {row['n_ref']} and {row['n_mod']}")
    if same_ids and (row["ref_only"] or row["mod_only"]):
        errors.append(f"Genome sequence ID mismatch: {row['ref_only']} only in the reference, {row['mod_only']} only in the modified genome")
    if same_lengths:
        # a message for each, as the list is what the check is for
        for r in compared.where("status = 'length_mismatch'").orderBy("id").toLocalIterator():
            errors.append(f"Sequence length mismatch for '{r['id']}': difference={r['difference']:+d}")
    return {"name": "genomes", "passed": row["passed"], "errors": errors, "warnings": [], "metadata": row}


def run_parameters(files: dict[str, Any], reads: list[dict[str, Any]], genomes_passed: bool, fragmented: bool = False) -> dict[str, Any]:
    """What the later steps of a run need to know.

    ``files`` may give ref, mod, ref_plasmid, mod_plasmid, ref_split, mod_split (lists), characterised_plasmid and
    contigs (list); ``reads`` are dicts with output_file, ngs_type and input_format. A plasmid is the explicit one,
    else the first that was split off its genome, else (modified side) the characterised one.
    """
    has = lambda p, *f: any(r["ngs_type"] == p and r["input_format"] in f for r in reads)
    split = lambda side: next(iter(files.get(f"{side}_split") or []), None)
    out: dict[str, Any] = {
        "run_ref_x_mod": bool(files.get("ref") and files.get("mod") and genomes_passed and not fragmented),
        "run_illumina": has("illumina", "FASTQ"),
        "run_nanopore": has("ont", "FASTQ", "BAM"),
        "run_pacbio": has("pacbio", "FASTQ", "BAM"),
        "contig_file_size": len(files.get("contigs") or []),
        "contig_files": list(files.get("contigs") or []),
        "ref_fasta": files.get("ref"),
        "mod_fasta": files.get("mod"),
        "ref_plasmid_fasta": files.get("ref_plasmid") or split("ref"),
        "mod_plasmid_fasta": files.get("mod_plasmid") or split("mod") or files.get("characterised_plasmid"),
    }
    for p in ("illumina", "ont", "pacbio"):
        for f in ("FASTQ", "BAM"):
            out[f"{p}_{f.lower()}_files"] = sorted(r["output_file"] for r in reads if r["ngs_type"] == p and r["input_format"] == f)
    return out
