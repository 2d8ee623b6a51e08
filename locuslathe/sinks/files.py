"""File sinks: result tables per type, sequences, reads, features, offsets, JSON.

Spark writes folders of parts. Where a single file is wanted, ``as_file`` puts the parts together as bytes: members of
gzip and bzip2 may follow each other, so nothing is compressed twice. Files are written beside their place and then moved
there, so a repeated job replaces what it wrote.
"""

from __future__ import annotations

import bz2
import gzip
import json
import re
import shutil
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe.operators.prefix import running_rank

# The result table of each type
TYPE_TABLES = {
    "INS": "Insertions", "DEL": "Deletions", "DUP": "Duplications", "RPL": "Replacements", "INV": "Inversions",
    "TRA": "Translocations",
}
_WRAP = 60


#: File suffixes and Spark's codecs of the compressions
SUFFIXES = {"NONE": "", "GZIP": ".gz", "BZIP2": ".bz2"}
CODECS = {"NONE": None, "GZIP": "gzip", "BZIP2": "bzip2"}


def _place(path: str | Path) -> tuple[fs.FileSystem, str]:
    text = str(path)
    return fs.FileSystem.from_uri(text) if re.match(r"^[a-z0-9]+:/", text) else (fs.LocalFileSystem(), text)


def _replace(target: str | Path, write: Callable[[pa.NativeFile], None]) -> None:
    """Writes beside ``target``, then moves it there."""
    system, path = _place(target)
    system.create_dir(str(Path(path).parent), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part, compression=None) as out:
        write(out)
    system.move(part, path)


def as_file(write: Callable[[str], None], target: str | Path) -> str:
    """What ``write`` puts into a folder, in the order of its parts, as the one file ``target``."""
    folder = f"{target}.parts-{uuid.uuid4().hex}"
    write(folder)
    _join_parts(folder, target)
    return str(target)


def write_text(text: str, target: str | Path) -> None:
    """A short text of the driver's as a file, replaced at once."""
    _replace(target, lambda out: out.write(text.encode("utf-8")))


def _join_parts(folder: str, target: str | Path) -> None:
    system, path = _place(folder)
    parts = sorted(f.path for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part-"))

    def copy(out: pa.NativeFile) -> None:
        for p in parts:
            with system.open_input_stream(p, compression=None) as src:
                shutil.copyfileobj(src, out, 1 << 20)

    _replace(target, copy)
    system.delete_dir(path)


def copy_files(spark: SparkSession, jobs: list[tuple[str, str, str, str]]) -> int:
    """Copies (source, target, coding it has, coding it shall have) byte by byte through the codecs; the bytes written.

    Each file is a task of its own. Alike codings make the copy identical; NONE, GZIP and BZIP2 convert into each other
    without a look at the text, so line ends and everything else stay.
    """
    if not jobs:
        return 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [_copy(**row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["bytes"])

    rows = [(str(a), str(b), have, want) for a, b, have, want in jobs]
    d = spark.createDataFrame(rows, "source string, target string, have string, want string").repartition(len(rows))
    return d.mapInArrow(run, "bytes long").agg(F.sum("bytes")).head()[0]


def publish(spark: SparkSession, files: dict[str, list[str]], out_dir: str) -> list[str]:
    """Copies of each step's outputs below ``out_dir``, in a folder by the step's name; their paths, in the given order."""
    jobs = [(f, f"{out_dir}/{step}/{Path(f).name}", "NONE", "NONE") for step, own in files.items() for f in own]
    copy_files(spark, jobs)
    return [target for _, target, *_ in jobs]


def _copy(source: str, target: str, have: str, want: str) -> int:
    system, path = _place(source)
    size = 0

    def convert(out: pa.NativeFile) -> None:
        nonlocal size
        with system.open_input_stream(path, compression=None) as raw:
            if have == want:
                shutil.copyfileobj(raw, out, 1 << 20)
            else:
                src = {"NONE": lambda: raw, "GZIP": lambda: gzip.GzipFile(fileobj=raw), "BZIP2": lambda: bz2.BZ2File(raw)}[have]()
                if want == "NONE":
                    shutil.copyfileobj(src, out, 1 << 20)
                else:
                    packed = gzip.GzipFile(filename="", mode="wb", fileobj=out, mtime=0) if want == "GZIP" else bz2.BZ2File(out, "wb")
                    with packed:
                        shutil.copyfileobj(src, packed, 1 << 20)
        size = out.tell()

    _replace(target, convert)
    return size


def _single_file(df: DataFrame, target: str) -> bool:
    """Writes one CSV file named ``target`` on any file system that Spark reaches; False if there is no row."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out, parts = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(target + ".parts")
    fs = out.getFileSystem(conf)
    df.write.mode("overwrite").csv(target + ".parts", header=True, emptyValue="", nullValue="")
    files = sorted(s.getPath().toString() for s in fs.listStatus(parts) if s.getPath().getName().startswith("part-"))
    fs.delete(out, True)
    if files:
        fs.rename(jvm.org.apache.hadoop.fs.Path(files[0]), out)
    fs.delete(parts, True)
    return bool(files)


def write_event_tables(events: DataFrame, folder: str) -> list[str]:
    """One sorted CSV per type that has rows, without std_svtype and, but for translocations, without asm_*_mod.

    Tables of types without rows, left by an earlier run, are removed. ``events`` hold texts and numbers only.
    """
    spark = events.sparkSession
    counts = {r["std_svtype"]: r["n"] for r in events.groupBy("std_svtype").agg(F.count(F.lit(1)).alias("n")).collect()}
    written = []
    for std, name in TYPE_TABLES.items():
        target = f"{folder}/{name}.csv"
        if not counts.get(std):
            path = spark._jvm.org.apache.hadoop.fs.Path(target)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            continue
        d = events.where(F.col("std_svtype") == std).drop("std_svtype")
        if std != "TRA":
            d = d.drop("asm_start_mod", "asm_end_mod")
        # the table is one file by its definition, so its rows meet in one task, already reduced to events
        _single_file(d.coalesce(1).sortWithinPartitions("chrom", "event_start", "event_end"), target)
        written.append(target)
    return written


def write_partitioned(df: DataFrame, folder: str, by: str = "std_svtype") -> None:
    """The same rows as a Parquet table with a folder per type, for results too large for single files."""
    df.repartition(by, F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(32))).write.mode("overwrite").partitionBy(by).parquet(folder)


def _write_text(lines: DataFrame, folder: str, compression: str | None) -> None:
    w = lines.write.mode("overwrite")
    (w.option("compression", compression) if compression else w).text(folder)


def fasta_text() -> Column:
    """A record of (id, description, seq) in lines of 60 characters."""
    head = F.when(F.coalesce(F.col("description"), F.lit("")).isin("", F.col("id")), F.col("id")).otherwise(
        F.when(F.col("description").startswith(F.concat(F.col("id"), F.lit(" "))), F.col("description")).otherwise(F.concat_ws(" ", "id", "description"))
    )
    body = F.rtrim(F.regexp_replace("seq", "(.{%d})" % _WRAP, "$1\n"), F.lit("\n"))
    return F.concat(F.lit(">"), head, F.lit("\n"), body)


def write_fasta(seqs: DataFrame, folder: str, compression: str | None = None) -> None:
    """Records in lines of 60 characters, in the order of ``seq_idx``."""
    _write_text(seqs.orderBy("seq_idx").select(fasta_text()), folder, compression)


def write_fastq(reads: DataFrame, folder: str, compression: str | None = None) -> None:
    head = F.coalesce(F.nullif("description", F.lit("")), F.col("id"))
    line = F.concat(F.lit("@"), head, F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    _write_text(reads.orderBy("file", "read_idx").select(line), folder, compression)


def gff3_lines(features: DataFrame) -> DataFrame:
    cols = ("seqname", "source", "feature_type", "start", "end", "score", "strand", "frame", "attributes")
    return features.select(F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in cols)).alias("value"))


def write_gff3(features: DataFrame, folder: str, compression: str | None = None) -> None:
    """Features behind the version line, in their order."""
    head = features.sparkSession.createDataFrame([("##gff-version 3",)], "value string")
    _write_text(head.union(gff3_lines(features)), folder, compression)


def write_offsets(offsets: DataFrame, folder: str) -> None:
    """The order and places of merged contigs: seq_id, length, start."""
    offsets.orderBy("start").select("seq_id", "length", "start").write.mode("overwrite").csv(folder, sep="\t", header=True)


def write_contigs(seqs: DataFrame, folder: str) -> None:
    """Each sequence in its own folder ``contig=<id>``."""
    d = seqs.select(F.col("id").alias("contig"), F.concat(F.lit(">"), F.col("id"), F.lit("\n"), F.col("seq")).alias("value"))
    d.write.mode("overwrite").partitionBy("contig").text(folder)


def write_each(seqs: DataFrame, folder: str, name: Callable[[int], str], coding: str = "NONE") -> list[str]:
    """Each sequence, in the order of ``seq_idx``, as a file of its own below ``folder``; their paths.

    ``name`` gives the file's name for 0, 1, ...
    """
    d = running_rank(seqs, (), "seq_idx", "_i").select("_i", fasta_text().alias("value"))
    parts = f"{folder}/.each-{uuid.uuid4().hex}"
    w = d.write.mode("overwrite").partitionBy("_i")
    (w.option("compression", CODECS[coding]) if CODECS[coding] else w).text(parts)
    system, path = _place(parts)
    numbers = sorted(int(f.base_name.split("=")[1]) for f in system.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("_i="))
    out = [f"{folder}/{name(i)}" for i in numbers]
    for i, target in zip(numbers, out, strict=True):
        _join_parts(f"{parts}/_i={i}", target)
    system.delete_dir(path)
    return out


def write_contig_files(seqs: DataFrame, folder: str, base: str) -> list[str]:
    """Each sequence as the file ``<base>_contig_<i>.fasta``."""
    return write_each(seqs, folder, lambda i: f"{base}_contig_{i}.fasta")


def append_plasmids(seqs: DataFrame, folder: str, batch: str | None = None) -> None:
    """Adds sequences to the FASTA folder of the plasmids; those of a named ``batch`` once, however often it is repeated."""
    target, mode = (f"{folder}/batch={batch}", "overwrite") if batch else (folder, "append")
    seqs.select(F.concat(F.lit(">"), F.col("id"), F.lit("\n"), F.col("seq"))).write.mode(mode).text(target)


def extend_fasta(seqs: DataFrame, target: str | Path, coding: str = "NONE") -> str:
    """The FASTA file ``target`` with further sequences behind its own; it is made if it isn't there."""
    more = f"{target}.more"
    as_file(lambda f: write_fasta(seqs, f, CODECS[coding]), more)
    system, path = _place(target)
    files = [p for p in (path, _place(more)[1]) if system.get_file_info(p).type == fs.FileType.File]

    def copy(out: pa.NativeFile) -> None:
        for p in files:
            with system.open_input_stream(p, compression=None) as src:
                shutil.copyfileobj(src, out, 1 << 20)

    _replace(target, copy)
    system.delete_file(_place(more)[1])
    return str(target)


def write_audit(audit: DataFrame, folder: str) -> None:
    """Rejected and modified rows as JSON lines."""
    audit.write.mode("overwrite").json(folder)


def recompress(spark: SparkSession, source: str, folder: str, coding: str) -> None:
    """A file of the coding that its suffix tells, byte for byte in GZIP, BZIP2 or NONE, as the only part of a folder."""
    have = {".gz": "GZIP", ".gzip": "GZIP", ".bz2": "BZIP2", ".bzip2": "BZIP2"}.get(Path(source).suffix.lower(), "NONE")
    copy_files(spark, [(source, f"{folder}/part-00000{SUFFIXES[coding]}", have, coding)])


def next_path(path: str | Path) -> Path:
    """``path``, or the first of name_001.ext ... name_9999.ext that doesn't exist yet."""
    path = Path(path)
    if not path.exists():
        return path
    stem, suffix = re.match(r"(.*?)((?:\.[A-Za-z0-9]+)*)$", path.name).groups()
    for k in range(1, 10_000):
        other = path.with_name(f"{stem}_{k:03d}{suffix}")
        if not other.exists():
            return other
    raise FileExistsError(f"{path} and 9999 numbered ones exist")


def params_json(values: dict) -> str:
    """Run parameters as JSON: absent optional values are left out, lists always stand."""
    return json.dumps({k: v for k, v in values.items() if v is not None}, indent=2, default=str)
