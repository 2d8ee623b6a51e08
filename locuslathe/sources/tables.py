"""Tab-separated sources: call tables, support tables, traces, alignment hits, alignments as text."""

from __future__ import annotations

import csv

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the tables by kind
SUPPORT_COLUMNS = ("chrom", "start", "end", "svtype", "supporting_reads")
EMPTY_COLUMNS = ("chrom", "start", "end", "svtype", "info_svtype", "supporting_methods", "score", "supporting_reads")
PAF_COLUMNS = ("query", "qlen", "qstart", "qend", "strand", "ref", "rlen", "rstart", "rend", "nmatch", "block_len", "mapq")


def _strings(columns: tuple[str, ...]) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def _files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files under paths, folders and globs, sorted; hidden ones are left out."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for p in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for s in fs.globStatus(path) or []:
            inner = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
            out += [x.getPath().toString() for x in inner if x.isFile() and x.getPath().getName()[0] not in "._"]
    return sorted(out)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The columns that a file's first line names; none for an empty or unreadable file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    try:
        stream = p.getFileSystem(conf).open(p)
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = reader.readLine()
        reader.close()
    except Py4JJavaError:
        return ()
    return next(csv.reader([line], delimiter="\t"), ()) if line else ()


def _by_name(spark: SparkSession, files: list[str]) -> list[tuple[list[str], DataFrame]]:
    """(columns, rows) of the files of each header; a header is read once per file, the rows of alike ones together."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        if header := tuple(_header(spark, f)):
            groups.setdefault(header, []).append(f)
    read = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    out = []
    for header, own in groups.items():
        place = [f"_c{i}" for i in range(len(header))]  # names may repeat or clash
        d = read.csv(own, sep="\t", header=True, quote='"', escape='"', enforceSchema=True, schema=_strings(place))
        first: dict[str, str] = {}
        for p, name in zip(place, header, strict=True):
            first.setdefault(name, p)
        out.append((list(first), d.select(*(F.col(p).alias(n) for n, p in first.items()), F.col("_metadata.file_name").alias("_file"))))
    return out


def read_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text under the names of the header; lines that start with ``#`` are left out.

    A header that itself starts with ``#chrom`` is one, not a comment. A ``#`` inside a line is text. A field that begins
    with a double quote is unquoted, with a doubled quote in it standing for one. Of several files each is read by its
    own header; a column that one lacks is null there, empty files have no rows. A name that a header has twice means
    its first column.
    """
    out = None
    for columns, d in _by_name(spark, _files(spark, path)):
        first = columns[0]
        d = d.where(~F.coalesce(F.col(f"`{first}`").startswith("#"), F.lit(False))).drop("_file")
        d = d.withColumnRenamed("#chrom", "chrom") if "chrom" not in columns else d
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return empty_table(spark) if out is None else out


def read_calls(spark: SparkSession, path: str | list[str], source: str) -> DataFrame:
    """A call table with its ``source``, and ``seq``, the order of its rows in the file."""
    return read_tsv(spark, path).withColumns({"source": F.lit(source), "seq": F.monotonically_increasing_id()})


def read_support(spark: SparkSession, glob: str) -> DataFrame:
    """The callers' support tables under a glob, one under the other; empty and unreadable files are skipped.

    Columns are taken by their names, whatever their order; other columns are left out, and one that a file lacks is null.
    """
    out = spark.createDataFrame([], _strings((*SUPPORT_COLUMNS, "caller_file")))
    for columns, d in _by_name(spark, _files(spark, glob)):
        named = "chrom" if "chrom" in columns else "#chrom"
        own = [F.col(f"`{named}`" if c == "chrom" else c).alias(c) if c in columns or (c == "chrom" and named in columns) else F.lit(None).cast("string").alias(c) for c in SUPPORT_COLUMNS]  # noqa: E501
        out = out.union(d.select(*own, F.col("_file").alias("caller_file")))
    return out.where("chrom is null or not startswith(chrom, '#')")


def empty_table(spark: SparkSession, columns: tuple[str, ...] = EMPTY_COLUMNS) -> DataFrame:
    """What a branch that didn't run hands on: the columns without rows."""
    return spark.createDataFrame([], _strings(columns))


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    """A task trace, by the names of its header."""
    return spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.col("value"), F.monotonically_increasing_id().alias("line_no"))


def parse_paf(lines: DataFrame) -> DataFrame:
    """Alignment hits of (value, line_no): lines with fewer than 12 fields or numbers that are none are left out."""
    f = F.split("value", "\t", -1)
    d = lines.where(F.size(f) >= 12).select("line_no", *(F.get(f, F.lit(i)).alias(c) for i, c in enumerate(PAF_COLUMNS)))
    numbers = ("qlen", "qstart", "qend", "rlen", "rstart", "rend", "nmatch", "block_len", "mapq")
    return d.withColumns({c: F.trim(c).try_cast("long") for c in numbers}).where("block_len is not null")


def read_paf(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_paf(numbered_lines(spark, path))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments of (value): read_id, flag, chrom, pos, mapq, cigar, seq, and the reference span a_beg0..a_end0."""
    f = F.split("value", "\t", -1)
    part = lambda i: F.get(f, F.lit(i))
    d = lines.where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(
        part(0).alias("read_id"), part(1).try_cast("int").alias("flag"), F.nullif(part(2), F.lit("*")).alias("chrom"),
        part(3).try_cast("long").alias("pos"), part(4).try_cast("int").alias("mapq"), part(5).alias("cigar"), part(9).alias("seq"),
    ).where("flag is not null")
    steps = F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    span = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return d.withColumns({"a_beg0": F.col("pos") - 1, "a_end0": F.col("pos") - 1 + span})


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_sam(numbered_lines(spark, path))
