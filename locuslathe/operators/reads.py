"""Sequencing reads and read files: statistics, checks, mates, and comparison of unmapped reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslathe.functions.bases import invalid_characters
from locuslathe.functions.names import sample_key
from locuslathe.operators.sequences import n50


def read_stats(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, num_reads, total_bases, mean_read_length, longest_read_length, shortest_read_length, n50).

    Null sequences count as reads of length 0. Without ``by`` an empty table gives one row of zeros.
    """
    d = df.withColumn("length", F.coalesce(F.length("seq"), F.lit(0)).cast("long"))
    zero = F.lit(0)
    s = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_reads"), F.coalesce(F.sum("length"), zero).alias("total_bases"),
        F.coalesce(F.avg("length"), F.lit(0.0)).alias("mean_read_length"),
        F.coalesce(F.max("length"), zero).alias("longest_read_length"),
        F.coalesce(F.min("length"), zero).alias("shortest_read_length"),
    )
    half = n50(d, by)
    if not by:
        half = half.agg(F.coalesce(F.max("n50"), zero).alias("n50"))
        return s.withColumn("_k", F.lit(1)).join(half.withColumn("_k", F.lit(1)), "_k").drop("_k")
    half = half.select(*(F.col(b).alias(f"_b{i}") for i, b in enumerate(by)), "n50")
    on = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)]
    return s.join(half, on, "left").drop(*(f"_b{i}" for i in range(len(by)))).fillna(0, ["n50"])


def duplicate_ids(df: DataFrame, by: tuple[str, ...] = (), id_col: str = "id") -> DataFrame:
    """(*by, id, n) of the ids that occur more than once; null ids are not compared."""
    return df.where(F.col(id_col).isNotNull()).groupBy(*by, id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def invalid_reads(df: DataFrame) -> DataFrame:
    """(id, n_invalid, characters) of the reads that hold other characters than A, C, G, T and N."""
    d = df.withColumn("_c", invalid_characters(F.col("seq"))).where("_c.n > 0")
    return d.select("id", F.col("_c.n").alias("n_invalid"), F.array_join("_c.characters", ", ").alias("characters"))


def pair_completeness(files: DataFrame, by: tuple[str, ...] = (), allow_missing_r1: bool = False) -> DataFrame:
    """One row per base name: n_r1, n_r2 and status.

    ``status`` is ``complete`` (both mates), ``missing_r1`` (an error, or a warning if that is allowed), ``single``
    (mate 1 only); ``level`` says how bad it is, ``multiple_r1`` and ``multiple_r2`` that a mate occurs more than once.
    Rows without a mate number or base name don't take part.
    """
    d = files.where("read_number is not null and base_name is not null")
    g = d.groupBy(*by, "base_name").agg(
        F.count(F.when(F.col("read_number") == 1, 1)).alias("n_r1"),
        F.count(F.when(F.col("read_number") == 2, 1)).alias("n_r2"),
    )
    r1, r2 = F.col("n_r1") > 0, F.col("n_r2") > 0
    status = F.when(r1 & r2, "complete").when(r2, "missing_r1").when(r1, "single").otherwise("none")
    several = (F.col("n_r1") > 1) | (F.col("n_r2") > 1)
    bad = F.lit("warning" if allow_missing_r1 else "error")
    return g.withColumns(
        {
            "status": status,
            "multiple_r1": F.col("n_r1") > 1,
            "multiple_r2": F.col("n_r2") > 1,
            "level": F.when(status == "missing_r1", bad).when(several, "warning").otherwise("ok"),
        }
    )


def pair_summary(completeness: DataFrame) -> DataFrame:
    """(passed, pairs_checked, complete_pairs, missing_r1, warnings): one row."""
    count = lambda c: F.count(F.when(c, 1))
    return completeness.agg(
        (count(F.col("level") == "error") == 0).alias("passed"),
        F.count(F.lit(1)).alias("pairs_checked"),
        count(F.col("status") == "complete").alias("complete_pairs"),
        count(F.col("status") == "missing_r1").alias("missing_r1"),
        count(F.col("level") == "warning").alias("warnings"),
    )


def compare_multisets(ref: DataFrame, mod: DataFrame, id_col: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, shared, ref_only, mod_only): sizes of the multiset intersection and both differences, in one pass.

    Each id's occurrences on either side are counted with map-side combine; null ids count like any other.
    """
    both = ref.select(*by, id_col, F.lit(1).alias("_r"), F.lit(0).alias("_m")).unionByName(
        mod.select(*by, id_col, F.lit(0).alias("_r"), F.lit(1).alias("_m"))
    )
    c = both.groupBy(*by, id_col).agg(F.sum("_r").alias("a"), F.sum("_m").alias("b"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return c.groupBy(*by).agg(
        total(F.least("a", "b")).alias("shared"),
        total(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("ref_only"),
        total(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("mod_only"),
    )


def multiset_intersect(ref: DataFrame, mod: DataFrame) -> DataFrame:
    return ref.intersectAll(mod)


def multiset_except(ref: DataFrame, mod: DataFrame) -> DataFrame:
    return ref.exceptAll(mod)


UNMAPPED = 4


def unmapped(alignments: DataFrame) -> DataFrame:
    """The alignment records whose flag says unmapped."""
    return alignments.where(F.col("flag").bitwiseAND(F.lit(UNMAPPED)) == UNMAPPED)


def unmapped_share(alignments: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, total, unmapped, percent): all records count in the total; the percentage has two decimals."""
    hit = F.col("flag").bitwiseAND(F.lit(UNMAPPED)) == UNMAPPED
    d = alignments.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count(F.when(hit, 1)).alias("unmapped"))
    return d.withColumn("percent", F.when(F.col("total") > 0, F.round(F.col("unmapped") * 100.0 / F.col("total"), 2)))


def unmapped_line(label: str, unmapped_col: str = "unmapped", percent: str = "percent"):
    """The log line of one mapping: thousands separated, percentage with two decimals."""
    return F.concat(F.lit(f"{label}: unmapped "), F.format_number(unmapped_col, 0), F.lit(" ("), F.format_string("%.2f", percent), F.lit("%)"))


def fastq_read_count(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, num_lines, num_reads, valid): four lines are a read; a rest makes the file invalid."""
    d = lines.groupBy(*by).agg(F.count(F.lit(1)).alias("num_lines"))
    return d.withColumns({"num_reads": F.expr("num_lines div 4"), "valid": F.col("num_lines") % 4 == 0})


def group_samples(files: DataFrame, name: str = "file_name") -> DataFrame:
    """(sample, files): the gzipped read files of each sample, sorted; other names are dropped."""
    d = files.withColumn("sample", sample_key(F.col(name))).where("sample is not null")
    return d.groupBy("sample").agg(F.array_sort(F.collect_list(name)).alias("files"))
