"""Alignment records: coordinate order, filters, summary counts, histograms of reads, pairing of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Thresholds of small-variant calling and of whole-genome alignment filtering.
VARIANT_THRESHOLDS = {"min_coverage": 10, "min_base_quality": 20, "min_mapping_quality": 30, "min_alternate_count": 3}
ALIGNMENT_THRESHOLDS = {"identity": 90.0, "length": 100}


def sort_by_coordinate(df: DataFrame, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """In coordinate order over range partitions; records without a place come last."""
    return df.orderBy(F.col(chrom).asc_nulls_last(), F.col(pos).asc_nulls_last())


def filter_alignments(df: DataFrame, identity: float = ALIGNMENT_THRESHOLDS["identity"], length: int = ALIGNMENT_THRESHOLDS["length"]) -> DataFrame:
    """Blocks of at least this identity (percent) and length. Null values fail."""
    return df.where((F.col("identity") >= identity) & (F.col("length") >= length))


def callable_sites(df: DataFrame, **thresholds: int) -> DataFrame:
    """Pileup rows (coverage, base_quality, mapping_quality, alternate_count) that reach every threshold."""
    t = VARIANT_THRESHOLDS | thresholds
    return df.where(
        (F.col("coverage") >= t["min_coverage"]) & (F.col("base_quality") >= t["min_base_quality"])
        & (F.col("mapping_quality") >= t["min_mapping_quality"]) & (F.col("alternate_count") >= t["min_alternate_count"])
    )


def alignment_stats(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, records, primary, secondary, supplementary, duplicates, mapped, reverse) by the bits of the flag."""
    bit = lambda b: F.coalesce(F.col("flag"), F.lit(0)).bitwiseAND(F.lit(b)) != 0
    n = lambda c: F.count(F.when(c, 1))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"), n(~bit(256 + 2048)).alias("primary"), n(bit(256)).alias("secondary"),
        n(bit(2048)).alias("supplementary"), n(bit(1024)).alias("duplicates"), n(~bit(4)).alias("mapped"),
        n(bit(16)).alias("reverse"),
    )


def length_histogram(df: DataFrame, by: tuple[str, ...] = (), width: int = 100, seq: str = "seq") -> DataFrame:
    """(*by, bin_start, n): how many sequences have lengths of each bin; null sequences are left out."""
    n = F.length(seq)
    d = df.where(F.col(seq).isNotNull()).withColumn("bin_start", (n - F.pmod(n, F.lit(width))).cast("long"))
    return d.groupBy(*by, "bin_start").agg(F.count(F.lit(1)).alias("n"))


def quality_histogram(df: DataFrame, by: tuple[str, ...] = (), qual: str = "qual") -> DataFrame:
    """(*by, quality, n): how many bases have each Phred quality (offset 33)."""
    chars = F.explode(F.split(F.col(qual), ""))
    return df.select(*by, chars.alias("c")).where("c <> ''").groupBy(*by, (F.ascii("c") - 33).alias("quality")).agg(F.count(F.lit(1)).alias("n"))


def pair_by_sample(ref: DataFrame, mod: DataFrame, key: str = "sample") -> DataFrame:
    """Rows of both sides with the same key; columns of the second side get ``_mod`` where the names clash."""
    renamed = mod.select(*(F.col(c).alias(c if c == key or c not in ref.columns else f"{c}_mod") for c in mod.columns))
    return ref.join(renamed, key)
