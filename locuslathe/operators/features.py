"""Annotation features: coordinate checks, order, renaming, what kinds there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coordinate_issues(df: DataFrame) -> DataFrame:
    """(seqname, start, end, level, message): a start below 1, else a start beyond the end. Null coordinates raise none."""
    message = F.when(F.col("start") < 1, F.format_string("Invalid start coordinate (%d < 1)", F.col("start"))).when(
        F.col("start") > F.col("end"), F.format_string("start > end (%d > %d)", F.col("start"), F.col("end"))
    )
    d = df.withColumn("message", message).where("message is not null")
    return d.select("seqname", "start", "end", F.lit("WARNING").alias("level"), "message")


def attribute(name: str) -> Column:
    """The value of a GFF3 attribute, null if there is none."""
    return F.nullif(F.regexp_extract("attributes", rf"(?:^|;)\s*{name}=([^;]*)", 1), F.lit(""))


def fit_parents(df: DataFrame, levels: int = 3) -> DataFrame:
    """Features whose start and end are those of all their children, from the innermost level outwards.

    Children name their parents (several are separated by commas) in the attribute Parent, parents their ID, both within
    a sequence. A feature without children, or without an ID, stays as it is. ``levels``: of parents above one another
    (exons, transcripts, genes).
    """
    for _ in range(levels):
        child = df.select(
            F.col("seqname").alias("_q"), F.explode(F.split(attribute("Parent"), ",")).alias("_p"), F.col("start").alias("_s"), F.col("end").alias("_e")
        )
        span = child.groupBy("_q", "_p").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
        own = df.withColumn("_id", attribute("ID"))
        on = (F.col("seqname") == F.col("_q")) & (F.col("_id") == F.col("_p"))
        df = own.join(span, on, "left").withColumns(
            {"start": F.coalesce("_s", "start"), "end": F.coalesce("_e", "end")}
        ).drop("_id", "_q", "_p", "_s", "_e")
    return df


def sort_features(df: DataFrame) -> DataFrame:
    """In the order of sequence name, start and end, over range partitions."""
    return df.orderBy("seqname", "start", "end")


def rename_features(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("seqname", F.lit(name))


def feature_summary(df: DataFrame) -> DataFrame:
    """(num_features, feature_types, sequence_ids): distinct values, sorted. One row."""
    return df.agg(
        F.count(F.lit(1)).alias("num_features"),
        F.array_sort(F.collect_set("feature_type")).alias("feature_types"),
        F.array_sort(F.collect_set("seqname")).alias("sequence_ids"),
    )


def with_length(df: DataFrame) -> DataFrame:
    return df.withColumn("length", F.col("end") - F.col("start"))
