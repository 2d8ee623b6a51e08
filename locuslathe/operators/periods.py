"""Continuous periods and gaps from overlapping intervals, by Spark's session windows.

A call [start, end] becomes an event at microsecond ``start`` whose session stays open for its own length, so that
``session_window`` with a row-specific duration merges what overlaps. Two things are added to it:

* Sessions are built per tile of ``2**tile_bits`` bases, not per group, so a group that holds a third of all rows
  spreads over many tasks. Equal starts are first reduced to their longest call (with map-side combine), which bounds a
  tile's rows by its bases. Where calls run on into later tiles, those get one row that covers what is covered.
* Only the first and the last session of a tile can touch another tile. Those, at most two a tile, are stitched per
  group; periods that follow each other directly (end n, start n + 1) become one.

Gaps are derived with ``lead`` inside a tile and, for a tile's last period, from the next tile that has any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A tile has 2**20 bases, which are also the most rows that a task gets from it.
TILE_BITS = 20

#: Session length in microseconds as a calendar interval, exact up to 10**18.
_LENGTH = "make_interval(0, 0, 0, 0, 0, 0, cast(cast(e - s + 1 as decimal(20, 0)) / 1000000 as decimal(18, 6)))"


def periods_and_gaps(
    df: DataFrame, keys: dict[str, Column], start: Column, end: Column, tile_bits: int = TILE_BITS
) -> DataFrame:
    """Rows (*keys, span_kind, span_start, span_end): each covered ``period`` and each ``gap`` between two of them.

    ``start`` and ``end`` are inclusive bigints in either order. Rows with a null coordinate are left out. A null key
    is a key value like any other; callers filter it where it means something else. Repeated rows change nothing. One
    period in a group gives no gap; an empty table gives no rows. Only the columns in the expressions are read, so
    extra columns of any name are harmless.
    """
    names = list(keys)
    k = [f"_k{i}" for i in range(len(names))]
    tile = F.shiftright("s", tile_bits).alias("t")
    longest = (
        df.select(*(c.alias(a) for c, a in zip(keys.values(), k, strict=True)), start.alias("_a"), end.alias("_b"))
        .where("_a is not null and _b is not null")
        .select(*k, F.least("_a", "_b").alias("s"), F.greatest("_a", "_b").alias("e"))
        .groupBy(*k, "s")
        .agg(F.max("e").alias("e"))
        .select(*k, tile, "s", "e")
    )
    sessions = _sessions(_with_carry(longest, k, tile_bits), k)
    periods = _stitch(sessions, k).select(*k, tile, "s", "e")
    return _spans(periods, k).select(
        *(F.col(a).alias(n) for a, n in zip(k, names, strict=True)), "span_kind", "span_start", "span_end"
    )


def _with_carry(rows: DataFrame, k: list[str], tile_bits: int) -> DataFrame:
    """``rows``, and for each tile that calls of earlier tiles reach into, one row over what they cover of it."""
    before = Window.partitionBy(*k).orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        rows.groupBy(*k, "t")
        .agg(F.max("e").alias("e"))
        .withColumn("e", F.max("e").over(before))
        .withColumn("s", F.shiftleft("t", tile_bits))
        .where("e >= s")
    )
    return rows.unionByName(reached.select(*rows.columns))


def _sessions(rows: DataFrame, k: list[str]) -> DataFrame:
    at = F.timestamp_micros("s")
    return (
        rows.withColumn("at", at)
        .groupBy(*k, "t", F.session_window("at", F.expr(_LENGTH)))
        .agg(F.min("s").alias("s"), F.max("e").alias("e"))
        .select(*k, "t", "s", "e")
    )


def _stitch(sessions: DataFrame, k: list[str]) -> DataFrame:
    """Joins the outermost sessions of neighbouring tiles; the inner ones are periods as they are."""
    in_tile = Window.partitionBy(*k, "t").orderBy("s")
    marked = sessions.withColumn("inner", F.lag("s").over(in_tile).isNotNull() & F.lead("s").over(in_tile).isNotNull())
    along = Window.partitionBy(*k).orderBy("s", "e")
    outer = (
        marked.where("not inner")
        .withColumn("covered", F.max("e").over(along.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("new", F.when(F.col("covered") >= F.col("s") - 1, 0).otherwise(1))
        .withColumn("island", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*k, "island")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"))
    )
    return outer.select(*k, "s", "e").unionByName(marked.where("inner").select(*k, "s", "e"))


def _spans(periods: DataFrame, k: list[str]) -> DataFrame:
    in_tile = Window.partitionBy(*k, "t").orderBy("s")
    known = periods.withColumn("next", F.lead("s").over(in_tile)).withColumn(
        "first", F.min("s").over(Window.partitionBy(*k, "t"))
    )

    def span(kind: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(kind).alias("span_kind"), a.alias("span_start"), b.alias("span_end"))

    gap = span("gap", F.col("e") + 1, F.col("next") - 1)
    inside = known.select(
        *k, F.inline(F.array_compact(F.array(span("period", F.col("s"), F.col("e")), F.when(F.col("next").isNotNull(), gap))))
    )
    across = (
        known.where("next is null")
        .withColumn("next", F.lead("first").over(Window.partitionBy(*k).orderBy("t")))
        .where("next is not null")
        .select(*k, F.inline(F.array(gap)))
    )
    return inside.unionByName(across)
