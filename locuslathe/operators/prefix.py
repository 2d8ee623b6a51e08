"""Running sums and ranks in a total order without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a tile of the order column; a task sorts the rows of one tile.
TILE_BITS = 16


def prefix_sum(
    df: DataFrame, by: tuple[str, ...], order: str, value: Column, out: str, tile_bits: int = TILE_BITS
) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over the rows of the group before each row in the order of ``order``.

    ``order`` is a bigint, unique in its group. Sums per tile of the order column are small and are summed first; inside
    a tile a window does the rest. Null values count 0; rows with a null order come first.
    """
    t = "_tile_" + out
    d = df.withColumn("_v_" + out, F.coalesce(value, F.lit(0))).withColumn(t, F.shiftright(order, tile_bits))
    v = "_v_" + out
    sums = d.groupBy(*by, t).agg(F.sum(v).alias("_s"))
    before = Window.partitionBy(*by).orderBy(t).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *(F.col(b).alias(f"_b{i}") for i, b in enumerate(by)), F.col(t).alias("_t"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before")
    )
    on = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(by)] + [F.col(t).eqNullSafe(F.col("_t"))]
    d = d.join(sums, on)
    inside = Window.partitionBy(*by, t).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn(out, F.col("_before") + F.coalesce(F.sum(v).over(inside), F.lit(0)))
    return d.drop(t, v, "_t", "_before", *(f"_b{i}" for i in range(len(by))))


def running_rank(df: DataFrame, by: tuple[str, ...], order: str, out: str, tile_bits: int = TILE_BITS) -> DataFrame:
    """``df`` with ``out``, 0 for the first row of each group in the order of ``order``, then 1, 2, ..."""
    return prefix_sum(df, by, order, F.lit(1).cast("long"), out, tile_bits)
