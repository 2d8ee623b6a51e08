"""Joins of intervals without comparing every pair: overlap by bins, nearest within a tolerance, depth over regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bin width at each level; an interval belongs to the first level at which it spans at most eight bins.
LEVELS = (12, 15, 18, 21, 24, 27, 30, 40, 52)


def _own_level(s: Column, e: Column) -> Column:
    level = F.lit(len(LEVELS) - 1)
    for k in range(len(LEVELS) - 2, -1, -1):
        level = F.when(F.shiftright(e, LEVELS[k]) - F.shiftright(s, LEVELS[k]) < 8, F.lit(k)).otherwise(level)
    return level


def _bits(level: Column) -> Column:
    return F.element_at(F.array(*(F.lit(b) for b in LEVELS)), level + 1)


def _shift(value: str, level: str) -> Column:
    picked = F.lit(None).cast("long")
    for k, b in enumerate(LEVELS):
        picked = F.when(F.col(level) == k, F.shiftright(value, b)).otherwise(picked)
    return picked


def overlap_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_span: tuple[str, str], right_span: tuple[str, str], tol: int = 0
) -> DataFrame:
    """Inner join of all pairs with equal ``keys`` whose inclusive intervals overlap or lie within ``tol``.

    Columns of both sides (the keys once, from the left); their other names must differ. Null keys match each other;
    rows with a null end or with start > end match nothing.

    A pair meets in exactly one bin: at the coarser level of the two, the later of their first bins there. An interval
    is entered only at levels that the other side has for its keys, so a few long intervals don't multiply the short
    ones, and no bin is compared with another.
    """
    a = _entered(left, keys, left_span, tol, "l")
    b = _entered(right, keys, right_span, 0, "r")
    a = _levels(a, b, keys, "l", "r")
    b = _levels(b, _entered(left, keys, left_span, tol, "l"), keys, "r", "l").select(
        *(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), *(c for c in b.columns if c not in keys),
        F.col("_level").alias("_level_r"), F.col("_bin").alias("_bin_r"),
    )
    on = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    on += [F.col("_level") == F.col("_level_r"), F.col("_bin") == F.col("_bin_r")]
    # at the coarser of the two levels, in the later of their first bins
    on += [F.col("_level") == F.greatest("_own_l", "_own_r")]
    on += [F.col("_s_l") <= F.col("_e_r"), F.col("_s_r") <= F.col("_e_l")]
    pairs = a.join(b, on).where(F.col("_bin") == F.greatest(_shift("_s_l", "_level"), _shift("_s_r", "_level")))
    return pairs.drop("_level", "_level_r", "_bin", "_bin_r", "_s_l", "_e_l", "_own_l", "_s_r", "_e_r", "_own_r", *(f"_r{i}" for i in range(len(keys))))


def _entered(df: DataFrame, keys: tuple[str, ...], span: tuple[str, str], tol: int, side: str) -> DataFrame:
    d = df.withColumns({f"_s_{side}": F.col(span[0]).cast("long") - tol, f"_e_{side}": F.col(span[1]).cast("long") + tol})
    return d.where(F.col(f"_s_{side}") <= F.col(f"_e_{side}")).withColumn(
        f"_own_{side}", _own_level(F.col(f"_s_{side}"), F.col(f"_e_{side}"))
    )


def _levels(d: DataFrame, other: DataFrame, keys: tuple[str, ...], side: str, other_side: str) -> DataFrame:
    """One row per bin of each interval, at its own level and at the coarser levels that the other side has."""
    there = other.groupBy(*keys).agg(F.collect_set(f"_own_{other_side}").alias("_there"))
    there = there.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_there")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    if keys:
        d = d.join(there, on).drop(*(f"_k{i}" for i in range(len(keys))))
    else:  # one list for all
        d = d.withColumn("_there", there.scalar())
    own = F.col(f"_own_{side}")
    use = F.array_distinct(
        F.concat(F.filter("_there", lambda x: x > own), F.when(F.array_min("_there") <= own, F.array(own)).otherwise(F.array().cast("array<int>")))
    )
    d = d.withColumn("_level", F.explode(use)).drop("_there")
    return d.withColumn("_bin", F.explode(F.sequence(_shift(f"_s_{side}", "_level"), _shift(f"_e_{side}", "_level"))))


def with_nearest(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_on: str, right_on: str, value: str, tol: int, only: Column | None = None
) -> DataFrame:
    """``left`` with ``nearest``, a struct (d, at, value) of the right row of equal keys nearest to ``left_on`` within ``tol``.

    At equal distance the smaller position wins. ``right`` must have at most one row per keys and position (aggregate it
    before). Null without a match, for null positions and where ``only`` isn't true. Null keys match each other.

    Positions meet in buckets of sixteen times ``tol + 1``. A right row is entered into those that its tolerance reaches,
    most often one, so that a left row asks a single bucket, which holds a bounded list of positions; ``left`` is shuffled
    at most once and not at all if the lists are small enough to broadcast.
    """
    width = 16 * (tol + 1)
    bucket = lambda c: ((c - F.pmod(c, F.lit(width))) / width).cast("long")
    b = right.select(*(F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)), F.col(right_on).cast("long").alias("at"), F.col(value).alias("value"))
    b = b.where("at is not null").withColumn("_rb", F.explode(F.array_distinct(F.array(bucket(F.col("at") - tol), bucket(F.col("at") + tol)))))
    b = b.groupBy("_rb", *(f"_r{i}" for i in range(len(keys)))).agg(F.collect_list(F.struct("at", "value")).alias("_list"))
    p = F.col(left_on).cast("long")
    a = left.withColumn("_b", F.coalesce(bucket(p), F.lit(0)))
    # a number leads the keys, so that sorts rarely compare texts
    on = [F.col("_b") == F.col("_rb"), *(F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys))]
    d = a.join(b, on, "left").drop("_b", "_rb", *(f"_r{i}" for i in range(len(keys))))
    far = lambda x: F.abs(x["at"] - p)
    best = F.array_min(F.transform(F.filter("_list", lambda x: far(x) <= tol), lambda x: F.struct(far(x).alias("d"), x["at"].alias("at"), x["value"].alias("value"))))
    asked = F.col("_list").isNotNull() if only is None else F.col("_list").isNotNull() & only
    return d.withColumn("nearest", F.when(asked, best)).drop("_list")


def nearest_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_id: str, left_on: str, right_on: str, value: str, tol: int
) -> DataFrame:
    """(left_id, nearest, value) of the left rows that have a match; see ``with_nearest``."""
    d = with_nearest(left.select(*keys, left_id, left_on), right, keys, left_on, right_on, value, tol)
    return d.where("nearest is not null").select(left_id, F.col("nearest.at").alias("nearest"), F.col("nearest.value").alias(value))


def support_totals(support: DataFrame, keys: tuple[str, ...], position: str, reads: str) -> DataFrame:
    """(*keys, position, reads): the callers' reads summed per position; null reads count 0, null positions are left out."""
    return (
        support.where(F.col(position).isNotNull())
        .groupBy(*keys, position)
        .agg(F.sum(F.coalesce(F.col(reads), F.lit(0))).alias(reads))
    )


def resolve_support(calls: DataFrame, support: DataFrame, keys: tuple[str, ...], record_id: str, position: str, tol: int) -> DataFrame:
    """``calls`` with supporting_reads of long-read records taken from the nearest caller position within ``tol``.

    ``support`` has the keys, ``position`` and ``supporting_reads``. The nearest position is chosen first; it changes
    the record only if its reads exceed 0, so a nearer position without reads hides a farther one with some.
    Rows that repeat a ``record_id`` are resolved each.
    """
    totals = support_totals(support, keys, position, "supporting_reads")
    d = with_nearest(calls, totals, keys, position, position, "supporting_reads", tol, F.col("source").startswith("long"))
    found = F.col("nearest.value")
    return d.withColumn("supporting_reads", F.when(found > 0, found).otherwise(F.col("supporting_reads"))).drop("nearest")


def flanks(df: DataFrame, row_id: str, chrom: str, start: str, end: str, keep: tuple[str, ...] = (), width: int = 100) -> DataFrame:
    """(*keep, row_id, chrom, side, beg0, end0): the ``width`` bases before and after each row, 0-based and half-open.

    Reversed coordinates are swapped, null ones count as 0, windows are cut at 0 and left out if nothing remains.
    """
    a, b = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in (start, end))
    d = df.select(*keep, F.col(row_id).alias("row_id"), F.col(chrom).alias("chrom"), F.least(a, b).alias("_s"), F.greatest(a, b).alias("_e"))
    zero = F.lit(0).cast("long")
    both = F.array(
        F.struct(F.lit("before").alias("side"), F.greatest(zero, F.col("_s") - width - 1).alias("beg0"), (F.col("_s") - 1).alias("end0")),
        F.struct(F.lit("after").alias("side"), F.greatest(zero, F.col("_e")).alias("beg0"), (F.col("_e") + width).alias("end0")),
    )
    return d.select(*keep, "row_id", "chrom", F.inline(both)).where("end0 > beg0")


#: Alignments that don't count for depth: unmapped, secondary, failed, duplicate.
DEPTH_EXCLUDES = 4 + 256 + 512 + 1024


def region_depth(regions: DataFrame, alignments: DataFrame, keys: tuple[str, ...], region_id: tuple[str, ...]) -> DataFrame:
    """(*region_id, depth): mean depth of each region, 0 without alignments.

    ``regions`` has the keys, the id columns (unique together), beg0 and end0; ``alignments`` the keys, a_beg0, a_end0
    and flag. Both are 0-based and half-open.
    """
    a = alignments.where(F.coalesce(F.col("flag"), F.lit(0)).bitwiseAND(F.lit(DEPTH_EXCLUDES)) == 0).select(*keys, "a_beg0", (F.col("a_end0") - 1).alias("a_last0"))
    r = regions.select(*keys, *region_id, "beg0", "end0", (F.col("end0") - 1).alias("last0"))
    pairs = overlap_join(r, a, keys, ("beg0", "last0"), ("a_beg0", "a_last0"))
    shared = F.least("last0", "a_last0") - F.greatest("beg0", "a_beg0") + 1
    rows = pairs.select(*region_id, "beg0", "end0", shared.alias("_n")).unionByName(
        r.select(*region_id, "beg0", "end0", F.lit(0).cast("long").alias("_n"))
    )
    return rows.groupBy(*region_id, "beg0", "end0").agg(F.sum("_n").alias("_n")).select(
        *region_id, (F.col("_n") / (F.col("end0") - F.col("beg0"))).alias("depth")
    )


def with_flank_coverage(df: DataFrame, row_id: str, depths: DataFrame) -> DataFrame:
    """``df`` with coverage_before_100bp and coverage_after_100bp from (row_id, side, depth); null where there is none."""
    wide = depths.groupBy("row_id").agg(
        *(F.max(F.when(F.col("side") == s, F.col("depth"))).alias(f"coverage_{s}_100bp") for s in ("before", "after"))
    )
    wide = wide.withColumnRenamed("row_id", "_row")
    return df.drop("coverage_before_100bp", "coverage_after_100bp").join(wide, F.col(row_id) == F.col("_row"), "left").drop("_row")


def merge_call_sets(calls: DataFrame, by: tuple[str, ...], caller: str, max_distance: int = 1000, min_size: int = 30, min_callers: int = 1) -> DataFrame:
    """Calls of several callers merged by breakpoint distance: chains of one type, with the number of callers in each.

    An optional kernel: calls shorter than ``min_size`` are left out, both breakpoints must lie within ``max_distance``
    of the chain's previous call. (*by, chrom, std_type, start1, end1, n_calls, n_callers).
    """
    from locuslathe.operators.events import chain_heads

    d = calls.where(F.coalesce(F.abs("svlen"), F.col("end1") - F.col("start1")) >= min_size)
    own = d.groupBy(*by, "chrom", "std_type", "start1", "end1").agg(F.count(F.lit(1)).alias("n"), F.collect_set(caller).alias("_c"))
    g = chain_heads(own, by, max_distance).groupBy(*by, "chrom", "std_type", "head_start", "head_end")
    out = g.agg(
        F.min("start1").alias("start1"), F.max("end1").alias("end1"), F.sum("n").alias("n_calls"),
        F.size(F.array_distinct(F.flatten(F.collect_set("_c")))).alias("n_callers"),
    )
    return out.where(F.col("n_callers") >= min_callers).drop("head_start", "head_end")
