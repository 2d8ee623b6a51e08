"""One group identifier for all records that pairwise matches link, directly or indirectly.

1. Peel: breadth-first search from the vertex of highest degree, one join of the frontier with the edges a round. If it
   ends within ``peel_rounds``, that component is complete and is anti-joined away. A component whose diameter is larger
   isn't walked to its end: what was reached is contracted to one vertex, so that no link is lost, and step 2 goes on.
2. Minimum propagation over the rest: every vertex takes the least of its neighbours and itself, a pointer jump doubles
   that, and the edges are rewritten to the vertices they point at. Each rewritten graph has fewer vertices by a constant
   factor, so long chains end after a logarithmic number of rounds, not after as many as they are long. The order used
   is a bit mix of the ids, which makes runs of descending ids short whatever the ids' order along a chain; it is
   undone at the end, so nothing but pairs of numbers is ever shuffled.
3. Once at most ``finish`` edges are left, which are counted each round, one task ends the propagation on two arrays of
   that bounded size.

The least record of each vertex is carried up with the contractions, so the group's identifier is known before the labels
go down again, one join per contraction. Vertices of high degree take their label from a broadcast table, which is small
as there can only be few of them; so a hub's edges are never gathered in a task.

Each round's pairs are written to the checkpoint folder, the round before is removed; the driver gets counts only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuslathe.session import release, write_through

#: Rounds of breadth-first search before the rest of a long component is left to propagation.
PEEL_ROUNDS = 6
#: Vertices of more edges than this, or of more than 1 / 50,000 of all, get their label by a broadcast join.
HEAVY = 200_000
#: Most edges (16 bytes each) that one task takes to the end of the propagation.
FINISH = 500_000


def cluster_links(clusters: DataFrame, members: str = "members", percentages: str = "percentage_overlaps") -> DataFrame:
    """(a, b) for each step of the member lists that links: both members present and different, its percentage not null."""
    n = F.size(members)
    steps = F.arrays_zip(
        F.slice(members, F.lit(1), n - 1).alias("a"), F.slice(members, F.lit(2), n - 1).alias("b"), F.col(percentages).alias("p")
    )
    return (
        clusters.where((n >= 2) & F.col(percentages).isNotNull())
        .select(F.inline(steps).alias("a", "b", "p"))
        .where("a is not null and b is not null and p is not null and a <> b")
        .select(F.col("a").cast("long"), F.col("b").cast("long"))
    )


_LOW = 0xFFFFFFFF


def _hash(c: Column) -> Column:
    return F.hash(c).cast("long").bitwiseAND(F.lit(_LOW))


def _halves(c: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(c, 32), c.bitwiseAND(F.lit(_LOW))


def _whole(high: Column, low: Column) -> Column:
    return F.shiftleft(high, 32).bitwiseOR(low)


def _mix(c: Column) -> Column:
    """A bijection of 64-bit integers (two rounds of a Feistel network), whose order has nothing to do with its arguments'."""
    high, low = _halves(c)
    a = high.bitwiseXOR(_hash(low))
    return _whole(a, low.bitwiseXOR(_hash(a)))


def _unmix(c: Column) -> Column:
    a, b = _halves(c)
    low = b.bitwiseXOR(_hash(a))
    return _whole(a.bitwiseXOR(_hash(low)), low)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _neighbours(edges: DataFrame) -> DataFrame:
    """(v, n, to): every vertex with its degree and the least of its neighbours and itself."""
    of = _both_ways(edges).groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("m"))
    return of.select(F.col("a").alias("v"), "n", F.least("a", "m").alias("to"))


def _look_up(df: DataFrame, key: str, table: DataFrame, name: str, heavy: DataFrame | None) -> DataFrame:
    """``df`` with the column ``name`` of ``table`` (v, name, ...), null where the key isn't in it.

    ``heavy`` holds the rows of frequent keys; those come by broadcast, and ``df``'s rows with them keep apart in the
    shuffle of the others.
    """
    rest = table.select(F.col("v").alias("_v"), F.col(name).alias(name))
    if heavy is None:
        return df.join(rest, F.col(key) == F.col("_v"), "left").drop("_v")
    hot = F.broadcast(heavy.select(F.col("v").alias("_h"), F.col(name).alias("_hot")))
    d = df.join(hot, F.col(key) == F.col("_h"), "left")
    # rows that have their answer are spread by a hash of all their columns
    d = d.withColumn("_k", F.when(F.col("_h").isNull(), F.col(key)).otherwise(F.xxhash64(*df.columns)))
    d = d.join(rest, F.col("_k") == F.col("_v"), "left")
    found = F.when(F.col("_h").isNotNull(), F.col("_hot")).otherwise(F.col(name))
    return d.select(*df.columns, found.alias(name))


def _frequent(table: DataFrame, edges: int, heavy: int) -> DataFrame | None:
    """The rows of ``table`` whose ``n`` is high, None if there are none; at most 2 * edges / limit of them."""
    some = table.where(F.col("n") > max(heavy, edges // 50_000))
    return None if some.isEmpty() else some


def _peel(edges: DataFrame, stats: DataFrame, rounds: int) -> tuple[DataFrame, bool]:
    """The vertices reached from the one of highest degree, and whether they are its whole component."""
    top = stats.agg(F.max(F.struct("n", (-F.col("v")).alias("neg"), "v")).alias("m")).head()["m"]["v"]
    arcs = _both_ways(edges)
    first = arcs.where(F.col("a") == top).select(F.col("b").alias("v"))
    seen = write_through(first.union(edges.sparkSession.range(1).select(F.lit(top).alias("v"))).distinct())
    frontier, olds = seen.where(F.col("v") != top), []  # the hub's own links are used up
    for _ in range(rounds - 1):
        step = arcs.join(frontier.select(F.col("v").alias("a")), "a", "left_semi").select(F.col("b").alias("v"))
        frontier = write_through(step.distinct().join(seen, "v", "left_anti"))
        olds.append(frontier)
        if frontier.isEmpty():
            release(*olds)
            return seen, True
        olds.append(seen)
        seen = write_through(seen.union(frontier))
    # the component may end just where the last round got to: it is whole if no link leaves what was reached
    last = arcs.join(frontier.select(F.col("v").alias("a")), "a", "left_semi").select(F.col("b").alias("v"))
    whole = last.join(seen, "v", "left_anti").isEmpty()
    release(*olds)
    return seen, whole


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, root): minimum propagation with full pointer jumping over edges held in memory."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    to = np.arange(len(names))
    while len(x):
        x, y = to[x], to[y]
        low, high = np.minimum(x, y), np.maximum(x, y)
        apart = low != high
        x, y = low[apart], high[apart]
        np.minimum.at(to, y, x)
        while True:
            further = to[to]
            if np.array_equal(further, to):
                break
            to = further
    return names, names[to]


def _finish(edges: DataFrame) -> DataFrame:
    """(v, root) of all vertices of few edges, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [np.zeros((2, 0), dtype=np.int64), *(np.stack([np.asarray(c) for c in batch.columns]) for batch in batches)]
        v, root = least_labels(*np.concatenate(own, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(root)], ["v", "root"])

    return edges.select("a", "b").repartition(1).mapInArrow(run, "v long, root long")


def _labels(edges: DataFrame, stats: DataFrame, count: int, heavy: int, finish: int) -> DataFrame:
    """(v, g): for every vertex of the edges the least record of its component. Releases ``edges`` and ``stats``."""
    hops: list[tuple[DataFrame, int]] = []
    while count > finish:
        stats = write_through(_neighbours(edges)) if stats is None else stats
        hot = _frequent(stats, count, heavy)
        # a pointer's target has at least as many edges as pointers, so the same vertices are frequent
        jumped = _look_up(stats.select("v", "n", F.col("to").alias("one")), "one", stats, "to", hot)
        hop = write_through(jumped.select("v", "n", "to"))
        hot = None if hot is None else hop.where(F.col("n") > max(heavy, count // 50_000))
        ends = _look_up(edges.select("a", "b"), "a", hop, "to", hot).select(F.col("to").alias("ra"), "b")
        ends = _look_up(ends, "b", hop, "to", hot).where(F.col("ra") != F.col("to"))
        ends = ends.select(F.least("ra", "to").alias("a"), F.greatest("ra", "to").alias("b")).distinct()
        shorter = write_through(ends)
        release(edges, stats)
        hops.append((hop, count))
        edges, stats, count = shorter, None, shorter.count()
    roots = write_through(_finish(edges))
    release(edges, stats)

    # up: the least record below each vertex
    below: list[DataFrame] = []
    for k, (hop, _) in enumerate(hops):
        m = hop.select("to", _unmix(F.col("v")).alias("m")) if k == 0 else _known(hop, below[-1]).select("to", "m")
        below.append(write_through(m.groupBy("to").agg(F.min("m").alias("m"), F.count(F.lit(1)).alias("n")).withColumnRenamed("to", "v")))
    # at the top: the least record of each root
    if below:
        top = below[-1].join(roots, "v", "left").select("v", F.coalesce("root", "v").alias("root"), "m", "n")
    else:
        top = roots.select("v", "root", _unmix(F.col("v")).alias("m"), F.lit(1).alias("n"))
    least = top.groupBy("root").agg(F.min("m").alias("g"), F.count(F.lit(1)).alias("n")).withColumnRenamed("root", "v")
    least = write_through(least)
    total = hops[-1][1] if hops else count
    labels = _look_up(top.select("v", "root"), "root", least, "g", _frequent(least, total, heavy)).select("v", "g")
    # and down again
    for k in range(len(hops) - 1, -1, -1):
        hop, count = hops[k]
        counted = below[k].select("v", "n")
        hot = _frequent(counted, count, heavy)
        hot = None if hot is None else hot.join(labels, "v")
        lower = _look_up(hop.select("v", "to"), "to", labels, "g", hot).select("v", "g")
        if k:  # vertices without edges at this level are groups of their own
            lower = below[k - 1].join(lower, "v", "left").select("v", F.coalesce("g", "m").alias("g"))
        labels = lower
    return labels


def _known(hop: DataFrame, below: DataFrame) -> DataFrame:
    return hop.select("v", "to").join(below.select("v", "m"), "v")


def link_groups(links: DataFrame, peel_rounds: int = PEEL_ROUNDS, heavy: int = HEAVY, finish: int = FINISH) -> DataFrame:
    """(record_id, group_id) for each record that a link joins to another; group_id is the least record_id linked.

    ``links`` has bigint columns a and b. Rows with a null, and links of a record with itself, link nothing. Repeated
    links and both directions of one count once. No links, no rows. Runs jobs while it plans.
    """
    spark = links.sparkSession
    ids = links.where("a is not null and b is not null and a <> b").select(_mix(F.col("a")).alias("a"), _mix(F.col("b")).alias("b"))
    edges = write_through(ids.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    count = edges.count()
    if not count:
        return spark.createDataFrame([], "record_id long, group_id long")
    stats = write_through(_neighbours(edges))
    peeled, whole = _peel(edges, stats, peel_rounds)
    least = peeled.agg(F.min(_unmix(F.col("v")))).head()[0]
    if whole:  # no edge crosses, so what is known of the other vertices stays true
        rest = edges.join(peeled.withColumnRenamed("v", "a"), "a", "left_anti")
        others = stats.join(peeled, "v", "left_anti")
        labels = _labels(rest, others, count, heavy, finish)
        release(edges, stats)
        out = labels.union(peeled.select("v", F.lit(least).alias("g")))
    else:  # the vertex of the least record stands for all that was reached
        giant = spark.range(1).select(_mix(F.lit(least).cast("long")).alias("v")).head()[0]
        inside = peeled.select("v", F.lit(giant).alias("to"))
        far = _look_up(edges, "a", inside, "to", None).select(F.coalesce("to", "a").alias("ra"), "b")
        far = _look_up(far, "b", inside, "to", None).select("ra", F.coalesce("to", "b").alias("rb")).where("ra <> rb")
        contracted = write_through(far.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        release(edges, stats)
        found = write_through(_labels(contracted, None, contracted.count(), heavy, finish))
        group = found.where(F.col("v") == giant).head()["g"]
        out = found.where(F.col("v") != giant).union(peeled.select("v", F.lit(group).alias("g")))
    return out.select(_unmix(F.col("v")).alias("record_id"), F.col("g").alias("group_id"))
