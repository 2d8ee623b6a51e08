"""Events from calls: chains of close intervals, the best record per source, anchors, ids and links.

Nothing here gathers the calls of a chromosome and type in one task, although a chain is a walk in sort order:

* Calls with equal coordinates always chain, so the calls are first reduced to distinct intervals (with map-side
  combine), each with the rank and id of its best record per source and its number of copies.
* The walk looks back by one interval only. It runs per tile of ``2**TILE_BITS`` bases, where the rows before the first
  break belong to a chain that may have begun in a tile before. Whether it has, and where, is decided on a table with
  one row per tile; only the first and the last chain of a tile are ever put together across tiles.
* Event numbers are ranks inside a tile plus the number of events in the tiles before.
* Chains, numbers and links are made of ranks, ids and coordinates alone. The other fields of the best records join at
  the end, by record_id, which no key can skew.

A chain's steps are summed and counted on the way; the list of all of them is only made where it is asked for, as the
result tables print it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuslathe.functions.intervals import format_link, linked_relation, near_overlap, overlap_length, overlap_percent
from locuslathe.operators.interval_join import overlap_join
from locuslathe.session import write_through

TILE_BITS = 20
SOURCES = ("asm", "long_ont", "long_pacbio", "short")
#: Fields of the best records that no step before the last one needs.
_PAYLOAD = (
    "raw_svtype", "info_svtype", "score", "copy_number", "chr2", "pos2", "supporting_methods", "start_mod", "end_mod",
    "coverage_before_100bp", "coverage_after_100bp",
)


def best_rank(seq: Column) -> Column:
    """A struct whose maximum is the best record of one interval: most reads, highest score, least |svlen|, then first.

    A null counts as -1 in each of the three. For the length that means a record without one beats any that has one.
    """
    return F.struct(
        F.coalesce(F.col("supporting_reads"), F.lit(-1)).alias("reads"),
        F.coalesce(F.col("score"), F.lit(-1.0)).alias("score"),
        (-F.coalesce(F.abs("svlen"), F.lit(-1))).alias("len"),
        (-seq).alias("q"),
    )


def distinct_intervals(calls: DataFrame, by: tuple[str, ...], seq: Column) -> DataFrame:
    """One row per distinct interval of a group: copies and, per source, the best record's rank, id and reads."""
    keys = ["start1", "end1", *by, "chrom", "std_type"]  # a number first, as rows are sorted by their first bytes
    best = F.struct(best_rank(seq).alias("rank"), F.struct("record_id", "supporting_reads").alias("rec"))
    d = calls.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *(F.max(F.when(F.col("source") == s, best)).alias(s) for s in SOURCES)
    )
    return d.select(*by, "chrom", "std_type", "start1", "end1", "n", *SOURCES)


def _chain_rank(s: str) -> Column:
    """The rank among the best records of a chain's intervals: of equal ones the first in chain order."""
    r = F.col(s)["rank"]
    rank = F.struct(
        r["reads"].alias("reads"), r["score"].alias("score"), r["len"].alias("len"), (-F.col("start1")).alias("s"), (-F.col("end1")).alias("e"), r["q"].alias("q")
    )
    return F.when(F.col(s).isNotNull(), F.struct(rank.alias("rank"), F.col(s)["rec"].alias("rec")))


def _of_best(s: str) -> dict[str, Column]:
    """|svlen|, start and end of a source's best record, as its rank tells them."""
    r = F.col(s)["rank"]
    return {"svlen": F.when(r["len"] != 1, -r["len"]), "start1": -r["s"], "end1": -r["e"]}


_HERE = ("start1", "end1")


def _cell(*keys: str) -> Column:
    """A number for the keys of a group; leading them, it spares sorts the comparison of texts that begin alike."""
    return F.hash(*keys)


def _walk(intervals: DataFrame, by: tuple[str, ...], tol: int, tile_bits: int) -> DataFrame:
    """``intervals`` with ``_tile``, ``_part`` and ``step_percent`` from the walk through each tile by itself.

    ``_part`` counts the breaks so far; the rows of part 0 stand before the tile's first break, and their chain may come
    from a tile before. ``_last`` marks a tile's last row.
    """
    g = [*by, "chrom", "std_type"]
    tile = Window.partitionBy("_cell", *g, "_tile").orderBy(*_HERE)
    d = intervals.withColumn("_tile", F.shiftright("start1", tile_bits))
    d = d.withColumn("_cell", _cell(*g, "_tile"))
    d = d.withColumns({"_ps": F.lag("start1").over(tile), "_pe": F.lag("end1").over(tile), "_last": F.lead("start1").over(tile).isNull()})
    p = (F.col("_ps"), F.col("_pe"), F.col("start1"), F.col("end1"))
    d = d.withColumn("_joined", F.when(F.col("_ps").isNotNull(), near_overlap(*p, tol)))
    breaks = F.sum(F.when(~F.col("_joined"), F.lit(1)).otherwise(F.lit(0))).over(tile.rowsBetween(Window.unboundedPreceding, 0))
    return d.withColumns({"_part": breaks, "step_percent": F.when(F.col("_joined"), overlap_percent(*p))}).drop("_ps", "_pe", "_joined")


def _carried(tiles: DataFrame, by: tuple[str, ...], tol: int) -> DataFrame:
    """(*group, _tile, _open_head, _open_percent) from one row per tile: its first and last interval and its last head.

    The rows before the first break of a tile continue the chain of the tile before, or begin one of their own.
    """
    g = [*by, "chrom", "std_type"]
    across = Window.partitionBy(*g).orderBy("_tile")
    t = tiles.withColumn("_before", F.lag("_end").over(across))
    p = (F.col("_before.s"), F.col("_before.e"), F.col("_first.s"), F.col("_first.e"))
    t = t.withColumn("_on", F.coalesce(near_overlap(*p, tol), F.lit(False)))
    own = F.coalesce("_max_head", F.when(~F.col("_on"), F.col("_first")))
    t = t.withColumn("_own", own)
    last = F.last("_own", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))
    return t.withColumn("_from", last).select(
        *g, "_tile", F.when(F.col("_on"), F.col("_from")).otherwise(F.col("_first")).alias("_open_head"),
        F.when(F.col("_on"), overlap_percent(*p)).alias("_open_percent"),
    )


def chain_heads(intervals: DataFrame, by: tuple[str, ...], tol: int, tile_bits: int = TILE_BITS) -> DataFrame:
    """``intervals`` (distinct per group) with ``head_start``, ``head_end`` of their chain and ``step_percent``.

    Sorted by start and end, an interval continues the chain if it is ``near_overlap`` to the one right before it;
    ``step_percent`` is the overlap of the two, null at a head.
    """
    g = [*by, "chrom", "std_type"]
    here = F.struct(F.col("start1").alias("s"), F.col("end1").alias("e"))
    d = _walk(intervals, by, tol, tile_bits)
    own = Window.partitionBy("_cell", *g, "_tile", "_part")
    d = d.withColumn("_head", F.when(F.col("_part") > 0, F.min(here).over(own)))
    tiles = d.groupBy(*g, "_tile").agg(F.min(here).alias("_first"), F.max(here).alias("_end"), F.max("_head").alias("_max_head"))
    d = _join_small(d, _carried(tiles, by, tol), [*g, "_tile"])
    tile = Window.partitionBy("_cell", *g, "_tile").orderBy(*_HERE)
    percent = F.when(F.row_number().over(tile) == 1, F.col("_open_percent")).otherwise(F.col("step_percent"))
    head = F.coalesce("_head", "_open_head")
    return d.withColumns({"head_start": head["s"], "head_end": head["e"], "step_percent": percent}).drop(
        "_cell", "_tile", "_part", "_last", "_head", "_open_head", "_open_percent"
    )


def _join_small(d: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null, with one row per key in ``table``."""
    renamed = table.select(*(F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)), *(c for c in table.columns if c not in keys))
    on = [F.col(k).eqNullSafe(F.col(f"_j{i}")) for i, k in enumerate(keys)]
    return d.join(renamed, on, "left").drop(*(f"_j{i}" for i in range(len(keys))))


def clusters(
    calls: DataFrame, by: tuple[str, ...] = (), tol: int = 10, seq: Column | None = None, steps: bool = True, tile_bits: int = TILE_BITS
) -> DataFrame:
    """One row per chain: group, chrom, std_type, cluster_start, cluster_end, last_start, first_end, n_members,
    percent_total (of its n_members - 1 steps), and per source the best record.

    With ``steps`` also their list, (start1, end1, percent, copies) of the distinct intervals in chain order. Runs a job
    to materialise the chains of the tiles.
    """
    g = [*by, "chrom", "std_type"]
    here = F.struct(F.col("start1").alias("s"), F.col("end1").alias("e"))
    q = F.col("seq") if seq is None else seq
    d = _walk(distinct_intervals(calls, by, q), by, tol, tile_bits)
    listed = [F.collect_list(F.struct("start1", "end1", "step_percent", "n")).alias("steps")] if steps else []
    parts = d.groupBy("_cell", *g, "_tile", "_part").agg(
        F.min("start1").alias("cluster_start"),
        F.max("end1").alias("cluster_end"),
        F.max("start1").alias("last_start"),
        F.min("end1").alias("first_end"),
        F.sum("n").alias("n_members"),
        (F.coalesce(F.sum("step_percent"), F.lit(0.0)) + F.sum(F.col("n") - 1) * F.lit(100.0)).alias("percent_total"),
        F.min(here).alias("_first"),
        F.max(here).alias("_end"),
        F.max("_last").alias("_last"),
        *listed,
        *(F.max(_chain_rank(s)).alias(s) for s in SOURCES),
    )
    parts = write_through(parts)
    tiles = parts.groupBy("_cell", *g, "_tile").agg(
        F.min("_first").alias("_first"), F.max("_end").alias("_end"), F.max(F.when(F.col("_part") > 0, F.col("_first"))).alias("_max_head")
    )
    carried = _carried(tiles, by, tol)
    # the first and the last chain of a tile may belong to those of others
    edge = (F.col("_part") == 0) | F.col("_last")
    made = ["cluster_start", "cluster_end", "last_start", "first_end", "n_members", "percent_total", *(["steps"] if steps else []), *SOURCES]
    inner = parts.where(~edge).select(*g, *made)
    outer = _join_small(parts.where(edge), carried, [*g, "_tile"])
    own = F.col("_part") == 0
    outer = outer.withColumns(
        {
            "_head": F.when(own, F.col("_open_head")).otherwise(F.col("_first")),
            "percent_total": F.col("percent_total") + F.when(own, F.coalesce("_open_percent", F.lit(0.0))).otherwise(F.lit(0.0)),
        }
    )
    if steps:
        first = lambda x: (x["start1"] == F.col("_first.s")) & (x["end1"] == F.col("_first.e"))
        with_percent = F.transform("steps", lambda x: F.when(first(x), x.withField("step_percent", F.col("_open_percent"))).otherwise(x))
        outer = outer.withColumn("steps", F.when(own, with_percent).otherwise(F.col("steps")))
    outer = outer.groupBy(*g, "_head").agg(
        F.min("cluster_start").alias("cluster_start"),
        F.max("cluster_end").alias("cluster_end"),
        F.max("last_start").alias("last_start"),
        F.min("first_end").alias("first_end"),
        F.sum("n_members").alias("n_members"),
        F.sum("percent_total").alias("percent_total"),
        *([F.flatten(F.collect_list("steps")).alias("steps")] if steps else []),
        *(F.max(s).alias(s) for s in SOURCES),
    )
    out = inner.unionByName(outer.select(*g, *made))
    return out.withColumn("steps", F.array_sort("steps")) if steps else out


def step_percentages(steps: Column) -> Column:
    """The percentage of every merge step in chain order; copies of an interval follow it at 100."""
    one = lambda x: F.concat(
        F.when(x["step_percent"].isNull(), F.array().cast("array<double>")).otherwise(F.array(x["step_percent"])),
        F.array_repeat(F.lit(100.0), (x["n"] - 1).cast("int")),
    )
    return F.flatten(F.transform(steps, one))


def anchor(records: dict[str, Column | dict[str, Column]]) -> Column:
    """struct(event_length_bp, event_start, event_end) of the source that reports the least length; null without any.

    Of sources with equal least lengths, the one whose interval shares most bases with the other candidates, then the
    first in the order of ``records``. Sums and comparisons only, so that it is compiled with the rows' other expressions.
    """
    names = list(records)
    size = {s: F.abs(r["svlen"]) for s, r in records.items()}
    span = {s: (r["start1"], r["end1"]) for s, r in records.items()}
    least = F.least(*size.values())

    def shared(s: str) -> Column:
        both = lambda o: F.when(size[o].isNotNull(), overlap_length(*span[s], *span[o])).otherwise(F.lit(0))
        return sum((both(o) for o in names if o != s), F.lit(0).cast("long"))

    score = {s: F.when(size[s] == least, shared(s)) for s in names}
    top = F.greatest(*score.values())
    best = F.lit(None).cast("struct<event_length_bp:bigint,event_start:bigint,event_end:bigint>")
    for s in reversed(names):
        own = F.struct(size[s].alias("event_length_bp"), span[s][0].alias("event_start"), span[s][1].alias("event_end"))
        best = F.when(score[s] == top, own).otherwise(best)
    return best


def _tiled(d: DataFrame, by: tuple[str, ...], tile_bits: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """``d`` with its tile, one row per tile with the number of events of its group and type before it, and the tile's keys.

    A tile's row sorts before its events: it starts a base earlier.
    """
    tile = ["_cell", *by, "std_type", "chrom", "_tile"]
    d = d.withColumn("_tile", F.shiftright("cluster_start", tile_bits)).withColumn("_cell", _cell(*tile[1:]))
    sizes = d.groupBy(*tile).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(*by, "std_type").orderBy("chrom", "_tile").rowsBetween(Window.unboundedPreceding, -1)
    edge = F.shiftleft("_tile", tile_bits) - 1
    offsets = sizes.select(
        *tile, edge.alias("cluster_start"), edge.alias("cluster_end"), F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before")
    )
    return d, offsets, tile


def _numbered(rows: DataFrame, offsets: DataFrame, tile: list[str]) -> DataFrame:
    """``rows``, one or several per event, with ``event_id``; a tile's offset comes as a row, so they are shuffled once."""
    both = rows.withColumn("_before", F.lit(None).cast("long")).unionByName(offsets, allowMissingColumns=True)
    w = Window.partitionBy(*tile).orderBy("cluster_start", "cluster_end")
    # the same frame as the rank's, so that both are walked once
    first = F.first("_before").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    number = first + F.dense_rank().over(w) - 1
    return both.withColumn("event_id", F.concat("std_type", F.lit("_"), number.cast("string"))).where("_before is null")


def number_events(d: DataFrame, by: tuple[str, ...], tile_bits: int = TILE_BITS) -> DataFrame:
    """``event_id`` TYPE_n, counted per group and type in the order of chromosome and cluster start."""
    return _numbered(*_tiled(d, by, tile_bits)).drop("_cell", "_tile", "_before")


def _source_columns(s: str, r: Column) -> list[Column]:
    long = [
        ("start", "start1"), ("end", "end1"), ("length", "svlen"), ("info_svtype", "info_svtype"), ("score", "score"),
        ("supporting_reads", "supporting_reads"), ("supporting_methods", "supporting_methods"),
        ("coverage_before_100bp", "coverage_before_100bp"), ("coverage_after_100bp", "coverage_after_100bp"),
    ]
    fields = {
        "asm": [
            ("start", "start1"), ("end", "end1"), ("start_mod", "start_mod"), ("end_mod", "end_mod"),
            ("length", "svlen"), ("svtype_raw", "raw_svtype"),
        ],
        "short": [
            ("start", "start1"), ("end", "end1"), ("length", "svlen"), ("svtype_raw", "raw_svtype"),
            ("info_svtype", "info_svtype"), ("chr2", "chr2"), ("pos2", "pos2"), ("score", "score"),
            ("supporting_reads", "supporting_reads"), ("reads_copy_number_estimate", "copy_number"),
            ("coverage_before_100bp", "coverage_before_100bp"), ("coverage_after_100bp", "coverage_after_100bp"),
        ],
    }.get(s, long)
    out = []
    for name, field in fields:
        c = r[field]
        if s.startswith("long") and name == "score":  # a call that its info type proves has a score
            c = F.when(c.isNull() & r["info_svtype"].isNotNull() & (r["info_svtype"] != ""), F.lit(0.0)).otherwise(c)
        out.append(c.alias(f"{s}_{name}"))
    if s == "asm":
        out.append(F.lit(1).alias("asm_score"))
    return out


def _located(clustered: DataFrame, spans: dict[str, dict[str, Column]]) -> DataFrame:
    """Chains with the coordinates and the length of their events and the number of sources that support them.

    ``spans``: svlen, start1 and end1 of each source's best record.
    """
    fields = {f"_{n}_{s}": r[n] for s, r in spans.items() for n in ("svlen", "start1", "end1")}
    d = clustered.withColumns(fields)
    d = d.withColumn("_a", anchor({s: {n: F.col(f"_{n}_{s}") for n in ("svlen", "start1", "end1")} for s in spans})).drop(*fields)
    # without any length an insertion spans its cluster; other types always have one once cleaned
    lone = F.col("_a").isNull() & (F.col("std_type") != "INS")
    return d.withColumns(
        {
            "event_start": F.coalesce("_a.event_start", F.when(lone, F.col("last_start")).otherwise(F.col("cluster_start"))),
            "event_end": F.coalesce("_a.event_end", F.when(lone, F.col("first_end")).otherwise(F.col("cluster_end"))),
            "event_length_bp": F.col("_a.event_length_bp"),
            "support_score": sum((F.col(s).isNotNull().cast("int") for s in SOURCES), F.lit(0)),
        }
    ).drop("_a")


_EVENT = ("event_start", "event_end", "event_length_bp", "support_score")


def event_spans(clustered: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The events of chains with their ids and coordinates, without their records' fields."""
    d = number_events(_located(clustered, {s: _of_best(s) for s in SOURCES}), by)
    return d.select(*by, "event_id", "chrom", F.col("std_type").alias("std_svtype"), *_EVENT)


def event_table(clustered: DataFrame, calls: DataFrame, by: tuple[str, ...] = (), tile_bits: int = TILE_BITS) -> DataFrame:
    """The event rows in the order of the result tables' columns, after ``by``; see ``merge_events``.

    The best records' other fields come from ``calls`` by record_id; of rows that share one, one is taken whole. Then an
    event's records meet in its tile, where it is numbered, too.
    """
    d, offsets, tile = _tiled(clustered, by, tile_bits)
    def pick(s: str) -> Column:
        there = F.col(s).isNotNull()
        if s == SOURCES[0]:  # an event without a best record stays, by this row
            there = there | F.coalesce(*SOURCES).isNull()
        own = _of_best(s).items()
        return F.struct(F.lit(SOURCES.index(s)).alias("_source"), F.col(f"{s}.rec.record_id").alias("_id"), F.col(f"{s}.rec.supporting_reads").alias("supporting_reads"), *(c.alias(n) for n, c in own), there.alias("_there"))

    picks = F.array(*(pick(s) for s in SOURCES))
    keys = [*tile, "cluster_start", "cluster_end"]
    carried = ["last_start", "first_end", *(["steps"] if "steps" in clustered.columns else [])]
    # these two are for events without any length only
    none = F.coalesce(*(_of_best(s)["svlen"] for s in SOURCES)).isNull()
    d = d.withColumns({c: F.when(none, F.col(c)) for c in ("last_start", "first_end")})
    rows = d.select(*keys, *carried, F.inline(picks)).where("_there").drop("_there")
    # rows without a record keep apart in the shuffle
    rows = rows.withColumn("_k", F.coalesce("_id", F.xxhash64(*keys))).drop("_id")
    fields = calls.select(F.col("record_id").alias("_record"), *_PAYLOAD)
    rows = rows.join(fields, (F.col("_k") == F.col("_record")) & F.col("start1").isNotNull(), "left").drop("_k", "_record")
    whole = F.struct("start1", "end1", "svlen", "supporting_reads", *_PAYLOAD)
    # the rows come in the order of these keys, so this neither shuffles nor sorts
    d = _numbered(rows, offsets, tile).groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in ("event_id", *carried)), *(F.max(F.when((F.col("_source") == i) & F.col("start1").isNotNull(), whole)).alias(s) for i, s in enumerate(SOURCES))
    )
    d = _located(d, {s: {n: F.col(s)[n] for n in ("svlen", "start1", "end1")} for s in SOURCES})
    return d.select(
        *by,
        "event_id",
        "chrom",
        F.col("std_type").alias("std_svtype"),
        *_EVENT[:-1],
        *(c for s in SOURCES for c in _source_columns(s, F.col(s))),
        *([step_percentages(F.col("steps")).alias("step_percentages")] if "steps" in carried else []),
        "support_score",
    )


def merge_events(
    calls: DataFrame, by: tuple[str, ...] = (), tol: int = 10, seq: Column | None = None, steps: bool = True, fields: DataFrame | None = None
) -> DataFrame:
    """Events of cleaned calls, per group ``by`` (a run).

    ``calls`` are those of ``calls.good_calls`` with a record_id and the load order ``seq``. Chains of close intervals of
    one chromosome and type become an event; its coordinates and length are those of the best record whose source
    reports the least length. No calls, no events. ``steps``: with the list step_percentages. ``fields``: where the best
    records' other fields are read; for calls that took costly joins, the rows before them. Runs a job.
    """
    return event_table(clusters(calls, by, tol, seq, steps), calls if fields is None else fields, by)


def link_events(events: DataFrame, by: tuple[str, ...] = (), tol: int = 0) -> DataFrame:
    """(*by, event_id, other_id, other_type, chrom, other_start, other_end, relation): both directions of each link.

    Events of a chromosome are linked whatever their types if they overlap, or with ``tol`` > 0 if both ends lie within
    it. Runs a job to materialise the events.
    """
    # the join reads its sides several times; the events behind them are computed once
    e = write_through(events.select(*by, "event_id", "chrom", "std_svtype", "event_start", "event_end"))
    o = e.select(*by, F.col("event_id").alias("other_id"), "chrom", F.col("std_svtype").alias("other_type"),
                 F.col("event_start").alias("other_start"), F.col("event_end").alias("other_end"))
    pairs = overlap_join(e, o, (*by, "chrom"), ("event_start", "event_end"), ("other_start", "other_end"), tol)
    rel = linked_relation(*(F.col(c) for c in ("event_start", "event_end", "other_start", "other_end")), tol)
    return (
        pairs.where("event_id <> other_id")
        .withColumn("relation", rel)
        .where("relation is not null")
        .select(*by, "event_id", "other_id", "other_type", "chrom", "other_start", "other_end", "relation")
    )


def linked_lists(events: DataFrame, by: tuple[str, ...] = (), tol: int = 0) -> DataFrame:
    """``events`` with ``links``, an array of structs in partner order, and ``linked_event``, its text ('' for none)."""
    events = write_through(events)
    one = F.struct("other_start", "other_end", "other_type", "other_id", "chrom", "relation")
    lists = link_events(events, by, tol).groupBy(*by, "event_id").agg(F.array_sort(F.collect_list(one)).alias("links"))
    d = _join_small(events, lists, [*by, "event_id"])
    d = d.withColumn("links", F.coalesce("links", F.expr("filter(array(named_struct('other_start', 0L, 'other_end', 0L, 'other_type', '', 'other_id', '', 'chrom', '', 'relation', '')), x -> false)")))
    text = lambda x: format_link(x["other_id"], x["other_type"], x["chrom"], x["other_start"], x["other_end"], x["relation"])  # noqa: E731, E501
    return d.withColumn("linked_event", F.array_join(F.array_distinct(F.transform("links", text)), "; "))
