"""One surviving record per duplicate group, assembled from consistent bundles.

Fields that depend on each other form a bundle (raw and info type; chr2 and pos2; both coverages; ...), and only whole
bundles are taken from a record. For each bundle the candidates are the records' versions of it, with a trust; the
survivor takes one candidate per bundle so that the weighted trust is largest under functional dependencies between
bundles: for each determinant value there is one dependent value, that of the most trusted record that has both.

The search is branch and bound over the bundles, per group. What reaches it is small whatever the group's size: of all
records that agree in the values the dependencies mention (their signature), only the most trusted version of each
bundle can be in a best solution, and the signature values come from closed vocabularies, so a group has at most
``7 * 7 * 4`` candidates. That reduction is an aggregation with map-side combine, so a group with a third of all rows
neither gathers in a task nor slows one.

Records that have no duplicate are most of a table. Counting 64-bit hashes of the keys finds the groups that have more
than one record (a collision only lets a few records through, which the exact grouping then drops), and only records of
those groups are aggregated. The hashes are broadcast up to a measured number, beyond it only those of large groups, and
the others are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuslathe.functions.clean import bare_chrom, high, low
from locuslathe.functions.svtypes import std_type
from locuslathe.session import cut_lineage

#: Most key hashes (8 bytes each) that are broadcast.
BROADCAST_HASHES = 4_000_000
#: Beyond that, groups of more rows than this have their hashes broadcast; n rows have at most n / HEAVY such groups.
HEAVY = 200_000


@dataclass(frozen=True)
class Bundle:
    """Columns taken together. ``weight`` is its share in the trust that is maximised."""

    name: str
    columns: tuple[str, ...]
    weight: float = 1.0


@dataclass(frozen=True)
class Dependency:
    """``determinant`` and ``dependent`` are (bundle, signature column); null on either side constrains nothing."""

    determinant: tuple[str, str]
    dependent: tuple[str, str]


#: The first bundle identifies the survivor. No dependency mentions it, so it always is the most trusted record's.
CALL_BUNDLES = (
    Bundle("identity", ("record_id", "load_seq", "sample_id"), 100.0),
    Bundle("evidence", ("supporting_reads", "score", "supporting_methods"), 4.0),
    Bundle("length", ("svlen",), 3.0),
    Bundle("type", ("raw_svtype", "info_svtype"), 2.0),
    Bundle("partner", ("chr2", "pos2"), 2.0),
    Bundle("modified", ("start_mod", "end_mod"), 2.0),
    Bundle("coverage", ("coverage_before_100bp", "coverage_after_100bp", "copy_number"), 1.0),
    Bundle("times", ("called_at", "loaded_at"), 1.0),
)
#: How a caller signs lengths, and what its info column says, follows from how it spells types.
CALL_DEPENDENCIES = (
    Dependency(("type", "raw_std"), ("length", "sign")),
    Dependency(("type", "info_std"), ("length", "sign")),
)
GROUP = ("run_id", "source", "chrom", "std_type", "lo", "hi")


def choose_bundles(
    trust: list[list[float]],
    weights: list[float],
    signatures: list[dict[str, object]],
    dependencies: list[tuple[int, str, int, str]],
) -> list[int]:
    """Branch and bound: the candidate index per bundle with the largest weighted trust that breaks no dependency.

    ``trust[b][i]`` is the trust of candidate i's bundle b, ``signatures[i]`` its signature values. A dependency is
    (determinant bundle, column, dependent bundle, column). Candidate 0 must be the one most trusted as a record: for a
    determinant value, the first candidate with it and a dependent value defines the pair. Of equally good solutions
    the one with the earlier candidates wins. Taking one candidate for all bundles need not be legal, but candidate 0
    throughout is, so there always is a solution.
    """
    # a bundle that no dependency mentions is free to be its best; the search is over the others, few by their nature
    order = [sorted(range(len(t)), key=lambda i, t=t: (-t[i], i)) for t in trust]
    bound = sorted({b for db, _, pb, _ in dependencies for b in (db, pb)})
    free = [o[0] for o in order]
    if not bound:
        return free
    at = {b: i for i, b in enumerate(bound)}
    own = [(at[db], dc, at[pb], pc) for db, dc, pb, pc in dependencies]
    for b, i in zip(bound, _search([trust[b] for b in bound], [order[b] for b in bound], [weights[b] for b in bound], signatures, own), strict=True):
        free[b] = i
    return free


def _search(trust, order, weights, signatures, dependencies) -> list[int]:
    n_bundles = len(trust)
    legal = []
    for db, dc, pb, pc in dependencies:
        pairs: dict[object, object] = {}
        for s in signatures:
            if s[dc] is not None and s[pc] is not None:
                pairs.setdefault(s[dc], s[pc])
        legal.append((db, dc, pb, pc, pairs))
    tail = [0.0] * (n_bundles + 1)
    for b in range(n_bundles - 1, -1, -1):
        tail[b] = tail[b + 1] + weights[b] * trust[b][order[b][0]]
    best, best_value = [0] * n_bundles, sum(w * t[0] for w, t in zip(weights, trust, strict=True))
    chosen = [0] * n_bundles

    def fits(b: int) -> bool:
        for db, dc, pb, pc, pairs in legal:
            if (db == b and pb <= b) or (pb == b and db <= b):
                d, p = signatures[chosen[db]][dc], signatures[chosen[pb]][pc]
                if d is not None and p is not None and pairs.get(d, p) != p:
                    return False
        return True

    def branch(b: int, value: float) -> None:
        nonlocal best, best_value
        if b == n_bundles:
            if value > best_value + 1e-12:
                best, best_value = chosen.copy(), value
            return
        for i in order[b]:
            here = value + weights[b] * trust[b][i]
            if here + tail[b + 1] <= best_value + 1e-12:
                return  # later candidates of this bundle have no more trust
            chosen[b] = i
            if fits(b):
                branch(b + 1, here)

    branch(0, 0.0)
    return best


def _ranks(values: list[tuple]) -> list[float]:
    """Trust in (0, 1] by rank: equal values get equal trust."""
    distinct = {v: k + 1 for k, v in enumerate(sorted(set(values)))}
    return [distinct[v] / len(distinct) for v in values]


def _no_null(t: dict) -> tuple:
    return tuple((v is not None, v) if v is not None else (False, 0) for v in t.values())


def _of_repeated(rows: DataFrame, repeated: DataFrame, heavy: int) -> DataFrame:
    """The rows whose hash is repeated. Hashes of large groups, which are few, are broadcast; the groups' rows keep apart."""
    hot = F.broadcast(repeated.where(F.col("count") > heavy).select(F.col("_h").alias("_hot")))
    d = rows.join(hot, F.col("_h") == F.col("_hot"), "left")
    d = d.withColumn("_k", F.when(F.col("_hot").isNull(), F.col("_h")).otherwise(F.xxhash64("_h", "_trust")))
    d = d.join(repeated.select(F.col("_h").alias("_r")), F.col("_k") == F.col("_r"), "left")
    return d.where("_hot is not null or _r is not null").drop("_hot", "_k", "_r")


def survivors(
    df: DataFrame,
    group: dict[str, Column],
    bundles: tuple[Bundle, ...],
    dependencies: tuple[Dependency, ...],
    signature: dict[str, Column],
    record_trust: list[Column],
    recency: Column,
    broadcast_hashes: int = BROADCAST_HASHES,
    heavy: int = HEAVY,
) -> DataFrame:
    """One row per group of two or more records: the group columns, ``n_records``, then every bundle's columns.

    ``group`` gives the key columns; null keys must be filtered by the caller where they mean no group. The identity
    bundle (the first) comes from the record with the largest ``record_trust`` (lexicographic, no nulls); any other
    bundle's trust is its number of filled fields, then the record's trust, then ``recency``. ``signature`` columns
    must have closed vocabularies. Single records give no row, an empty table none. Exact repetitions of a record count
    as records and change nothing else. Columns of ``df`` that no argument names are not read. Runs one job to find
    the groups.
    """
    keys = [f"_g{i}" for i in range(len(group))]
    sig = [f"_s{i}" for i in range(len(signature))]
    key_hash = F.xxhash64(*group.values()).alias("_h")
    repeated = cut_lineage(df.select(key_hash).groupBy("_h").count().where("count > 1"))
    rows = df.select(
        key_hash,
        *(c.alias(k) for k, c in zip(keys, group.values(), strict=True)),
        *(c.alias(s) for s, c in zip(sig, signature.values(), strict=True)),
        F.struct(*(c.alias(f"r{i}") for i, c in enumerate(record_trust))).alias("_trust"),
        recency.alias("_recent"),
        *(F.struct(*b.columns).alias(f"_b{i}") for i, b in enumerate(bundles)),
    )
    if repeated.count() <= broadcast_hashes:
        rows = rows.join(F.broadcast(repeated.select("_h")), "_h", "left_semi")
    else:
        rows = _of_repeated(rows, repeated, heavy)

    def version(i: int, b: Bundle) -> Column:
        filled = sum((F.col(f"_b{i}.{c}").isNotNull().cast("int") for c in b.columns), F.lit(0))
        head = [F.lit(0) if i == 0 else filled]
        return F.max(F.struct(F.struct(*(h.alias("filled") for h in head), F.col("_trust").alias("trust"), F.col("_recent").alias("recent")).alias("t"), F.col(f"_b{i}").alias("v"))).alias(f"_b{i}")

    versions = rows.groupBy(*keys, *sig).agg(
        F.count(F.lit(1)).alias("_n"), *(version(i, b) for i, b in enumerate(bundles))
    )
    # candidates in the order of their record's trust: the first one decides what a dependency's pairs are
    cand = F.struct(F.struct("_b0.t", *sig).alias("key"), F.col("_n"), *(F.col(f"_b{i}") for i in range(len(bundles))))
    groups = (
        versions.groupBy(*keys)
        .agg(F.sum("_n").alias("n_records"), F.sort_array(F.collect_list(cand), asc=False).alias("cands"))
        .where("n_records > 1")
    )
    at = {b.name: i for i, b in enumerate(bundles)}
    s_at = {name: s for name, s in zip(signature, sig, strict=True)}
    deps = [
        (at[d.determinant[0]], s_at[d.determinant[1]], at[d.dependent[0]], s_at[d.dependent[1]]) for d in dependencies
    ]
    weights = [b.weight for b in bundles]
    schema = T.StructType([*groups.schema.fields, T.StructField("_pick", T.ArrayType(T.IntegerType()))])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cands, picks = batch.column("cands"), []
            sizes = pa.compute.list_value_length(cands).to_pylist()
            for i, size in enumerate(sizes):
                if size == 1:
                    picks.append([0] * len(weights))  # one candidate: the bound is reached at the root
                    continue
                own = cands[i].as_py()
                trust = []
                for b in range(len(weights)):
                    t = [c[f"_b{b}"]["t"] for c in own]
                    trust.append(_ranks([(x["filled"], tuple(x["trust"].values()), _no_null({"r": x["recent"]})) for x in t]))
                signs = [{s: c["key"][s] for s in sig} for c in own]
                picks.append(choose_bundles(trust, weights, signs, deps))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(picks, pa.list_(pa.int32()))], [*batch.schema.names, "_pick"]
            )

    solved = groups.mapInArrow(solve, schema)
    out = [F.col(k).alias(n) for k, n in zip(keys, group, strict=True)] + [F.col("n_records")]
    for i, b in enumerate(bundles):
        chosen = F.get(F.col("cands"), F.get("_pick", F.lit(i)))[f"_b{i}"]["v"]
        out += [chosen[c].alias(c) for c in b.columns]
    return solved.select(*out)


def call_survivors(records: DataFrame) -> DataFrame:
    """The survivors of structural-variant calls that agree in run, source, chromosome, type and both coordinates.

    The record itself is the one with most supporting reads, then the highest score, then the smallest absolute svlen
    (a null counts as -1 in each), then the smallest load_seq, then the smallest record_id. Records without chromosome
    or coordinate are in no group; a null run_id, source or std_type is a value like any other.
    """
    rows = records.withColumns(
        {"_chrom": bare_chrom("chrom"), "_lo": low("start_pos", "end_pos"), "_hi": high("start_pos", "end_pos")}
    ).where("_chrom is not null and _lo is not null")
    order = [
        F.coalesce(F.col("supporting_reads"), F.lit(-1)),
        F.coalesce(F.col("score"), F.lit(-1.0)),
        -F.coalesce(F.abs("svlen"), F.lit(-1)),
        -F.coalesce(F.col("load_seq"), F.lit(2**62)),
        -F.coalesce(F.col("record_id"), F.lit(2**62)),
    ]
    return survivors(
        rows,
        dict(zip(GROUP, (F.col("run_id"), F.col("source"), F.col("_chrom"), F.col("std_type"), F.col("_lo"), F.col("_hi")), strict=True)),
        CALL_BUNDLES,
        CALL_DEPENDENCIES,
        {
            "raw_std": std_type(F.lit(None).cast("string"), F.col("raw_svtype"), F.col("source")),
            "info_std": F.when(F.col("info_svtype").rlike("[A-Za-z]"), std_type(F.lit(None).cast("string"), F.col("info_svtype"), F.lit(""))),
            "sign": F.signum("svlen").cast("int"),
        },
        order,
        F.col("loaded_at"),
    )
