"""Group identifiers against union-find."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuslathe.llm.components import _mix, _unmix, cluster_links, least_labels, link_groups


def union_find(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def run(spark, pairs, **kw):
    df = spark.createDataFrame([(a, b, 0) for a, b in pairs], "a long, b long, root long")
    return {r.record_id: r.group_id for r in link_groups(df, **kw).collect()}


def test_shapes(spark):
    chain = [(i, i + 1) for i in range(1, 400)]
    star = [(1000, 1001 + i) for i in range(600)]
    rng = random.Random(4)
    web = [(rng.randint(5000, 5300), rng.randint(5000, 5300)) for _ in range(150)]
    odd = [(-5, -9), (-9, -5), (7000, 7000), (None, 1), (8000, None), (2**62, -(2**62))]
    pairs = chain + star + web + odd + star[:5]
    rng.shuffle(pairs)
    want = union_find(pairs)
    assert run(spark, pairs, heavy=50) == want
    assert run(spark, pairs, heavy=50, finish=3) == want  # several contractions, hubs by broadcast
    assert run(spark, pairs, heavy=3, finish=0, peel_rounds=1) == want


@pytest.mark.parametrize("rounds", [1, 3])
def test_long_component_with_the_hub(spark, rounds):
    pairs = [(500, i) for i in range(501, 520)] + [(i, i + 1) for i in range(519, 640)] + [(2, 500), (900, 901)]
    assert run(spark, pairs, peel_rounds=rounds) == union_find(pairs)


@pytest.mark.parametrize("rounds", [1, 2, 6])
@pytest.mark.parametrize("others", [[], [(900, 901), (901, 902)]])
def test_hub_component_that_ends_with_the_last_round(spark, rounds, others):
    pairs = [(500, i) for i in range(501, 520)] + [(i, i + 1) for i in range(519, 518 + rounds)] + others
    assert run(spark, pairs, peel_rounds=rounds) == union_find(pairs)


def test_mix_is_undone(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 2**32, -(2**32), 12345678901]
    d = spark.createDataFrame([(i,) for i in ids], "i long").select("i", _mix(F.col("i")).alias("m"), _unmix(_mix(F.col("i"))).alias("u"))
    rows = d.collect()
    assert all(r.i == r.u for r in rows) and len({r.m for r in rows}) == len(ids)


def test_least_labels():
    rng = random.Random(8)
    for n in (0, 1, 5, 60, 400):
        pairs = [(rng.randint(0, n), rng.randint(0, n)) for _ in range(n)]
        v, root = least_labels(*np.array(pairs, dtype=np.int64).reshape(-1, 2).T)
        want = union_find([(a, b) for a, b in pairs if a != b])
        assert {x: r for x, r in zip(v.tolist(), root.tolist(), strict=True) if x in want} == want
    chain = np.arange(100_000)
    assert set(least_labels(chain[1:], chain[:-1])[1].tolist()) == {0}


def test_nothing_linked(spark):
    assert run(spark, []) == {} and run(spark, [(1, 1), (None, 2)]) == {}


def test_steps_of_clusters(spark):
    rows = [
        (1, [1, 2, 3], [0.0, None]), (2, [4, None, 5], [1.0, 1.0]), (3, [6, 7], None), (4, [8], []), (5, None, [1.0]),
        (6, [9, 9, 10], [5.0, 5.0]), (7, [11, 12, 13], [5.0]), (8, [], []), (9, [2, 1], [3.0]),
    ]
    df = spark.createDataFrame(rows, "cluster_id long, members array<long>, percentage_overlaps array<double>")
    assert sorted(map(tuple, cluster_links(df).collect())) == [(1, 2), (2, 1), (9, 10), (11, 12)]


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/event_clusters.parquet")
    links = cluster_links(df)
    got = {r.record_id: r.group_id for r in link_groups(links).collect()}
    assert got == union_find([tuple(r) for r in links.collect()])
