"""Dense key aggregation and interval periods against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from locuslathe.operators.dense_keys import aggregate_dense
from locuslathe.operators.periods import periods_and_gaps

SCHEMA = "k string, t string, v long, p long, r long, s double, id long, n string, block long, salt long"


def dense(df, **kw):
    return aggregate_dense(
        df, {"k": F.col("k"), "t": F.col("t")}, F.col("v"), F.col("p"), (F.col("r"), F.col("s")), F.col("id"), **kw
    )


@pytest.mark.parametrize("limit", [250_000, 3])
def test_dense_against_loop(spark, limit):
    rng = random.Random(5)
    opt = lambda v: None if rng.random() < 0.15 else v
    rows = [
        (
            opt(rng.choice(["hot"] * 9 + ["a", "b", "", "c"])), opt(rng.choice("xy")), opt(rng.randint(-9, 9) * 10**15),
            opt(rng.randint(-5, 5)), opt(rng.randint(0, 3)), opt(rng.randint(0, 2) / 2), i, "n", 1, 2,
        )
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = {(r.k, r.t): (r.n, r.n_total, r.total, r.low, r.high, r.best_id) for r in dense(df, max_dictionary=limit).collect()}
    want = {}
    for key in {(r[0], r[1]) for r in rows}:
        own = [r for r in rows if (r[0], r[1]) == key]
        vals, places = [r[2] for r in own if r[2] is not None], [r[3] for r in own if r[3] is not None]
        best = max(own, key=lambda r: (-1 if r[4] is None else r[4], -1 if r[5] is None else r[5], -r[6]))[6]
        want[key] = (len(own), len(vals), sum(vals) if vals else None, min(places, default=None), max(places, default=None), best)
    assert got == want


def test_dense_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dense(empty).collect() == []
    one = spark.createDataFrame([(None, None, None, None, None, None, None, None, None, None)], SCHEMA)
    (r,) = dense(one).collect()
    assert (r.k, r.t, r.n, r.n_total, r.total, r.low, r.best_id) == (None, None, 1, 0, None, None, None)
    many = spark.range(5000).selectExpr(
        "cast(id as string) k", "'t' t", "id v", "id p", "1L r", "1D s", "id", "'' n", "0L block", "0L salt"
    )
    assert {(int(r.k), r.total, r.best_id) for r in dense(many).collect()} == {(i, i, i) for i in range(5000)}


def spans(rows):
    out = []
    for key in {r[0] for r in rows}:
        own = sorted((min(a, b), max(a, b)) for k, a, b in rows if k == key and a is not None and b is not None)
        merged = []
        for s, e in own:
            if merged and s <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(key, "period", s, e) for s, e in merged]
        out += [(key, "gap", a[1] + 1, b[0] - 1) for a, b in zip(merged, merged[1:])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_periods_against_loop(spark, bits):
    rng = random.Random(bits)
    rows = []
    for i in range(1500):
        key = rng.choice(["hot", "hot", "b", None, "c"])
        a = rng.randint(-40, 400) if key == "hot" else rng.randint(-400, 4000)
        b = a + rng.choice([0, 0, 1, 2, 3, 9, -4, 60])
        rows.append((key, None if i % 50 == 0 else a, None if i % 77 == 0 else b))
    rows += [("touch", 1, 4), ("touch", 5, 8), ("touch", 9, 9), ("touch", 11, 12), ("far", 0, 10**9), ("far", 5, 6)]
    rows += [("big", 2**45, 2**45 + 3), ("big", 2**45 + 4, 2**45 + 9), ("big", 2**45 + 11, 2**45 + 12)]
    if bits < 20:
        rows = [r for r in rows if r[0] not in ("big",)]
    df = spark.createDataFrame(rows, "run string, s long, e long").withColumn("t", F.lit(1))
    got = periods_and_gaps(df, {"run": F.col("run")}, F.col("s"), F.col("e"), tile_bits=bits)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == spans(rows)


def test_periods_empty(spark):
    df = spark.createDataFrame([], "run string, s long, e long")
    assert periods_and_gaps(df, {"run": F.col("run")}, F.col("s"), F.col("e")).collect() == []
