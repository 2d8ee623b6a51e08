"""Interval joins against all pairs, on small inputs."""

import random

from pyspark.sql import functions as F

from locuslathe.operators import interval_join as J


def test_overlap_join_against_pairs(spark):
    rng = random.Random(1)

    def some(n, wide):
        out = []
        for i in range(n):
            s = rng.randint(-50_000, 400_000)
            out.append((rng.choice(["k", "k", "j", None]), i, s, s + rng.choice([0, 10, 3000, wide, 10 * wide])))
        return out

    a, b = some(150, 40_000), some(200, 900)
    a += [("k", 900, 5, 3), ("k", 901, None, 3)]
    left = spark.createDataFrame(a, "k string, i long, s long, e long")
    right = spark.createDataFrame(b, "k string, j long, s2 long, e2 long")
    for tol in (0, 700):
        got = sorted((r.i, r.j) for r in J.overlap_join(left, right, ("k",), ("s", "e"), ("s2", "e2"), tol).collect())
        want = sorted((i, j) for k, i, s, e in a for k2, j, s2, e2 in b if s is not None and s <= e and k == k2 and s2 <= e + tol and s <= e2 + tol)
        assert got == want
    bare = [(i, s, e) for _, i, s, e in a if s is not None and s <= e]
    got = sorted((r.i, r.j) for r in J.overlap_join(left.drop("k"), right.drop("k"), (), ("s", "e"), ("s2", "e2")).collect())
    assert got == sorted((i, j) for i, s, e in bare for _, j, s2, e2 in b if s2 <= e and s <= e2)
    assert J.overlap_join(left.drop("k"), right.drop("k").where("false"), (), ("s", "e"), ("s2", "e2")).count() == 0
    assert J.overlap_join(left.where("false"), right, ("k",), ("s", "e"), ("s2", "e2")).count() == 0


def test_nearest(spark):
    cases = [
        (1, "long_ont", 100, None, [(90, 3), (110, 7)], 3), (2, "long_ont", 100, 1, [(100, 2), (100, 4)], 6),
        (3, "long_ont", 100, 1, [(99, 0), (105, 9)], 1), (4, "long_ont", 100, 1, [(111, 9)], 1),
        (5, "short", 100, 1, [(100, 9)], 1), (6, "long_pacbio", 100, 1, [], 1), (7, "long_ont", None, 1, [(0, 5)], 1),
        (8, "long_ont", -3, 1, [(-13, 5), (8, 7)], 5), (9, "long_ont", 100, 1, [(100, None)], 1),
    ]
    calls = spark.createDataFrame([(i, f"g{i}", s, p, r, "z") for i, s, p, r, *_ in cases], "id long, g string, source string, start1 long, supporting_reads long, _reads string")
    sup = spark.createDataFrame([(f"g{i}", p, r) for i, *_, rows, _ in cases for p, r in rows], "g string, start1 long, supporting_reads long")
    d = J.resolve_support(calls.drop("_reads"), sup, ("g",), "id", "start1", 10)
    assert {r.id: r.supporting_reads for r in d.collect()} == {c[0]: c[5] for c in cases}


def test_flanks(spark):
    rows = [(1, 500, 600), (2, 50, 60), (3, 1, 10), (4, 600, 500), (5, None, None)]
    d = J.flanks(spark.createDataFrame([(*r, "c") for r in rows], "r long, s long, e long, c string"), "r", "c", "s", "e")
    got = {(r.row_id, r.side): (r.beg0, r.end0) for r in d.collect()}
    assert got == {
        (1, "before"): (399, 499), (1, "after"): (600, 700), (2, "before"): (0, 49), (2, "after"): (60, 160),
        (3, "after"): (10, 110), (4, "before"): (399, 499), (4, "after"): (600, 700), (5, "after"): (0, 100),
    }


def test_depth_and_coverage(spark):
    regions = spark.createDataFrame([(1, "before", "c", 0, 10), (1, "after", "c", 20, 30), (2, "after", "d", 0, 4)], "row_id long, side string, c string, beg0 long, end0 long")
    al = spark.createDataFrame([("c", 5, 25, 0), ("c", 0, 100, 4), ("c", 22, 24, 16), ("c", 9, 10, None)], "c string, a_beg0 long, a_end0 long, flag int")
    depth = J.region_depth(regions, al, ("c",), ("row_id", "side"))
    assert {(r.row_id, r.side): r.depth for r in depth.collect()} == {(1, "before"): 0.6, (1, "after"): 0.7, (2, "after"): 0.0}
    calls = spark.createDataFrame([(1, 9.0), (2, 9.0), (3, 9.0)], "id long, coverage_before_100bp double")
    got = {r.id: (r.coverage_before_100bp, r.coverage_after_100bp) for r in J.with_flank_coverage(calls, "id", depth).collect()}
    assert got == {1: (0.6, 0.7), 2: (None, 0.0), 3: (None, None)}


def test_merge_of_callers(spark):
    rows = [("c", "DEL", 100, 300, "x"), ("c", "DEL", 900, 1250, "y"), ("c", "DEL", 5000, 5020, "x"), ("c", "DEL", 9000, 9900, "x"), ("c", "INS", 100, 300, "z")]
    d = spark.createDataFrame(rows, "chrom string, std_type string, start1 long, end1 long, caller string").withColumn("svlen", F.lit(None).cast("long"))
    got = sorted((r.std_type, r.start1, r.end1, r.n_callers) for r in J.merge_call_sets(d, (), "caller").collect())
    assert got == [("DEL", 100, 1250, 2), ("DEL", 9000, 9900, 1), ("INS", 100, 300, 1)]
