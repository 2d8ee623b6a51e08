"""Cleaning, types, clusters, anchors, links: the fixtures' cases, then loops over random calls."""

import random

import pytest
from pyspark.sql import functions as F

from locuslathe.functions.convert import is_missing, to_float, to_int
from locuslathe.functions.intervals import format_percents
from locuslathe.functions.svtypes import type_resolution
from locuslathe.operators import events as E
from locuslathe.operators.calls import audit_counts, clean_calls, good_calls, rejected_calls, union_sources


def test_numbers(spark):
    rows = [("1e5", 100000), ("12.9", 12), ("-12.9", -12), (".", None), ("inf", None), ("nan", None), (" 7 ", 7), ("1_000", 1000),
            ("1.0d", None), ("0x10", None), ("", None), (None, None), ("9007199254740993", 9007199254740993), ("1e300", None), (".5", 0)]
    d = spark.createDataFrame([(a,) for a, _ in rows], "x string")
    got = d.select(to_int(F.col("x")).alias("i"), to_float(F.col("x")).alias("f"), is_missing(F.col("x")).alias("m")).collect()
    assert [r.i for r in got] == [b for _, b in rows]
    assert [r.m for r in got] == [a is None or a.strip() == "" or a in ("nan",) for a, _ in rows]


@pytest.mark.parametrize(
    ("source", "raw", "info", "want"),
    [
        ("short", "DEL", "<DEL>", ("DEL", "raw_svtype")), ("long_ont", "BND", "x.BND.1", ("TRA", "raw_svtype")),
        ("short", "FOO", " dup:tandem ", ("DUP", "info_svtype")), ("asm", "INVDP", "INVDP7", ("INV", "raw_svtype")),
        ("asm", "DUP:INS", None, ("INS", "raw_svtype")), ("asm", "CPG", None, ("INS", "asm_prefix")),
        ("asm", "CPL", None, ("DEL", "asm_prefix")), ("asm", "SYN", None, ("RPL", "asm_prefix")),
        ("asm", "<CPG>", None, ("RPL", "fallback_default")), ("short", "CPG", None, ("RPL", "fallback_default")),
        ("asm", "HDR", None, ("RPL", "fallback_default")), ("asm", None, None, ("RPL", "fallback_default")),
    ],
)
def test_types(spark, source, raw, info, want):
    d = spark.createDataFrame([(source, raw, info)], "s string, r string, i string")
    (r,) = d.select(type_resolution(F.col("i"), F.col("r"), F.col("s")).alias("t")).collect()
    assert tuple(r.t) == want


RAW = "record_id long, chrom string, start string, end string, svtype string, svlen string, std_type string, reject_reason string"


def test_cleaning(spark):
    rows = [
        (1, " ", "1", "2", "DEL", None), (2, "NA", "1", "2", "DEL", None), (3, "c", ".", "2", "DEL", None), (4, "c", "200", "100", "DEL", "-50"),
        (5, "c", "100", "100", "INS", None), (6, "c", "100", "100", "TRA", None), (7, " c ", "1e3", "1500.9", "DEL", None),
        (8, "c", "1", "5", "DEL", "-4"), (9, "c", "1", "5", "INS", "-7"), (10, "c", "1", "5", None, None), (11, "c", "1", "5", "HDR", "4"),
    ]
    d = clean_calls(spark.createDataFrame([(*r, "x", "y") for r in rows], RAW), F.lit("short"), keep=("record_id",))
    got = {r.record_id: r for r in good_calls(d).collect()}
    bad = {r.record_id: r.reject_reason for r in rejected_calls(d).collect()}
    assert bad == {1: "missing_required_fields", 2: "missing_required_fields", 3: "invalid_coordinates", 10: "missing_required_fields"}
    view = {k: (r.start1, r.end1, r.svlen, list(r.modifications)) for k, r in got.items()}
    assert view == {
        4: (100, 200, 100, ["coordinates_swapped", "svlen_normalized_to_end_minus_start"]), 5: (100, 100, None, []),
        6: (100, 100, 0, ["svlen_derived"]), 7: (1000, 1500, 500, ["svlen_derived"]), 8: (1, 5, 4, []), 9: (1, 5, 7, []),
        11: (1, 5, 4, ["svtype_defaulted_to_rpl"]),
    }
    assert got[7].chrom == "c"
    counts = {(r.kind, r.reason): r.n for r in audit_counts(d).collect()}
    assert counts["skipped", "missing_required_fields"] == 3 and counts["modified", "svlen_derived"] == 2
    assert clean_calls(spark.createDataFrame([], RAW), F.lit("asm")).count() == 0


CALLS = (
    "run string, record_id long, source string, chrom string, std_type string, start1 long, end1 long, svlen long, raw_svtype string, "
    "info_svtype string, supporting_reads long, score double, copy_number long, chr2 string, pos2 long, supporting_methods string, "
    "start_mod long, end_mod long, coverage_before_100bp double, coverage_after_100bp double, seq long, n long, best string"
)


def call(i, s, e, *, source="asm", chrom="c", t="DEL", svlen="span", reads=None, score=None, info=None, run="r"):
    svlen = e - s if svlen == "span" else svlen
    return (run, i, source, chrom, t, s, e, svlen, t, info, reads, score, None, None, None, None, None, None, None, None, i, 0, "b")


def frame(spark, rows):
    return spark.createDataFrame(rows, CALLS)


def test_cluster_fixtures(spark):
    def run(rows):
        c = E.clusters(frame(spark, rows), ("run",), 10)
        return sorted((r.cluster_start, r.cluster_end, r.n_members, [round(x, 2) for x in r.p]) for r in c.withColumn("p", E.step_percentages(F.col("steps"))).collect())

    assert run([call(1, 100, 200), call(2, 105, 300)]) == [(100, 300, 2, [48.98])]
    assert run([call(1, 1, 100), call(2, 5, 300), call(3, 12, 305)]) == [(1, 305, 3, [32.43, 97.64])]
    assert len(run([call(1, 1, 1000), call(2, 500, 600)])) == 2
    assert len(run([call(1, 100, 200), call(2, 205, 400)])) == 2
    assert run([call(1, 100, 100, t="INS"), call(2, 108, 108, t="INS")]) == [(100, 108, 2, [0.0])]
    assert run([call(1, 100, 200), call(2, 100, 200), call(3, 100, 200)]) == [(100, 200, 3, [100.0, 100.0])]


def best(spark, rows):
    (r,) = E.clusters(frame(spark, rows), ("run",), 10).collect()
    return {s: r[s].rec.record_id for s in E.SOURCES if r[s] is not None}


def test_best_and_anchor_fixtures(spark):
    assert best(spark, [call(1, 1, 50, reads=5, score=10.0), call(2, 1, 50, reads=6, score=1.0)]) == {"asm": 2}
    ins = lambda i, n: call(i, 1, 1, t="INS", svlen=n, reads=1, score=1.0)
    assert best(spark, [ins(1, 100), ins(2, 50)]) == {"asm": 2}
    assert best(spark, [ins(1, 50), ins(2, None)]) == {"asm": 2}
    assert best(spark, [call(2, 1, 50), call(1, 1, 50), call(3, 2, 51)]) == {"asm": 1}

    def event(rows):
        (r,) = E.merge_events(frame(spark, rows), ("run",), 10).collect()
        return r.event_start, r.event_end, r.event_length_bp, r.support_score

    assert event([call(1, 100, 200), call(2, 100, 190, source="long_ont")]) == (100, 190, 90, 2)
    tied = [call(1, 100, 150), call(2, 120, 170, source="long_ont"), call(3, 118, 168, source="short")]
    (r,) = frame(spark, []).sparkSession.range(1).select(
        E.anchor({s: F.struct(F.lit(50).cast("long").alias("svlen"), F.lit(a).cast("long").alias("start1"), F.lit(b).cast("long").alias("end1")) for s, a, b in (("asm", 100, 150), ("long_ont", 120, 170), ("short", 118, 168))}).alias("a")
    ).collect()
    assert (r.a.event_start, r.a.event_end) == (118, 168) and len(tied) == 3
    assert event([call(1, 100, 100, t="INS", svlen=None), call(2, 105, 105, t="INS", svlen=None)]) == (100, 105, None, 1)
    (r,) = E.merge_events(frame(spark, [call(1, 5, 9, source="long_ont", info="x")]), ("run",), 10).collect()
    assert (r.long_ont_score, r.asm_score, r.asm_start, r.event_id) == (0.0, 1, None, "DEL_1")


def loop_clusters(rows, tol):
    out = []
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[3], r[4]), []).append(r)
    for key, own in groups.items():
        own.sort(key=lambda r: (r[5], r[6], r[20]))
        prev, cur = None, None
        for r in own:
            s, e = r[5], r[6]
            if prev and s <= prev[1] + tol and e >= prev[0] - tol and (abs(s - prev[0]) <= tol or abs(e - prev[1]) <= tol):
                cur.append(r)
            else:
                cur = [r]
                out.append((key, cur))
            prev = (s, e)
    return out


@pytest.mark.parametrize("bits", [2, 20])
def test_random_clusters_and_ids(spark, bits):
    rng = random.Random(bits)
    rows = []
    for i in range(1200):
        s = rng.randint(1, 900)
        rows.append(call(i, s, s + rng.choice([0, 3, 10, 40, 200]), run=rng.choice("rrrq"), chrom=rng.choice("aab"), t=rng.choice(["DEL", "INS"]),
                         source=rng.choice([*E.SOURCES, "other"]), reads=rng.choice([None, 1, 2]), score=rng.choice([None, 1.0, 2.0])))
    d = frame(spark, rows)
    heads = E.chain_heads(E.distinct_intervals(d, ("run",), F.col("seq")), ("run",), 5, bits)
    got = sorted((tuple(r[:3]), r.n, r.s, r.e) for r in heads.groupBy("run", "chrom", "std_type", "head_start", "head_end").agg(F.sum("n").alias("n"), F.min("start1").alias("s"), F.max("end1").alias("e")).collect())
    want = sorted((k, len(c), min(r[5] for r in c), max(r[6] for r in c)) for k, c in loop_clusters(rows, 5))
    assert got == want
    events = E.merge_events(d, ("run",), 5).collect()
    ids = {}
    for r in sorted(events, key=lambda r: (r.run, r.std_svtype, int(r.event_id.split("_")[1]))):
        ids.setdefault((r.run, r.std_svtype), []).append(int(r.event_id.split("_")[1]))
    assert all(v == list(range(1, len(v) + 1)) for v in ids.values())


EVENTS = "run string, event_id string, chrom string, std_svtype string, event_start long, event_end long"


def test_links(spark):
    rows = [("r", "DEL_2", "chr1", "DEL", 23, 67), ("r", "RPL_1", "chr1", "RPL", 23, 67), ("r", "INV_1", "chr1", "INV", 10, 90),
            ("r", "DEL_3", "chr1", "DEL", 60, 100), ("r", "DEL_9", "chr2", "DEL", 60, 100)]
    got = {r.event_id: r.linked_event for r in E.linked_lists(spark.createDataFrame(rows, EVENTS), ("run",)).collect()}
    assert got["DEL_2"] == "INV_1 (INV, chr1:10-90, nested_in); RPL_1 (RPL, chr1:23-67, exact_coordinates); DEL_3 (DEL, chr1:60-100, overlap)"
    assert [x.split()[0] + x.rsplit(" ", 1)[1] for x in got["INV_1"].split("; ")] == ["DEL_2contains)", "RPL_1contains)", "DEL_3overlap)"]
    assert got["DEL_9"] == ""
    close = [("r", "A_1", "c", "DEL", 10, 11), ("r", "A_2", "c", "DEL", 13, 14)]
    rel = lambda tol: [r.relation for r in E.link_events(spark.createDataFrame(close, EVENTS), ("run",), tol).collect()]
    assert rel(5) == ["same_coordinates_within_5bp"] * 2 and rel(0) == []


def test_percent_text(spark):
    d = spark.createDataFrame([([50.0, 48.9796, 100.0],), ([],)], "p array<double>")
    assert [r[0] for r in d.select(format_percents(F.col("p"))).collect()] == ["50%, 48.98%, 100%", ""]


def test_percent_rounding(spark):
    rng = random.Random(9)
    some = [0.125, 0.375, 2.675, 1.005, 95.625, 90.625, 99.995, 99.99999, 0.005, 0.004999, 33.0 / 7, 1e-9]
    some += [rng.randint(0, 800) / 8 for _ in range(200)] + [rng.randint(0, 100_000) / 1000 for _ in range(2000)] + [rng.random() * 100 for _ in range(500)]
    d = spark.createDataFrame([([x],) for x in some], "p array<double>").select("p", format_percents(F.col("p")).alias("t"))
    for r in d.collect():
        (x,) = r.p
        assert r.t == (f"{x:.0f}%" if x == int(x) else f"{x:.2f}%"), x


def test_union_sources(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert sorted(map(tuple, union_sources(("asm", a), ("short", b)).collect()), key=repr) == [(1, "asm", None), (None, "short", "q")]
