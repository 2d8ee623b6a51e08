"""Line parsing against a character-by-character reader."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from locuslathe.operators import raw_lines
from locuslathe.operators.raw_lines import judge_lines, rejected_lines, typed_rows

WIDTHS = {"asm": (7,), "long": (9, 11), "short": (11, 13), "support": (5,)}
NUM = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")


def fields_of(line):
    out, i, n = [], 0, len(line)
    while True:
        if i < n and line[i] == '"':
            i += 1
            text = ""
            while True:
                if i >= n:
                    return None
                if line[i] == '"':
                    if i + 1 < n and line[i + 1] == '"':
                        text += '"'
                        i += 2
                        continue
                    i += 1
                    break
                text += line[i]
                i += 1
            if i < n and line[i] != "\t":
                return None
        else:
            j = line.find("\t", i)
            j = n if j < 0 else j
            text, i = line[i:j], j
        out.append(text)
        if i >= n:
            return out
        i += 1


def is_num(s):
    return bool(NUM.fullmatch(s)) and math.isfinite(float(s))


def brute(kind, line):
    line = line or ""
    if line.endswith("\r"):
        line = line[:-1]
    f = fields_of(line)
    if f is None:
        return "bad_quoting"
    if len(f) not in WIDTHS.get(kind, ()):
        return "column_count"
    for name, i in (("start", 1), ("end", 2)):
        if not is_num(f[i].strip()):
            return f"invalid_{name}"
    at = {"long": 5, "short": 7}.get(kind)
    if at and not (is_num(f[at].strip()) or f[at].strip() in ("", ".", "NA")):
        return "invalid_svlen"
    return None


CASES = [
    ("asm", "chr1\t1\t2\tDEL\tx\t1\t2", None),
    ("asm", "chr1\t1\t2\tDEL\tx\t1\t2\r", None),
    ("asm", 'chr1\t"1"\t 2 \tDEL\t"a\tb ""c"""\t1\t2', None),
    ("asm", 'chr1\t1\t2\tDEL\t"x\t1\t2', "bad_quoting"),
    ("asm", 'chr1\t1\t2\tDEL\t"x"y\t1\t2', "bad_quoting"),
    ("asm", 'chr1\t1\t2\tDEL\t"x""\t1\t2', "bad_quoting"),
    ("asm", 'chr1\t1\t2\tDEL\t5" x\t1\t2', None),
    ("asm", '"', "bad_quoting"),
    ("asm", '""', "column_count"),
    ("asm", "", "column_count"),
    ("asm", None, "column_count"),
    (None, "a\tb", "column_count"),
    ("other", "a\tb", "column_count"),
    ("support", "c\t1e400\t2\tDEL\t3", "invalid_start"),
    ("support", "c\t1\tnan\tDEL\t3", "invalid_end"),
    ("support", "c\t.5\t5.\tDEL\t3", None),
    ("support", "c\t.\t5.\tDEL\t3", "invalid_start"),
    ("support", "c\t1d\t1f\tDEL\t3", "invalid_start"),
    ("support", "c\t٣\t1\tDEL\t3", "invalid_start"),
    ("support", 'c\t""\t1\tDEL\t3', "invalid_start"),
    ("long", "c\t1\t2\tDEL\ti\tNA\t.\t1\tm", None),
    ("long", "c\t1\t2\tDEL\ti\tn/a\t.\t1\tm", "invalid_svlen"),
    ("long", "c\t1\t2\tDEL\ti\t" + '"' + '""' * 5000 + '"' + "\t.\t1\tm", "invalid_svlen"),
    ("support", "c\t1\t2\tDEL\t" + "x" * 200_000, None),
]


@pytest.mark.parametrize("chars", [raw_lines.BROADCAST_CHARS, -1])
def test_cases(spark, chars):
    df = spark.createDataFrame(
        [(i, k, s, "x") for i, (k, s, _) in enumerate(CASES)], "line_id long, file_kind string, raw_line string, reason string"
    )
    got = {r.line_id: r.reason for r in judge_lines(df, broadcast_chars=chars).collect()}
    assert got == {i: want for i, (*_, want) in enumerate(CASES)}
    assert [brute(k, s) for k, s, _ in CASES] == [w for *_, w in CASES]


def test_random_lines(spark):
    rng = random.Random(3)
    bits = ['"', '""', "\t", "1", "2.5", "x", " ", "\r", "NA", ".", '"a\tb"', "e9", "-", "\t1\t2\t"]
    rows = []
    for i in range(3000):
        kind = rng.choice(["asm", "long", "short", "support"])
        if i % 2:
            rows.append((i, kind, "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))))
        else:
            w = rng.choice(WIDTHS[kind])
            rows.append((i, kind, "\t".join(rng.choice(['"1"', "1", " 2", "x", '""', '"5""', ".", "3e2", '"1\t2"']) for _ in range(w))))
    df = spark.createDataFrame(rows, "line_id long, file_kind string, raw_line string")
    got = {r.line_id: r.reason for r in rejected_lines(judge_lines(df)).collect()}
    want = {i: r for i, k, s in rows if (r := brute(k, s))}
    assert got == want


def test_typed_rows_and_empty(spark):
    df = spark.createDataFrame(
        [(1, "long", 'c\t1e3\t1500.9\tDEL\t"i"\t-5\t.\t1.5\tm\t.\t2.5'), (2, "asm", "bad")],
        "line_id long, file_kind string, raw_line string",
    )
    (row,) = typed_rows(judge_lines(df)).collect()
    assert (row.start_pos, row.end_pos, row.svlen, row.supporting_reads, row.score) == (1000, 1500, -5, None, 1.5)
    assert (row.coverage_before_100bp, row.coverage_after_100bp, row.chr2) == (None, 2.5, None)
    assert judge_lines(df.where("line_id = 9")).count() == 0


def test_nulled_fields(spark):
    df = spark.createDataFrame(
        [(1, "long", "c\t1\t2\tDEL\ti\t-5\tabc\t1d\tm\t\u00017\t.5"), (2, "support", "c\t1e30\t2\tDEL\tNA"), (3, "support", "c\t1\t2\tDEL\t 7 ")],
        "line_id long, file_kind string, raw_line string",
    )
    rows = {r.line_id: r for r in typed_rows(judge_lines(df)).collect()}
    assert rows[1].nulled_fields == "supporting_reads,score,coverage_before_100bp" and rows[1].coverage_after_100bp == 0.5
    assert rows[2].nulled_fields == "start_pos" and rows[2].start_pos is None and rows[2].supporting_reads is None
    assert rows[3].nulled_fields is None and rows[3].supporting_reads == 7


def test_number_is_the_stated_pattern(spark):
    rng = random.Random(6)
    texts = sorted({"".join(rng.choice("019.eE+-dfxXnaiINF_ \u0001\u0663") for _ in range(rng.randint(0, 6))) for _ in range(6000)})
    texts += ["1e308", "1e309", "-1e400", "Infinity", "NaN", "0x1p3", "1" * 400, "inf", "+.5E-3", "9" * 308]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", raw_lines.is_number(F.col("t")).alias("n"))
    assert {r.t: r.n for r in d.collect()} == {t: is_num(t) for t in texts}


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/sv_raw_lines.parquet")
    want = {r.line_id: w for r in df.collect() if (w := brute(r.file_kind, r.raw_line))}
    assert {r.line_id: r.reason for r in rejected_lines(judge_lines(df)).collect()} == want


def test_quoted_field_with_the_mask_character(spark):
    line = '"a\u0001b""c\u0001a"\t"\u0001\tx"\t\u0001'
    row = spark.createDataFrame([(line,)], "v string").select(raw_lines.split_fields(F.col("v")).alias("p")).head()["p"]
    assert row["fields"] == ['a\u0001b"c\u0001a', "\u0001\tx", "\u0001"] and not row["bad"]
