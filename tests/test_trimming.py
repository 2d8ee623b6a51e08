"""Trimming against loops over single reads."""

import random

from locuslathe.operators.trimming import ADAPTER, adapter_ends, quality_ends, trim_reads


def loop_quality(q, cutoff):
    s = top = 0
    at = len(q)
    for i in range(len(q) - 1, -1, -1):
        s += cutoff - (ord(q[i]) - 33)
        if s < 0:
            break
        if s > top:
            top, at = s, i
    return at


def loop_adapter(s):
    for i in range(len(s)):
        n = min(len(ADAPTER), len(s) - i)
        if sum(a != b for a, b in zip(s[i : i + n], ADAPTER)) <= int(n * 0.1 + 1e-9):
            return i
    return len(s)


def test_against_loops():
    rng = random.Random(3)
    quals = ["".join(chr(33 + rng.choice([2, 10, 19, 20, 21, 30, 40])) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + ["", "!" * 9, "I" * 9]
    assert quality_ends(quals).tolist() == [loop_quality(q, 20) for q in quals]
    seqs = []
    for _ in range(1500):
        tail = list((ADAPTER + "TTTT")[: rng.randint(0, 17)])
        if tail and rng.random() < 0.4:
            tail[rng.randrange(len(tail))] = rng.choice("ACGT")
        seqs.append("".join(rng.choice("CGTN") for _ in range(rng.randint(0, 30))) + "".join(tail))
    seqs += ["", "A", ADAPTER, "AG" * 20]
    assert adapter_ends(seqs).tolist() == [loop_adapter(s) for s in seqs]


def test_reads(spark):
    good = "C" * 25
    rows = [
        (1, good + ADAPTER + "GG", "I" * 40, "x"), (2, good + "T" * 10, "I" * 25 + "#" * 10, "x"), (3, "C" * 10, "I" * 10, "x"), (4, None, None, "x"),
        (5, good, "I" * 22, "x"), (6, good + ADAPTER[:4], "I" * 29, None),
    ]
    d = trim_reads(spark.createDataFrame(rows, "id int, seq string, qual string, more string"))
    got = {r.id: (r.seq, r.qual, r.more) for r in d.collect()}
    assert got == {1: (good, "I" * 25, "x"), 2: (good, "I" * 25, "x"), 5: ("C" * 22, "I" * 22, "x"), 6: (good, "I" * 25, None)}
    assert trim_reads(d.where("false")).count() == 0 and trim_reads(d, min_length=0).count() == 4
