"""Leaks against direct search of the longest common stretch."""

import random
import unicodedata

import numpy as np
import pytest

from locuslathe.llm.leaks import leaked_items, maximal_matches, shared_runs, tile


def norm(t):
    return "".join(c for c in unicodedata.normalize("NFKC", t or "").lower() if unicodedata.category(c)[0] in "LN")


def leaks(text, item, lang):
    a, b, k = norm(item), norm(text), 20 if lang in ("zh", "ja") else 50
    return any(a[i : i + k] in b for i in range(len(a) - k + 1))


def points(s):
    return np.array([ord(c) for c in s], dtype=np.uint32)


def test_tiles():
    a, b = "abcdefghijKLMNOPQRST", "xxKLMNOPQRSTyyabcdefghij"
    assert sorted(tile(points(a), points(b), 5)) == [(10, 0, 14), (10, 10, 2)]
    assert tile(points("aaaa"), points("aaaaaaaa"), 2) == [(4, 0, 0)]
    assert tile(points(""), points("abc"), 2) == [] and tile(points("ab"), points("ab"), 3) == []
    rng = random.Random(1)
    for _ in range(200):
        x, y = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 25))) for _ in range(2))
        got = {m for m in maximal_matches(points(x), points(y), 3)}
        want = set()
        for i in range(len(x)):
            for j in range(len(y)):
                if i and j and x[i - 1] == y[j - 1]:
                    continue
                n = 0
                while i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n]:
                    n += 1
                if n >= 3:
                    want.add((n, i, j))
        assert got == want
        marked = tile(points(x), points(y), 3)
        assert max((n for n, *_ in marked), default=0) == max((n for n, *_ in want), default=0)
        used = [k for n, i, _ in marked for k in range(i, i + n)]
        assert len(used) == len(set(used)) and all(x[i : i + n] == y[j : j + n] for n, i, j in marked)


DOCS = "doc_id long, text string, item_id string, lang int, seed string"
ITEMS = "item_id long, lang string, item_text string, doc_id string, text string"


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_cases(spark, limit):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    x, y = word(120), word(120)
    zh = "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(40))
    items = [(1, "en", x, "", ""), (2, "en", y, "", ""), (3, "zh", zh, "", ""), (4, "en", None, "", ""), (5, None, "", "", ""), (6, "en", "short one", "", "")]
    full = "".join(chr(ord(c) + 0xFEE0) for c in x[:50])
    docs = [
        (1, x[:50]), (2, x[:49] + "#" + x[60:]), (3, " ".join(x[20:71].upper()) + "!"), (4, full), (5, None), (6, ""),
        (7, zh[5:25]), (8, zh[5:24]), (9, y[40:] + "..." + y[:40]), (10, "short one"), (11, x + y), (12, x[:50]),
        (None, x), (13, y * 400), (14, y[:45] + "z" + y[45:90] + "z" + y[90:]),
    ]
    d = spark.createDataFrame([(i, t, "q", 1, "z") for i, t in docs], DOCS).repartition(3)
    e = spark.createDataFrame(items, ITEMS)
    got = {tuple(r) for r in shared_runs(d, e, filter_seeds=limit).collect()}
    assert got == {(i, k) for i, t in docs for k, lang, s, *_ in items if i is not None and leaks(t, s or "", lang)}
    assert (9, 2) in got and (2, 1) in got and (8, 3) not in got
    more = {(r.doc_id, r.item_id): r for r in leaked_items(d, e, filter_seeds=limit).collect()}
    assert got <= set(more) and more[9, 2].reordered and more[9, 2].covered == 120 and not more[11, 1].reordered
    assert shared_runs(d.where("false"), e).collect() == [] and shared_runs(d, e.where("false")).collect() == []


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_pieces_and_short_items(spark, limit):
    rng = random.Random(5)
    latin = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))
    docs, items, want = [], [], set()
    for lang, word, least, run in (("en", latin, 20, 50), ("zh", han, 8, 20)):
        for size in range(least - 1, run):  # rearranged pieces, each set apart by other characters
            parts = [word(size) for _ in range(4)]
            items.append((len(items), lang, "".join(parts), "", ""))
            docs.append((len(docs), word(3) + "".join(p + word(5) for p in reversed(parts)), "", 1, ""))
            if size >= least:
                want.add((docs[-1][0], items[-1][0]))
        for size in range(1, run):  # items that a document holds whole
            text = word(size)
            items.append((len(items), lang, text, "", ""))
            docs.append((len(docs), word(7) + text + word(9), "", 1, ""))
    texts = {i: norm(t) for i, t, *_ in docs}
    for i, lang, t, *_ in items:
        if len(norm(t)) < (20 if lang == "zh" else 50):
            want |= {(d, i) for d, x in texts.items() if norm(t) in x}
    d, e = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    rows = {(r.doc_id, r.item_id): r for r in leaked_items(d, e, filter_seeds=limit).collect()}
    assert want <= set(rows)
    for (i, k), r in rows.items():  # others only if a tile covers enough of them
        assert (i, k) in want or r.covered >= 0.6 * r.item_chars
    assert all((i, k) in want for i, k in rows if len(norm(items[k][2])) < (8 if items[k][1] == "zh" else 20))


@pytest.mark.parametrize("size", [20, 24, 30, 36, 44, 60])
def test_recall_of_shuffled_pieces(spark, size):
    """Items cut into pieces in any order are found whatever the pieces' length: recall 1, and nothing else comes out."""
    rng = random.Random(size)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    items, docs = [], []
    for k in range(200):
        parts = [word(size) for _ in range(6)]
        items.append((k, "en", "".join(parts), "", ""))
        rng.shuffle(parts)
        docs.append((k, word(300) + "".join(word(9) + p for p in parts) + word(200), "", 1, ""))
    d, e = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert sorted((r.doc_id, r.item_id) for r in leaked_items(d, e).collect()) == [(k, k) for k in range(200)]


@pytest.mark.parametrize("limit", [2_000_000, 0])
def test_hot_template(spark, limit):
    """A stretch that all items and documents share, too short for a leak, makes every pair a candidate and none a row."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    template = word(30)
    n, m = (1000, 10_000) if limit else (100, 500)
    items = [(k, "en", word(50) + template + word(50), "", "") for k in range(n)]
    docs = [(k, word(60) + template + word(60) + (items[k][2] if k % 1000 == 0 and k < n else ""), "", 1, "") for k in range(m)]
    d, e = spark.createDataFrame(docs, DOCS).repartition(8), spark.createDataFrame(items, ITEMS)
    assert [(r.doc_id, r.item_id) for r in leaked_items(d, e, filter_seeds=limit).collect()] == [(0, 0)]
    assert [tuple(r) for r in shared_runs(d, e, filter_seeds=limit).collect()] == [(0, 0)]


def test_copies_of_an_item(spark):
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(90))
    items = [(k, "en", text, "", "") for k in range(300)] + [(900, "fr", text, "", ""), (901, "zh", text, "", "")]
    docs = [(k, f"x {text.upper()} y", "", 1, "") for k in range(40)]
    d, e = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert shared_runs(d, e).count() == leaked_items(d, e).count() == 40 * 302


def test_whole_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/eval_items.parquet")
    got = {tuple(r) for r in shared_runs(docs, items).collect()}
    own = []
    for r in items.collect():
        k = 20 if r.lang in ("zh", "ja") else 50
        s = norm(r.item_text)
        own.append((r.item_id, {s[i : i + k] for i in range(len(s) - k + 1)}, k))
    want = set()
    for r in docs.collect():
        s = norm(r.text)
        grams = {k: {s[i : i + k] for i in range(len(s) - k + 1)} for k in (20, 50)}
        want |= {(r.doc_id, i) for i, g, k in own if not g.isdisjoint(grams[k])}
    assert got == want and len(want) > 20


def test_long_and_repetitive_texts(spark):
    same = "ab" * 300
    docs = [(1, "ab" * 200_000, "q", 1, "z"), (2, "x" * 300_000 + same, "q", 1, "z"), (3, "x" * 300_000, "q", 1, "z")]
    d = spark.createDataFrame(docs, DOCS)
    e = spark.createDataFrame([(1, "en", same, "", ""), (2, "en", "x" * 49, "", "")], ITEMS)
    assert sorted(map(tuple, shared_runs(d, e).collect())) == [(1, 1), (2, 1)]
