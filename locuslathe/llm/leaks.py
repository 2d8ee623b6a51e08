"""Evaluation texts in training text, by greedy string tiling over shared seeds.

Both sides are written in one form (NFKC, lower case, letters and digits only). Seeds are the least hashes of every
window of ``w`` neighbouring ``q``-character strings (winnowing), so any run of ``q + w - 1`` characters that a document
and an item share gives them a common seed. Leaks by coverage have seeds of their own, with ``q + w - 1`` the least tile,
and an item shorter than that has one seed, all of it, which is looked for in every place of a document. Documents and
items that share a seed are compared: Karp-Rabin hashes of the least tile say which places of the item the document can
hold at all, and where those are too few for a leak the pair is done. Greedy string tiling marks the longest common
stretches of the others, without overlap, compared character by character. Tiles may lie in any order, so a passage that
was cut up and rearranged still counts by its coverage.

Test material is small beside a corpus. While its characters, which are counted first, are few, it goes to the workers,
and a document is read, joined to its items by their seeds and compared in one pass, without a shuffle. Beyond that
seeds meet in a join, and only the texts of documents with a common seed travel to the comparison. The result is the same.
"""

from __future__ import annotations

import heapq
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuslathe.llm.tokens import LETTER, NUMBER, _classes
from locuslathe.session import cut_lineage

#: Most seeds of items that are sent to every worker; a text has one per character at most, and characters are counted.
FILTER_SEEDS = 2_000_000
#: Most document ids (8 bytes each) that are broadcast to pick the texts to compare.
BROADCAST_IDS = 4_000_000
#: Seeds of a chunk of documents whose items are looked up together.
LOOKUPS = 500_000
#: Code points that are hashed together, at least one text.
CHUNK = 2_000_000
#: A document and an item whose tiles cover this share of the item are a leak even without one long tile.
COVERAGE = 0.6


@dataclass(frozen=True)
class Family:
    """``run`` shared characters are a leak; its seeds are the least of ``run - q + 1`` hashes of ``q`` characters.

    Coverage counts tiles of ``tile`` characters at least, or a shorter item as a whole; seeds have ``tile_q`` characters.
    """

    name: str
    langs: tuple[str, ...]
    run: int
    q: int
    tile: int
    tile_q: int
    seed: int

    def least_tile(self, item_chars: int) -> int:
        return min(self.tile, item_chars)


#: Scripts without spaces pack more into a character. The first family is for every language that no other names.
FAMILIES = (
    Family("words", (), 50, 32, 20, 16, 0x9E3779B97F4A7C15),
    Family("dense", ("zh", "ja"), 20, 16, 8, 7, 0xC2B2AE3D27D4EB4F),
)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def normalise(text: str | None) -> np.ndarray:
    """The code points of the letters and digits of a text in NFKC and lower case."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    s = unicodedata.normalize("NFKC", text).lower()
    points = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _classes()[points]
    return points[(kind == LETTER) | (kind == NUMBER)]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``size`` of each."""
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    both = []
    for b in (_BASE, inverse):
        p = np.full(size, b, dtype=np.uint64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return both[0], both[1]


def rolling(points: np.ndarray, q: int, seed: int = 0) -> np.ndarray:
    """Karp-Rabin hashes of all ``q`` neighbouring code points."""
    n = len(points)
    if n < q:
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(max(1 << 12, 1 << (n - 1).bit_length()))
    term = _scramble(points.astype(np.uint64) + np.uint64(seed)) * up[:n]
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term, dtype=np.uint64)])
    return _scramble((total[q:] - total[:-q]) * down[: n - q + 1])


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Least value of every ``w`` neighbours."""
    n, span = len(h) - w + 1, 1
    while span * 2 <= w:
        h = np.minimum(h[: len(h) - span], h[span:])
        span *= 2
    return np.minimum(h[:n], h[w - span : w - span + n])


def _seeds(texts: list[np.ndarray], run: int, q: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, seed) of all texts, unsigned, one at least in every ``run`` characters; shorter texts have none."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    points = np.concatenate(texts) if texts else np.zeros(0, dtype=np.uint32)
    if len(points) < run:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    least = _least(rolling(points, q, salt), run - q + 1)
    whole = owner[: len(least)] == owner[run - 1 :]
    own, value = owner[: len(least)][whole], least[whole]
    if not len(own):
        return own, value
    keep = np.append(True, (value[1:] != value[:-1]) | (own[1:] != own[:-1]))
    return own[keep], value[keep]


def maximal_matches(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, item place, document place) of every common stretch of at least ``least`` that cannot be extended."""
    hi, hd = rolling(item, least), rolling(doc, least)
    if not len(hi) or not len(hd):
        return []
    order = np.argsort(hi, kind="stable")
    ranked = hi[order]
    lo, up = np.searchsorted(ranked, hd, "left"), np.searchsorted(ranked, hd, "right")
    out: list[tuple[int, int, int]] = []
    hits = np.flatnonzero(up > lo)
    for at in range(0, len(hits), 4096):  # bounds the pairs in memory where texts repeat themselves
        d = hits[at : at + 4096]
        n = up[d] - lo[d]
        j = np.repeat(d, n)
        i = order[np.repeat(lo[d], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
        inner = (i > 0) & (j > 0)
        extends = inner & (item[i - 1] == doc[j - 1])
        for a, b in zip(i[~extends].tolist(), j[~extends].tolist(), strict=True):
            r = min(len(item) - a, len(doc) - b)
            differ = np.flatnonzero(item[a : a + r] != doc[b : b + r])
            size = int(differ[0]) if len(differ) else r
            if size >= least:
                out.append((size, a, b))
    return out


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest stretch whose characters are all unmarked is marked, until none is left."""
    heap = [(-n, a, b) for n, a, b in maximal_matches(item, doc, least)]
    heapq.heapify(heap)
    used_i, used_d = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)
    tiles = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        taken = used_i[a : a + n] | used_d[b : b + n]
        if not taken.any():
            used_i[a : a + n] = used_d[b : b + n] = True
            tiles.append((n, a, b))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):  # what is left of it, from free to taken
            if e - s >= least:
                heapq.heappush(heap, (-(e - s), a + s, b + s))
    return tiles


def _family(lang: str | None) -> Family:
    return next((f for f in FAMILIES if lang in f.langs), FAMILIES[0])


_SEED_SCHEMA = "id long, seed long"


def _grams(f: Family, runs_only: bool) -> tuple[int, int, int]:
    """(run, q, salt) of the family's seeds."""
    return (f.run, f.q, f.seed) if runs_only else (f.tile, f.tile_q, f.seed)


def _whole(f: Family, size: int) -> tuple[int, int, int]:
    """(run, q, salt) of the one seed of an item of ``size`` characters, fewer than a tile."""
    return size, size, f.seed + size


def _short_sizes(items: DataFrame) -> list[list[int]]:
    """Per family, the numbers of characters of its items that are shorter than a tile; a few numbers in all."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = set()
        for batch in batches:
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                f, n = _family(lang), len(normalise(text))
                if 0 < n < f.tile:
                    found.add((FAMILIES.index(f), n))
        rows = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1)], ["family", "size"])

    rows = items.mapInArrow(emit, "family int, size int").distinct().collect()
    return [sorted(r["size"] for r in rows if r["family"] == k) for k in range(len(FAMILIES))]


def _item_seeds(items: DataFrame, runs_only: bool) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, langs = (batch.column(k).to_pylist() for k in range(3))
            for f in FAMILIES:
                own = [k for k, x in enumerate(langs) if _family(x) == f]
                forms = [normalise(texts[k]) for k in own]
                short = set() if runs_only else {len(t) for t in forms if 0 < len(t) < f.tile}
                kinds = [(range(len(own)), _grams(f, runs_only))]
                kinds += [([k for k, t in enumerate(forms) if len(t) == n], _whole(f, n)) for n in sorted(short)]
                for some, gram in kinds:
                    who, seed = _seeds([forms[k] for k in some], *gram)
                    picked = pa.array([ids[own[some[w]]] for w in who.tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([picked, pa.array(seed.view(np.int64))], ["id", "seed"])

    return items.mapInArrow(emit, _SEED_SCHEMA).distinct()


def _parts(ids: list, texts: list) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The normalised texts in chunks of about CHUNK code points, with their ids."""
    own, some, size = [], [], 0
    for i, t in zip(ids, texts, strict=True):
        own.append(i)
        some.append(normalise(t))
        size += len(some[-1])
        if size >= CHUNK:
            yield own, some
            own, some, size = [], [], 0
    yield own, some


def _doc_seeds(docs: DataFrame, grams: list[tuple[int, int, int]]) -> DataFrame:
    """Seeds of all documents, each once per document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for gram in grams:
                    who, seed = _seeds(texts, *gram)
                    order = np.lexsort((seed, who))
                    who, seed = who[order], seed[order]
                    keep = np.append(True, (who[1:] != who[:-1]) | (seed[1:] != seed[:-1])) if len(who) else np.zeros(0, dtype=bool)
                    who, seed = who[keep], seed[keep]
                    picked = pa.array([ids[w] for w in who.tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([picked, pa.array(seed.view(np.int64))], ["id", "seed"])

    return docs.mapInArrow(emit, _SEED_SCHEMA)


_PAIR_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("longest", T.IntegerType()),
        T.StructField("covered", T.IntegerType()),
        T.StructField("item_chars", T.IntegerType()),
        T.StructField("tiles", T.IntegerType()),
        T.StructField("reordered", T.BooleanType()),
        T.StructField("run_needed", T.IntegerType()),
    ]
)


class _Items:
    """Distinct item texts with the hashes of their least tiles, and their seeds' posting lists."""

    def __init__(self, texts: list[str | None], langs: list[str | None], runs_only: bool, seeds: bool = True) -> None:
        self.family = [_family(x) for x in langs]
        self.forms = [normalise(t) for t in texts]
        self.least = [f.run if runs_only else f.least_tile(len(t)) for f, t in zip(self.family, self.forms, strict=True)]
        self.needed = np.array([f.run for f in self.family], dtype=np.int64)
        self.chars = np.array([len(t) for t in self.forms], dtype=np.int64)
        own = [rolling(t, n) if n else np.zeros(0, dtype=np.uint64) for t, n in zip(self.forms, self.least, strict=True)]
        self.sizes = np.array([len(h) for h in own], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.hashes = np.concatenate([*own, np.zeros(0, dtype=np.uint64)])
        self.by_least = np.array(self.least, dtype=np.int64)
        if seeds:
            self._post(runs_only)

    def _post(self, runs_only: bool) -> None:
        """Per kind of seed: its gram, the sorted seeds, where each one's items begin, and the items."""
        self.kinds = []
        for f in FAMILIES:
            own = [k for k, x in enumerate(self.family) if x is f]
            parts = [(own, _grams(f, runs_only))]
            if not runs_only:
                for n in sorted({int(self.chars[k]) for k in own if 0 < self.chars[k] < f.tile}):
                    parts.append(([k for k in own if self.chars[k] == n], _whole(f, n)))
            for some, gram in parts:
                who, seed = _seeds([self.forms[k] for k in some], *gram)
                if len(who):
                    order = np.lexsort((who, seed))
                    seed, who = seed[order], np.array(some, dtype=np.int64)[who[order]]
                    keys, at = np.unique(seed, return_index=True)
                    bits = np.zeros(1 << 20, dtype=bool)
                    bits[(keys >> np.uint64(44)).astype(np.int64)] = True
                    self.kinds.append((gram, keys, np.append(at, len(seed)), who, bits))

    def candidates(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, item) of all that share a seed, each pair once, in the order of the texts."""
        n, found = max(1, len(self.forms)), [np.zeros(0, dtype=np.int64)]
        for gram, keys, at, items, bits in self.kinds:
            who, seed = _seeds(texts, *gram)
            near = bits[(seed >> np.uint64(44)).astype(np.int64)]
            who, seed = who[near], seed[near]
            k = np.minimum(np.searchsorted(keys, seed), len(keys) - 1)
            hit = keys[k] == seed
            pair = np.unique(who[hit] * len(keys) + k[hit])
            who, k = pair // len(keys), pair % len(keys)
            # a seed that many items share is expanded in pieces, so that memory is bounded
            total = np.cumsum(at[k + 1] - at[k])
            piece = total // LOOKUPS
            for p in np.unique(piece):
                w, j = who[piece == p], k[piece == p]
                size = at[j + 1] - at[j]
                place = np.repeat(at[j] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                found.append(np.unique(np.repeat(w, size) * n + items[place]))
        both = np.unique(np.concatenate(found))
        return both // n, both % n

    def compare(self, which: np.ndarray, doc: np.ndarray, runs_only: bool, coverage: float | None) -> list[tuple]:
        """(item, longest, covered, tiles, reordered) of the items ``which`` that share a tile with the document.

        With ``coverage`` only of those that can be a leak: what the hashes bound from above must reach it or a run.
        """
        out = []
        for least in np.unique(self.by_least[which]):
            some = which[(self.by_least[which] == least) & (self.sizes[which] > 0)]
            own = np.sort(rolling(doc, int(least)))
            if not len(some) or not len(own):
                continue
            size = self.sizes[some]
            owner = np.repeat(np.arange(len(some)), size)
            place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            h = self.hashes[np.repeat(self.begins[some], size) + place]
            hit = np.flatnonzero(own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h)
            if not len(hit):
                continue
            o, p = owner[hit], place[hit]
            step = np.append(least, np.where(o[1:] == o[:-1], p[1:] - p[:-1], least))  # places from the hit before
            covered = np.bincount(o, np.minimum(step, least), len(some))
            run = np.flatnonzero(np.append(True, (step[1:] != 1) | (o[1:] != o[:-1])))
            longest = np.zeros(len(some), dtype=np.int64)
            np.maximum.at(longest, o[run], np.diff(np.append(run, len(hit))) + least - 1)
            able = longest > 0
            if coverage is not None:
                able &= (longest >= self.needed[some]) | (covered >= coverage * self.chars[some])
            for k in some[able].tolist():
                tiles = tile(self.forms[k], doc, int(least))
                if tiles:
                    by_item = [b for _, _, b in sorted(tiles, key=lambda t: t[1])]
                    out.append((k, max(tiles)[0], sum(n for n, *_ in tiles), len(tiles), by_item != sorted(by_item)))
        return out

    def row(self, doc_id: int, item_id: int, found: tuple) -> tuple:
        k, longest, covered, tiles, reordered = found
        return doc_id, item_id, longest, covered, int(self.chars[k]), tiles, reordered, self.family[k].run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_PAIR_SCHEMA)
    types = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.bool_(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], _PAIR_SCHEMA.names)


#: The items of the latest broadcast that this worker has met, by the broadcast's name.
_AT_HAND: dict[str, tuple[_Items, list[list[int]]]] = {}


def _tile_here(docs: DataFrame, items: DataFrame, runs_only: bool, coverage: float | None) -> DataFrame:
    """Pairs from one pass over the documents, with all items at every worker. Equal texts of items are compared once."""
    ids: dict[tuple, list[int]] = {}
    for r in items.toArrow().to_pylist():
        ids.setdefault((r["item_text"], r["lang"]), []).append(r["item_id"])
    name = uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(([t for t, _ in ids], [x for _, x in ids], list(ids.values())))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _AT_HAND:
            _AT_HAND.clear()
            texts, langs, who = sent.value
            _AT_HAND[name] = _Items(texts, langs, runs_only), who
        own, who = _AT_HAND[name]
        for batch in batches:
            for doc_ids, texts in _parts(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, item = own.candidates(texts)
                cut = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, dtype=np.int64)
                for s, e in zip(cut, np.append(cut[1:], len(at)), strict=False):
                    k = int(at[s])
                    found = own.compare(item[s:e], texts[k], runs_only, coverage)
                    if found:
                        yield _batch([own.row(doc_ids[k], i, f) for f in found for i in who[f[0]]])

    return docs.mapInArrow(compare, _PAIR_SCHEMA)


def _tile_pairs(pairs: DataFrame, runs_only: bool, coverage: float | None) -> DataFrame:
    """Pairs given as rows (doc_id, item_id, text, item_text, lang)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_of = lru_cache(8)(normalise)
        item_of = lru_cache(4096)(lambda text, lang: _Items([text], [lang], runs_only, seeds=False))
        only = np.zeros(1, dtype=np.int64)
        for batch in batches:
            rows = []
            for doc_id, item_id, text, item_text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                item = item_of(item_text, lang)
                rows += [item.row(doc_id, item_id, f) for f in item.compare(only, doc_of(text), runs_only, coverage)]
            yield _batch(rows)

    return pairs.mapInArrow(compare, _PAIR_SCHEMA)


def tiled_pairs(
    docs: DataFrame, items: DataFrame, filter_seeds: int = FILTER_SEEDS, runs_only: bool = False, coverage: float | None = None
) -> DataFrame:
    """One row per document and item that share a tile: longest tile, covered characters, order.

    With ``runs_only`` tiles are whole runs, so only pairs that share one are found. With ``coverage`` pairs whose tiles
    can be seen to reach neither a run nor that share of the item are left out early.

    ``docs`` has doc_id (bigint) and text, ``items`` item_id (bigint), lang and item_text. Null or empty texts share
    nothing; rows with a null id are left out; a null lang counts as a language of words. Documents repeated under
    other ids come out each; a doc_id with several texts is compared by each of them. Runs jobs while it plans.
    """
    items = items.select(F.col("item_id").cast("long"), "item_text", "lang").where("item_id is not null")
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    chars = items.agg(F.coalesce(F.sum(F.coalesce(F.length("item_text"), F.lit(0)) + 8), F.lit(0))).head()[0]
    if chars <= filter_seeds:
        return _tile_here(docs, items, runs_only, coverage)
    own = cut_lineage(_item_seeds(items, runs_only))
    grams = [_grams(f, runs_only) for f in FAMILIES]
    if not runs_only:
        grams += [_whole(f, n) for f, sizes in zip(FAMILIES, _short_sizes(items), strict=True) for n in sizes]
    shared = _doc_seeds(docs, grams).withColumnRenamed("id", "doc_id")
    pairs = cut_lineage(shared.join(own.withColumnRenamed("id", "item_id"), "seed").select("doc_id", "item_id").distinct())
    hit = cut_lineage(pairs.select("doc_id").distinct())
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_IDS else hit
    texts = docs.join(hit, "doc_id", "left_semi")  # others stay where they are
    joined = pairs.join(items, "item_id").join(texts, "doc_id").select("doc_id", "item_id", "text", "item_text", "lang")
    return _tile_pairs(joined, runs_only, coverage)


def leaked_items(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, filter_seeds: int = FILTER_SEEDS) -> DataFrame:
    """The pairs that leak: one tile of a whole run, or tiles in any order that cover ``coverage`` of the item.

    An item shorter than the least tile leaks where a document holds it whole, however short it is.
    """
    d = tiled_pairs(docs, items, filter_seeds, coverage=coverage)
    return (
        d.where((F.col("longest") >= F.col("run_needed")) | (F.col("covered") >= coverage * F.col("item_chars")))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("longest", "covered", "item_chars", "tiles", "reordered")).alias("m"))
        .select("doc_id", "item_id", "m.*")
    )


def shared_runs(docs: DataFrame, items: DataFrame, filter_seeds: int = FILTER_SEEDS) -> DataFrame:
    """(doc_id, item_id) whose longest tile is a whole run: 50 characters, or 20 for zh and ja."""
    d = tiled_pairs(docs, items, filter_seeds, runs_only=True)
    return d.where("longest >= run_needed").select("doc_id", "item_id").distinct()
