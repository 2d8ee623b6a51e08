"""Token ids of every text by a public byte-level BPE, pre-tokenised without regular expressions.

Pre-tokenisation works on whole batches of texts as one array of code points:

* A table gives each code point its class (letter, number, blank, other white space, other); look-ahead turns that into
  a symbol: the last white space before a word, an apostrophe that opens a contraction of two or three characters.
* Each symbol is a function from the state of the scanner to its next state. Functions compose associatively, and the
  functions that can arise form a small monoid, so composition is one look-up in its multiplication table. A blocked
  prefix scan (within blocks across all blocks at once, then over the blocks' totals) gives every position's state.
* The state before a position and its symbol say whether a token starts there.

The slices between the boundaries go through pair merging, with the results of short slices cached per worker. Each
token's place is kept on request: byte offsets from which the text can be decoded again.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuslathe.session import free_name

#: Where the vocabulary lies; a parameter of every function, as the file is not part of this package.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Code points that are scanned together, at least one text.
CHUNK = 2_000_000
#: Longest slice, in characters, whose ids are cached, and how many slices a worker's cache holds before it starts anew.
CACHED_LENGTH = 48
CACHED_SLICES = 400_000

# classes of code points
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
# symbols: the classes, with white space split by what follows, contractions, and the start of a text
S_LETTER, S_NUMBER, S_OTHER, S_BLANK_LAST, S_SPACE_LAST, S_SPACE, S_APOS2, S_APOS3, S_START = range(9)
# states: what the scanner is in after a character
AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACE, ONE_MORE, TWO_MORE, CLOSED = range(9)

# Characters with the Unicode property White_Space
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# What may follow an apostrophe in a contraction
CONTRACTIONS_1 = "stmd"
CONTRACTIONS_2 = ("re", "ve", "ll")


@lru_cache(1)
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))[0]
        if c == "L":
            table[cp] = LETTER
        elif c == "N":
            table[cp] = NUMBER
    table[list(WHITE_SPACE)] = SPACE
    table[0x20] = BLANK
    return table


def _next_state(state: int, symbol: int) -> int:
    if symbol == S_START:
        return AT_START
    if state == TWO_MORE:
        return ONE_MORE
    if state == ONE_MORE:
        return CLOSED
    if symbol in (S_APOS2, S_APOS3):
        if state in (IN_OTHERS, AFTER_BLANK):
            return IN_OTHERS  # the apostrophe belongs to a run of other characters
        return ONE_MORE if symbol == S_APOS2 else TWO_MORE
    return {
        S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS, S_BLANK_LAST: AFTER_BLANK,
        S_SPACE_LAST: CLOSED, S_SPACE: IN_SPACE,
    }[symbol]


def _starts(state: int, symbol: int) -> bool:
    """Whether a token starts at a character with this symbol, in this state before it."""
    if state in (ONE_MORE, TWO_MORE):
        return False
    if state in (AT_START, CLOSED):
        return True
    same = {IN_LETTERS: (S_LETTER,), IN_NUMBERS: (S_NUMBER,), IN_OTHERS: (S_OTHER, S_APOS2, S_APOS3), IN_SPACE: (S_SPACE,)}
    if state == AFTER_BLANK:
        return False  # the blank opens the token of what follows it
    return symbol not in same[state]


@lru_cache(1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, multiplication table, state after AT_START per element, starts[state, symbol])."""
    n = 9
    gens = [tuple(_next_state(s, sym) for s in range(n)) for sym in range(n)]
    index: dict[tuple, int] = {}
    elements = [tuple(range(n)), *gens]
    k = 0
    for e in elements:
        index.setdefault(e, len(index))
    elements = list(index)
    while k < len(elements):
        for g in gens:
            made = tuple(g[s] for s in elements[k])
            if made not in index:
                index[made] = len(elements)
                elements.append(made)
        k += 1
    m = len(elements)
    table = np.zeros((m, m), dtype=np.uint16)
    for i, a in enumerate(elements):
        for j, b in enumerate(elements):
            made = tuple(b[s] for s in a)
            if made not in index:
                index[made] = len(elements)
                elements.append(made)
            table[i, j] = index[made]
    assert len(elements) == m, "the set is closed under composition"
    starts = np.array([[_starts(s, sym) for sym in range(n)] for s in range(n)])
    return (
        np.array([index[g] for g in gens], dtype=np.uint16), table,
        np.array([e[AT_START] for e in elements], dtype=np.uint8), starts,
    )


def _scan(elements: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of the elements."""
    n = len(elements)
    width = max(1, int(n**0.5) // 8)
    rows = -(-n // width)
    # padding by the identity (element 0); column j of block i is position i * width + j
    grid = np.zeros(rows * width, dtype=np.uint16)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):
        grid[j] = table[grid[j - 1], grid[j]]
    totals = grid[-1].copy()
    step = 1
    while step < rows:  # the blocks' totals by doubling
        ahead = totals.copy()
        ahead[step:] = table[totals[:-step], totals[step:]]
        totals = ahead
        step *= 2
    before = np.zeros(rows, dtype=np.uint16)
    before[1:] = totals[:-1]
    return np.ascontiguousarray(table[before[None, :], grid].T).reshape(-1)[:n]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, text lengths): for all texts written one after another, whether a token starts at each code point."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, dtype=bool), lengths
    kind = _classes()[points]
    first = np.zeros(n + 3, dtype=bool)  # a text starts here; the end counts as a start
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    first[n:] = True
    padded = np.concatenate([kind, [OTHER] * 3])
    white = (padded == BLANK) | (padded == SPACE)
    # white space keeps to its run unless it is the last before something else in its text
    last = white[:n] & ~white[1 : n + 1] & ~first[1 : n + 1]
    symbol = kind.copy()
    symbol[white[:n]] = S_SPACE
    symbol[last & (kind == BLANK)] = S_BLANK_LAST
    symbol[last & (kind == SPACE)] = S_SPACE_LAST
    at = np.flatnonzero(points == 0x27)
    if len(at):
        ahead = np.concatenate([points, [0, 0, 0]])
        one, two = ahead[at + 1], ahead[at + 2]
        in1, in2 = ~first[at + 1], ~first[at + 1] & ~first[at + 2]
        is2 = in1 & np.isin(one, [ord(c) for c in CONTRACTIONS_1])
        is3 = np.zeros(len(at), dtype=bool)
        for a, b in CONTRACTIONS_2:
            is3 |= in2 & (one == ord(a)) & (two == ord(b))
        symbol[at[is2]] = S_APOS2
        symbol[at[is3]] = S_APOS3
    generator, table, state_of, starts = _monoid()
    own = generator[symbol]
    # a text's first character is preceded by the start symbol: its element is start, then itself
    own[first[:n]] = table[generator[S_START], own[first[:n]]]
    after = state_of[_scan(own, table)]
    before = np.empty(n, dtype=np.uint8)
    before[0] = AT_START
    before[1:] = after[:-1]
    before[first[:n]] = AT_START
    return starts[before, symbol], lengths


class ByteBPE:
    """Pair merging over the bytes of a slice, by a vocabulary with ``vocab`` and ``merges``, a file's path or its bytes."""

    def __init__(self, source: str | bytes):
        model = json.loads(source if isinstance(source, bytes) else Path(source).read_bytes())["model"]
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        # printable stand-ins for bytes: those that print stand for themselves, the others follow from U+0100
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        stand_in = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.byte_id = [vocab[stand_in[b]] for b in range(256)]
        back = {c: b for b, c in stand_in.items()}
        self.bytes_of = {i: bytes(back[c] for c in s) for s, i in vocab.items() if all(c in back for c in s)}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one slice: the pair of lowest rank, leftmost first, is merged until no pair is in the vocabulary."""
        ids = [self.byte_id[b] for b in piece]
        n, pairs = len(ids), self.pairs
        if n < 2:
            return ids
        if n < 24:
            while len(ids) > 1:
                best, at = None, -1
                for i in range(len(ids) - 1):
                    p = pairs.get((ids[i], ids[i + 1]))
                    if p is not None and (best is None or p[0] < best[0]):
                        best, at = p, i
                if best is None:
                    break
                ids[at : at + 2] = [best[1]]
            return ids
        # flat arrays, and heap entries of one integer (rank, then place), keep very long slices within memory
        row = array("i", ids)
        right, left = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        heap = [(p[0] << 40) | i for i in range(n - 1) if (p := pairs.get((row[i], row[i + 1]))) is not None]
        heapq.heapify(heap)
        push, pop, places = heapq.heappush, heapq.heappop, (1 << 40) - 1
        while heap:
            entry = pop(heap)
            i = entry & places
            j = right[i]
            if row[i] < 0 or j >= n:
                continue
            p = pairs.get((row[i], row[j]))
            if p is None or p[0] != entry >> 40:
                continue  # one of the two has been merged since
            made = p[1]
            row[i], row[j] = made, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (p := pairs.get((made, row[k]))) is not None:
                    push(heap, (p[0] << 40) | i)
            h = left[i]
            if h >= 0 and (p := pairs.get((row[h], made))) is not None:
                push(heap, (p[0] << 40) | h)
        return [x for x in row if x >= 0]

    def encode(self, piece: str) -> tuple[int, ...]:
        """The ids of one slice, from the cache if it is short and was seen before."""
        ids = tuple(self.merge(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= CACHED_LENGTH:
            if len(self.cache) >= CACHED_SLICES:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        starts, lengths = boundaries(texts)
        out, at = [], 0
        places = np.flatnonzero(starts)
        ends = np.searchsorted(places, np.cumsum(lengths))
        k = 0
        for text, n, end in zip(texts, lengths.tolist(), ends.tolist(), strict=True):
            cuts = (places[k:end] - at).tolist()
            ids: list[int] = []
            cache = self.cache
            for i, j in zip(cuts, [*cuts[1:], n], strict=True) if n else ():
                piece = text[i:j]
                got = cache.get(piece)
                ids.extend(self.encode(piece) if got is None else got)
            out.append(ids)
            at, k = at + n, end
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


#: The tokenizer that this worker used last, by its vocabulary's digest.
_AT_HAND: dict[str, ByteBPE] = {}


def _tokenizer(digest: str, sent: Broadcast) -> ByteBPE:
    if digest not in _AT_HAND:
        _AT_HAND.clear()
        _AT_HAND[digest] = ByteBPE(sent.value)
    return _AT_HAND[digest]


def _send(df: DataFrame, vocabulary: str) -> tuple[str, Broadcast]:
    """A vocabulary's digest, and its bytes at every worker: a few megabytes, whatever the corpus."""
    data = Path(vocabulary).read_bytes()
    return hashlib.sha256(data).hexdigest(), df.sparkSession.sparkContext.broadcast(data)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > CHUNK:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encode_corpus(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, offsets: bool = False
) -> DataFrame:
    """(id, ids array<int>[, byte_starts array<int>]) of every row of ``df``, in whole texts, without special tokens.

    Null and empty texts have an empty list. White space is encoded as it stands, and strings that look like special
    tokens are ordinary text. ``byte_starts`` are the tokens' first bytes in the UTF-8 text. Repeated rows come out
    each; other columns are not read. ``vocabulary`` is read by the driver and sent to the workers.
    """
    schema = T.StructType([T.StructField("_id", df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if offsets:
        schema.add("byte_starts", T.ArrayType(T.IntegerType()))

    digest, sent = _send(df, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(digest, sent)
        for batch in batches:
            at = 0
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in _chunks(texts):
                ids = tok.encode_texts(part)
                cols = [batch.column(0).slice(at, len(part)), _lists(ids)]
                if offsets:
                    sizes = {i: len(b) for i, b in tok.bytes_of.items()}
                    cols.append(_lists([np.concatenate([[0], np.cumsum([sizes[i] for i in own])[:-1]]).astype(np.int32).tolist() if own else [] for own in ids]))
                yield pa.RecordBatch.from_arrays(cols, schema.names)
                at += len(part)

    out = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(encode, schema)
    return out.withColumnRenamed("_id", id_col)


def _lists(values: list[list[int]]) -> pa.ListArray:
    ends = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=ends[1:])
    flat = np.fromiter((x for v in values for x in v), dtype=np.int32, count=int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def decode_corpus(df: DataFrame, ids_col: str = "ids", out_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with the decoded text of each id list in ``out_col`` (replaced if it exists); null for a null list."""
    name = free_name(df, "_decoded")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])

    digest, sent = _send(df, vocabulary)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(digest, sent)
        for batch in batches:
            texts = [None if v is None else tok.decode(v) for v in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return df.mapInArrow(decode, schema).withColumn(out_col, F.col(name)).drop(name)


if sys.byteorder != "little":  # the code points are read as little-endian words
    raise ImportError("needs a little-endian machine")
