"""Trimming of reads at their 3' end: bases of low quality, then what is left of the sequencing adapter.

Both look for the best place in a read, which no built-in expression says without a loop over its bases; whole batches of
reads are worked on as one array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# The first bases of the common adapter of short reads, and the tool's usual thresholds
ADAPTER = "AGATCGGAAGAGC"
QUALITY, MIN_LENGTH, ERRORS, OFFSET = 20, 20, 0.1, 33


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and each text's length."""
    return np.frombuffer("".join(texts).encode("latin-1", "replace"), dtype=np.uint8), np.array([len(t) for t in texts], dtype=np.int64)


def quality_ends(quals: list[str], cutoff: int = QUALITY) -> np.ndarray:
    """Where each read ends once its bad tail is cut.

    From the end, ``cutoff`` minus quality is summed until the sum is negative; the read ends where it was largest, at the
    later place on a tie, and isn't cut if it never was above 0.
    """
    flat, sizes = _flat(quals)
    ends = sizes.copy()
    some = np.flatnonzero(sizes)
    if not len(some):
        return ends
    begin = (np.cumsum(sizes) - sizes)[some]
    owner = np.repeat(np.arange(len(some)), sizes[some])
    gain = cutoff - (flat.astype(np.int64) - OFFSET)
    total = np.cumsum(gain)
    tail = (total[begin + sizes[some] - 1])[owner] - total + gain  # sums from each place to its read's end
    place = np.arange(len(flat)) - begin[owner]
    stop = np.maximum.reduceat(np.where(tail < 0, place, -1), begin)
    kept = np.where(place > stop[owner], tail, -1)
    most = np.maximum.reduceat(kept, begin)
    at = np.maximum.reduceat(np.where(kept == most[owner], place, -1), begin)
    ends[some] = np.where(most > 0, at, sizes[some])
    return ends


def adapter_ends(seqs: list[str], adapter: str = ADAPTER, errors: float = ERRORS) -> np.ndarray:
    """Where each read ends before the adapter: the first place from which all that is left fits it.

    At most ``errors`` of the bases compared may differ; at a read's end an overlap of one base is enough. Insertions and
    deletions within the adapter aren't looked for.
    """
    flat, sizes = _flat(seqs)
    ends = sizes.copy()
    some = np.flatnonzero(sizes)
    if not len(some) or not adapter:
        return ends
    begin = (np.cumsum(sizes) - sizes)[some]
    n = len(flat)
    left = np.repeat(begin + sizes[some], sizes[some]) - np.arange(n)  # bases from each place to its read's end
    wrong = np.zeros(n, dtype=np.int64)
    for k, base in enumerate(adapter.encode()):
        wrong[: n - k] += (flat[k:] != base) & (left[: n - k] > k)
    fits = wrong <= np.floor(np.minimum(left, len(adapter)) * errors + 1e-9)
    place = np.arange(n) - np.repeat(begin, sizes[some])
    ends[some] = np.minimum.reduceat(np.where(fits, place, np.repeat(sizes[some], sizes[some])), begin)
    return ends


def trim_reads(
    reads: DataFrame, quality: int = QUALITY, adapter: str = ADAPTER, min_length: int = MIN_LENGTH, seq: str = "seq", qual: str = "qual"
) -> DataFrame:
    """``reads`` with trimmed sequences and qualities; those shorter than ``min_length`` afterwards are left out.

    A null sequence or quality counts as empty. Qualities that are shorter or longer than their sequence are compared as
    far as both go. Other columns are kept.
    """
    names = reads.columns
    s_at, q_at = names.index(seq), names.index(qual)

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [((s or ""), (q or "")) for s, q in zip(batch.column(s_at).to_pylist(), batch.column(q_at).to_pylist(), strict=True)]
            seqs = [s[: len(q)] for s, q in pairs]
            ends = quality_ends([q[: len(s)] for s, q in pairs], quality)
            cut = [s[:e] for s, e in zip(seqs, ends.tolist(), strict=True)]
            ends = adapter_ends(cut, adapter)
            keep = np.flatnonzero(ends >= min_length)
            columns = list(batch.columns)
            columns[s_at] = pa.array([s[:e] for s, e in zip(cut, ends.tolist(), strict=True)], pa.string())
            columns[q_at] = pa.array([q[:e] for (_, q), e in zip(pairs, ends.tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep)) for c in columns], names)

    return reads.mapInArrow(trim, reads.schema)
