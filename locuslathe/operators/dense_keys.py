"""Per-key results when a few keys hold most rows: dense accumulator arrays over equal input splits.

Every input split (a byte range of the files, so its size does not depend on the keys in it) encodes its keys by one
shared dictionary and scatters its rows into dense arrays, one cell per key. Only those arrays are shuffled, in blocks
of neighbouring codes, and summed in two rounds: first under a salt, then per block. What a hot key costs in the
shuffle is therefore one cell per split, however many rows it has.

The dictionary goes to the workers only while it has at most ``max_dictionary`` keys, which is checked before it is
collected. Beyond that, each split encodes by a dictionary of its own, flushed whenever it is full, and the cells travel
as (key, partial) rows that Spark's own partial aggregation reduces; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys per array block.
BLOCK = 1024
#: Most keys of a dictionary that is sent to the workers; its arrays take 64 bytes a key and worker.
MAX_DICTIONARY = 250_000
#: Ways in which the splits' blocks are summed first; each way then gives one row per block.
FAN = 256

_I64 = np.iinfo(np.int64)
#: name, value of an empty cell
_METRICS = (
    ("n", 0),
    ("total", 0),
    ("n_total", 0),
    ("low", _I64.max),
    ("high", _I64.min),
    ("b1", _I64.min),
    ("b2", None),
    ("b_id", _I64.max),
)
_FLOAT = {"b2"}


def _empty(size: int) -> dict[str, np.ndarray]:
    return {
        m: np.full(size, -np.inf) if m in _FLOAT else np.full(size, e, dtype=np.int64) for m, e in _METRICS
    }


def _longs(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values with nulls as 0, and where they are present."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    ok = np.asarray(pc.is_valid(col))
    return np.asarray(pc.fill_null(col, 0)), ok


def _better(a1, a2, aid, b1, b2, bid):
    """Whether the first candidate beats the second: larger b1, then larger b2, then smaller id."""
    return (a1 > b1) | ((a1 == b1) & ((a2 > b2) | ((a2 == b2) & (aid < bid))))


def _keep_best(acc: dict[str, np.ndarray], codes: np.ndarray, r1, r2, rid) -> None:
    """Scatter-argmax: one candidate per code of the batch, then against what the cell holds."""
    order = np.lexsort((-rid, r2, r1, codes))
    last = np.flatnonzero(np.append(codes[order][1:] != codes[order][:-1], True)) if len(order) else order
    pick = order[last]
    c = codes[pick]
    win = _better(r1[pick], r2[pick], rid[pick], acc["b1"][c], acc["b2"][c], acc["b_id"][c])
    c, pick = c[win], pick[win]
    acc["b1"][c], acc["b2"][c], acc["b_id"][c] = r1[pick], r2[pick], rid[pick]


def _scatter(acc: dict[str, np.ndarray], codes: np.ndarray, batch: pa.RecordBatch) -> None:
    size = len(acc["n"])
    acc["n"] += np.bincount(codes, minlength=size)
    amount, ok = _longs(batch.column("_amount"))
    # bincount adds in doubles, which is exact only below 2**53; larger batches take the integer scatter
    if ok.any() and float(np.abs(amount[ok]).astype(np.float64).sum()) < 2.0**53:
        acc["total"] += np.bincount(codes[ok], weights=amount[ok].astype(np.float64), minlength=size).astype(np.int64)
    else:
        np.add.at(acc["total"], codes[ok], amount[ok])
    acc["n_total"] += np.bincount(codes[ok], minlength=size)
    place, ok = _longs(batch.column("_place"))
    np.minimum.at(acc["low"], codes[ok], place[ok])
    np.maximum.at(acc["high"], codes[ok], place[ok])
    rid, ok = _longs(batch.column("_id"))
    r1, _ = _longs(batch.column("_rank1"))
    r2, _ = _longs(batch.column("_rank2"))
    _keep_best(acc, codes[ok], r1[ok], r2[ok].astype(np.float64), rid[ok])


def _local_codes(batch: pa.RecordBatch, n_keys: int) -> tuple[list[tuple], np.ndarray]:
    """The distinct keys of a batch and, for each row, which of them it has."""
    code = np.zeros(batch.num_rows, dtype=np.int64)
    sizes, values = [], []
    for k in range(n_keys):
        col = batch.column(f"_k{k}")
        enc = pc.dictionary_encode(col)
        enc = enc.combine_chunks() if isinstance(enc, pa.ChunkedArray) else enc
        own = enc.dictionary.to_pylist()
        values.append([*own, None])
        sizes.append(len(own) + 1)
        code = code * sizes[-1] + np.asarray(pc.fill_null(enc.indices, len(own))).astype(np.int64)
    distinct, inverse = np.unique(code, return_inverse=True)
    keys = []
    for c in distinct.tolist():
        parts = []
        for size, own in zip(reversed(sizes), reversed(values), strict=True):
            c, r = divmod(c, size)
            parts.append(own[r])
        keys.append(tuple(reversed(parts)))
    return keys, inverse.reshape(-1)


def _pack(acc: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The non-empty blocks of the arrays, as rows of binary cells."""
    salt = TaskContext.get().partitionId() % FAN
    size = len(acc["n"])
    blocks = [b for b in range(0, size, BLOCK) if acc["n"][b : b + BLOCK].any()]
    for at in range(0, len(blocks), 64):
        some = blocks[at : at + 64]
        cols = [pa.array([b // BLOCK for b in some], pa.int64()), pa.array([salt] * len(some), pa.int64())]
        cols += [pa.array([acc[m][b : b + BLOCK].tobytes() for b in some], pa.binary()) for m, _ in _METRICS]
        yield pa.RecordBatch.from_arrays(cols, ["block", "salt", *(m for m, _ in _METRICS)])


_BLOCK_SCHEMA = T.StructType(
    [T.StructField("block", T.LongType()), T.StructField("salt", T.LongType())]
    + [T.StructField(m, T.BinaryType()) for m, _ in _METRICS]
)


def _absorb(acc: dict[str, np.ndarray], row: dict[str, np.ndarray]) -> None:
    for m in ("n", "total", "n_total"):
        acc[m] += row[m]
    np.minimum(acc["low"], row["low"], out=acc["low"])
    np.maximum(acc["high"], row["high"], out=acc["high"])
    win = _better(row["b1"], row["b2"], row["b_id"], acc["b1"], acc["b2"], acc["b_id"])
    for m in ("b1", "b2", "b_id"):
        acc[m][win] = row[m][win]


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> dict[int, dict[str, np.ndarray]]:
    held: dict[int, dict[str, np.ndarray]] = {}
    for batch in batches:
        cells = {m: batch.column(m) for m, _ in _METRICS}
        for i, b in enumerate(batch.column("block").to_pylist()):
            row = {
                m: np.frombuffer(cells[m][i].as_buffer(), dtype=np.float64 if m in _FLOAT else np.int64)
                for m, _ in _METRICS
            }
            if b not in held:
                held[b] = {m: v.copy() for m, v in row.items()}
            else:
                _absorb(held[b], row)
    return held


def aggregate_dense(
    df: DataFrame,
    keys: dict[str, Column],
    amount: Column,
    place: Column,
    rank: tuple[Column, Column],
    record_id: Column,
    max_dictionary: int = MAX_DICTIONARY,
) -> DataFrame:
    """One row per key: ``n``, ``n_total`` and ``total`` of ``amount``, ``low`` and ``high`` of ``place``, ``best_id``.

    ``keys`` names the output key columns and gives each as a string expression. Null is a key value like any other.
    ``amount``, ``place`` and ``record_id`` are bigint; rows whose value is null count in ``n`` only, and a key without
    any value has null there. ``best_id`` is the id with the largest ``rank`` (bigint, double; null counts as -1), the
    smaller id on a tie. An empty table gives no rows. Other columns of ``df`` are not read.
    """
    spark = df.sparkSession
    names = list(keys)
    n_keys = len(names)
    rows = df.select(
        *(c.cast("string").alias(f"_k{i}") for i, c in enumerate(keys.values())),
        amount.cast("long").alias("_amount"),
        place.cast("long").alias("_place"),
        F.coalesce(rank[0].cast("long"), F.lit(-1)).alias("_rank1"),
        F.coalesce(rank[1].cast("double"), F.lit(-1.0)).alias("_rank2"),
        record_id.cast("long").alias("_id"),
    )
    key_cols = [f"_k{i}" for i in range(n_keys)]
    found = rows.select(*key_cols).distinct().limit(max_dictionary + 1).collect()
    if len(found) > max_dictionary:
        return _aggregate_split_local(rows, names, max_dictionary)
    dictionary = sorted((tuple(r) for r in found), key=lambda k: tuple((v is not None, v or "") for v in k))
    shared = spark.sparkContext.broadcast({k: i for i, k in enumerate(dictionary)})
    size = len(dictionary)

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, acc = shared.value, _empty(size)
        for batch in batches:
            if batch.num_rows:
                own, inverse = _local_codes(batch, n_keys)
                _scatter(acc, np.array([codes_of[k] for k in own], dtype=np.int64)[inverse], batch)
        yield from _pack(acc)

    def reduce_salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, acc in _sum_blocks(batches).items():
            cols = [pa.array([b], pa.int64()), pa.array([0], pa.int64())]
            cols += [pa.array([acc[m].tobytes()], pa.binary()) for m, _ in _METRICS]
            yield pa.RecordBatch.from_arrays(cols, _BLOCK_SCHEMA.names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = list(shared.value)
        for b, acc in _sum_blocks(batches).items():
            at = np.flatnonzero(acc["n"])
            own = [listed[b * BLOCK + i] for i in at]
            yield _result_batch([[k[j] for k in own] for j in range(n_keys)], {m: v[at] for m, v in acc.items()})

    out = T.StructType([T.StructField(f"_k{i}", T.StringType()) for i in range(n_keys)] + _RESULT)
    blocks = rows.mapInArrow(accumulate, _BLOCK_SCHEMA)
    blocks = blocks.repartition("block", "salt").mapInArrow(reduce_salted, _BLOCK_SCHEMA)
    done = blocks.repartition("block").mapInArrow(finish, out)
    return done.select(*(F.col(f"_k{i}").alias(n) for i, n in enumerate(names)), *(f.name for f in _RESULT))


_RESULT = [
    T.StructField("n", T.LongType()),
    T.StructField("n_total", T.LongType()),
    T.StructField("total", T.LongType()),
    T.StructField("low", T.LongType()),
    T.StructField("high", T.LongType()),
    T.StructField("best_id", T.LongType()),
    T.StructField("best_1", T.LongType()),
    T.StructField("best_2", T.DoubleType()),
]


def _result_batch(keys: list[list], acc: dict[str, np.ndarray]) -> pa.RecordBatch:
    def opt(values, absent):
        return pa.array(values, mask=absent)

    none, no_place, no_id = acc["n_total"] == 0, acc["low"] == _I64.max, acc["b_id"] == _I64.max
    cols = [pa.array(k, pa.string()) for k in keys]
    cols += [pa.array(acc["n"]), pa.array(acc["n_total"]), opt(acc["total"], none)]
    cols += [opt(acc["low"], no_place), opt(acc["high"], no_place), opt(acc["b_id"], no_id)]
    cols += [opt(acc["b1"], no_id), opt(acc["b2"], no_id)]
    return pa.RecordBatch.from_arrays(cols, [f"_k{i}" for i in range(len(keys))] + [f.name for f in _RESULT])


def _aggregate_split_local(rows: DataFrame, names: Sequence[str], limit: int) -> DataFrame:
    """The way for more keys than a shared dictionary may have: dictionaries per split, partials summed by key."""
    n_keys = len(names)

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of: dict[tuple, int] = {}
        acc = _empty(1024)

        def flush():
            at = len(codes_of)
            return _result_batch(
                [[k[j] for k in codes_of] for j in range(n_keys)], {m: v[:at] for m, v in acc.items()}
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            own, inverse = _local_codes(batch, n_keys)
            if codes_of and len(codes_of) + len(own) > limit:
                yield flush()
                codes_of, acc = {}, _empty(1024)
            codes = np.array([codes_of.setdefault(k, len(codes_of)) for k in own], dtype=np.int64)[inverse]
            while len(acc["n"]) < len(codes_of):
                more = _empty(len(acc["n"]))
                acc = {m: np.concatenate([v, more[m]]) for m, v in acc.items()}
            _scatter(acc, codes, batch)
        if codes_of:
            yield flush()

    out = T.StructType([T.StructField(f"_k{i}", T.StringType()) for i in range(n_keys)] + _RESULT)
    cells = rows.mapInArrow(accumulate, out)
    best = F.max(
        F.when(F.col("best_id").isNotNull(), F.struct("best_1", "best_2", (-F.col("best_id")).alias("neg"), "best_id"))
    )
    done = cells.groupBy(*(f"_k{i}" for i in range(n_keys))).agg(
        F.sum("n").alias("n"),
        F.sum("n_total").alias("n_total"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        best.alias("best"),
    )
    return done.select(
        *(F.col(f"_k{i}").alias(n) for i, n in enumerate(names)),
        "n", "n_total", "total", "low", "high",
        F.col("best.best_id").alias("best_id"), F.col("best.best_1").alias("best_1"), F.col("best.best_2").alias("best_2"),
    )
