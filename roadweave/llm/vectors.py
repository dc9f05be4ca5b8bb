"""Whole-number vectors in blocks: what the searches over embeddings share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.llm.common import pieces

BLOCK = 8192  # rows in a block
STRIP = 16 * BLOCK  # rows that a task scores, about
QUERIES = 16_384  # queries that a task scores them against, about
LEAST_STRIPS = 16  # so that small tables keep several tasks busy too
LARGEST = 1 << 40  # beyond it a component isn't one: its scores would not fit a long

PACKED = "strip int, dim int, n int, ids binary, labels binary, kind string, vectors binary"
SINGLE = "id long, label long, dim int, kind string, vector binary"


def _kind(values: np.ndarray) -> str:
    """The narrowest type that holds all values."""
    if not values.size:
        return "<i2"
    top = max(abs(int(values.min())), abs(int(values.max())))
    return "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"


def _read(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, floor(scale * vectors)) of the rows of each length whose vector is whole."""
    vectors = batch.column("vector")
    known = np.flatnonzero(~np.asarray(vectors.is_null()))
    lengths = np.zeros(len(vectors), dtype=np.int64)
    lengths[known] = np.asarray(vectors.value_lengths().take(pa.array(known)))
    ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        values = flat.reshape(len(rows), length)
        whole = np.isfinite(values).all(axis=1)
        scaled = np.floor(values[whole] * scale)
        if scaled.size and np.abs(scaled).max() >= LARGEST:
            raise ValueError("a vector's component is too large for scores that fit a long")
        yield ids[rows[whole]].astype(np.int64), labels[rows[whole]].astype(np.int64), scaled.astype(np.int64)


def _packer(scale: int, strips: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given, waiting = TaskContext.get().partitionId(), 0, {}

        def block(parts: list) -> pa.RecordBatch:
            nonlocal given
            ids, labels, values = (np.concatenate(x) for x in zip(*parts))
            kind, strip = _kind(values), (part * 7919 + given) % strips
            given += 1
            row = (strip, values.shape[1], len(ids), ids.tobytes(), labels.tobytes(), kind, values.astype(kind).tobytes())
            names = [c.split()[0] for c in PACKED.split(", ")]
            types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

        for batch in batches:
            for ids, labels, values in _read(batch, scale):
                held = waiting.setdefault(values.shape[1], [])
                for i in range(0, len(ids), BLOCK):
                    held.append((ids[i : i + BLOCK], labels[i : i + BLOCK], values[i : i + BLOCK]))
                    if sum(len(p[0]) for p in held) >= BLOCK:
                        yield block(held)
                        held.clear()
        for held in waiting.values():
            if held:
                yield block(held)

    return run


def _singles(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, values in _read(batch, scale):
                kind = _kind(values)
                rows = [v.tobytes() for v in values.astype(kind)]
                same = lambda x, t: pa.array([x] * len(rows), t)
                columns = [pa.array(ids), pa.array(labels), same(values.shape[1], pa.int32()), same(kind, pa.string()), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SINGLE.split(", ")])

    return run


def strips_of(rows: int) -> int:
    return max(LEAST_STRIPS, pieces(rows, STRIP))


def packed(rows: DataFrame, scale: int, strips: int) -> DataFrame:
    """Blocks of up to ``BLOCK`` rows (id, label, vector) of an input split, dealt to ``strips``, without a shuffle.

    Vectors that are null or empty or hold nulls, infinities or NaN are left out. A block is of vectors of one length.
    """
    return rows.select("id", "label", "vector").mapInArrow(_packer(scale, strips), PACKED)


def singles(rows: DataFrame, scale: int) -> DataFrame:
    """One row for each query (id, label, vector), of equal ids the one with the smallest label and vector."""
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.where((F.size("vector") > 0) & ~broken)
    least = whole.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return least.select("id", "row.label", "row.vector").mapInArrow(_singles(scale), SINGLE)


def scored(blocks: DataFrame, queries: DataFrame, strips: int, n_queries: int, fn, schema: str) -> DataFrame:
    """``fn(key, blocks, queries)`` over every strip of blocks with every group of queries.

    A task holds one strip and one group, both of bounded size; blocks are repeated for each group, queries for each strip.
    """
    groups = pieces(n_queries, QUERIES)
    left = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).withColumn(
        "strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))
    )
    by = ["strip", "part"]
    left, right = (side.repartition(strips * groups, *by).groupBy(*by) for side in (left, right))
    return left.cogroup(right).applyInPandas(fn, schema)


def block_of(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and vectors of a packed row."""
    values = np.frombuffer(row.vectors, row.kind).reshape(row.n, row.dim)
    return np.frombuffer(row.ids, "<i8"), np.frombuffer(row.labels, "<i8"), values


def matrix_of(queries: pd.DataFrame) -> np.ndarray:
    """The vectors of queries of one length."""
    return np.stack([np.frombuffer(v, k).astype(np.int64) for v, k in zip(queries["vector"], queries["kind"])])


def fits(values: np.ndarray, queries: np.ndarray) -> int:
    """A bound on the size of any product of the two, which has to fit a long."""
    top = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (values, queries)]
    bound = top[0] * top[1] * values.shape[1]
    if bound >= 1 << 62:
        raise OverflowError("inner products may not fit a long")
    return bound


def products(values: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact inner products, a row for each query: in doubles as long as those hold them."""
    kind = np.float64 if fits(values, queries) < 1 << 53 else np.int64
    return (queries.astype(kind) @ values.T.astype(kind)).astype(np.int64)
