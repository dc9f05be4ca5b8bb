"""Exact top-k search by inner product over a bit-sliced index."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.vectors import BLOCK, block_of, fits, matrix_of, packed, scored, singles, strips_of
from roadweave.sources.tables import materialize

SCALE = 1024
BEST = 10
EVERY = 100
BITS = 6  # of an attribute's range within its block that have a slice, and of a query's components that are added

INDEX = "strip int, dim int, n int, ids binary, kind string, vectors binary, least binary, shift int, slices binary"
FOUND = "query_id long, vec_id long, score long"


def _bitmaps(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as words of 64 bits."""
    packed_bits = np.packbits(flags, axis=-1, bitorder="little")
    short = -packed_bits.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed_bits, [(0, 0)] * (flags.ndim - 1) + [(0, short)])).view("<u8")


def sliced(values: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """(least value of each attribute, bits left out below the slices, slices): slices[d, b] is bit b of attribute d."""
    least = values.min(axis=0).astype(np.int64)
    above = values - least
    shift = max(0, int(above.max()).bit_length() - BITS)
    levels = (above >> shift).T
    return least, shift, np.stack([_bitmaps((levels >> b & 1).astype(bool)) for b in range(BITS)], axis=1)


def _indexed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The packed rows of a strip as blocks of the index, small ones put together."""
    out = []
    for dim, same in rows.groupby("dim"):
        ids, _, values = (np.concatenate(x) for x in zip(*(block_of(r) for r in same.itertuples())))
        for i in range(0, len(ids), BLOCK):
            part = values[i : i + BLOCK]
            least, shift, slices = sliced(part.astype(np.int64))
            out.append((key[0], dim, len(part), ids[i : i + BLOCK].tobytes(), part.dtype.str, part.tobytes(), least.tobytes(), shift, slices.tobytes()))
    return pd.DataFrame(out, columns=[c.split()[0] for c in INDEX.split(", ")])


def build_index(vectors: DataFrame, scale: int = SCALE, strips: int | None = None) -> DataFrame:
    """The bit-sliced index of ``vectors`` (id, vector), written to the shared folder: every row, in blocks.

    A block has its ids, its exact whole-number vectors floor(scale * x), and the upper ``BITS`` bits of each attribute,
    reckoned from its least value in the block, as one bitmap for each bit. Rows without id or a whole vector are left out.
    """
    strips = strips or strips_of(vectors.count())
    rows = vectors.where("id is not null").select("id", F.lit(0).cast("long").alias("label"), "vector")
    return materialize(packed(rows, scale, strips).groupBy("strip").applyInPandas(_indexed, INDEX))


def add_slices(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Bitmaps of weight 2**i in column i, summed row by row: the slices of the sums, lowest first.

    Carry-save: three bitmaps of a weight become one of it and one of twice the weight, all triples of a column at once.
    """
    columns, out, i = list(columns), [], 0
    while i < len(columns):
        here, carried = columns[i], []
        while len(here) > 2:
            third = len(here) // 3
            a, b, c = here[:third], here[third : 2 * third], here[2 * third : 3 * third]
            half = a ^ b
            carried.append(a & b | half & c)
            here = np.concatenate((half ^ c, here[3 * third :])) if len(here) > 3 * third else half ^ c
        if len(here) == 2:
            carried.append((here[0] & here[1])[None])
            here = here[:1] ^ here[1:]
        if carried:
            if i + 1 == len(columns):
                columns.append(carried[0][:0])
            columns[i + 1] = np.concatenate((columns[i + 1], *carried))
        out.append(here[0] if len(here) else None)
        i += 1
    return out


def kth_largest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest sum among the rows of a bitmap that has k rows or more, from the most significant slice down."""
    sure, open_, value = np.zeros_like(rows), rows, 0
    for i in reversed(range(len(slices))):
        ones = open_ & slices[i]
        taken = sure | ones
        if np.bitwise_count(taken).sum() >= k:
            open_, value = ones, value | 1 << i
        else:
            sure, open_ = taken, open_ & ~slices[i]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, value: int) -> np.ndarray:
    """Those rows of a bitmap whose sum is ``value`` or more, from the most significant slice down."""
    if value <= 0:
        return rows
    if value >> len(slices):
        return np.zeros_like(rows)
    more, same = np.zeros_like(rows), rows
    for i in reversed(range(len(slices))):
        if value >> i & 1:
            same = same & slices[i]
        else:
            more, same = more | same & slices[i], same & ~slices[i]
    return more | same


class Block:
    """A block of the index, ready for queries."""

    def __init__(self, row) -> None:
        self.ids, self.n, self.dim = np.frombuffer(row.ids, "<i8"), row.n, row.dim
        self.values = np.frombuffer(row.vectors, row.kind).reshape(row.n, row.dim)
        self.least, self.shift = np.frombuffer(row.least, "<i8"), row.shift
        slices = np.frombuffer(row.slices, "<u8").reshape(row.dim * BITS, -1)
        self.slices = np.concatenate((slices, ~slices))  # a negative weight adds the complement
        self.rows = _bitmaps(np.ones(row.n, dtype=bool))
        self.order = np.argsort(self.ids, kind="stable")
        self.in_order = self.ids[self.order]

    def others(self, query_id: int) -> np.ndarray:
        """All rows but the query's own."""
        at = self.order[np.searchsorted(self.in_order, query_id) : np.searchsorted(self.in_order, query_id, "right")]
        if not len(at):
            return self.rows
        own = np.zeros(self.n, dtype=bool)
        own[at] = True
        return self.rows & ~_bitmaps(own)

    def search(self, query_id: int, query: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of all rows that can be among the k best, given that k rows of ``floor`` or more are known.

        With c = least + (u << shift) + r and q = (v << drop) + e, a score is base + sum(v * u) << (shift + drop), plus what
        the bits left out, r and e, can add: at least ``low``, at most ``high``. Rows whose sum may reach the k-th best
        score are looked at exactly.
        """
        drop = max(0, int(np.abs(query).max()).bit_length() - BITS)
        size = (np.abs(query) + (1 << drop >> 1)) >> drop
        negative = query < 0
        left = query - (np.where(negative, -size, size) << drop)
        top, rest = (1 << BITS) - 1, (1 << self.shift) - 1
        scale = self.shift + drop
        base = int(query @ self.least) - (int(size[negative].sum()) * top << scale)
        low = int(np.minimum(query, 0).sum()) * rest + (int(np.minimum(left, 0).sum()) * top << self.shift)
        high = int(np.maximum(query, 0).sum()) * rest + (int(np.maximum(left, 0).sum()) * top << self.shift)

        first = np.arange(self.dim) * BITS + np.where(negative, self.dim * BITS, 0)
        bits = [first[size >> j & 1 == 1] for j in range(int(size.max()).bit_length())]
        columns = [
            self.slices[np.concatenate([bits[j] + (p - j) for j in range(max(0, p - BITS + 1), min(len(bits), p + 1))])]
            for p in range(len(bits) + BITS - 1 if bits else 0)
        ]
        sums = [s if s is not None else np.zeros_like(self.rows) for s in add_slices(columns)]
        others = self.others(query_id)
        if np.bitwise_count(others).sum() >= k:
            reached = base + (kth_largest(sums, others, k) << scale) + low
            floor = reached if floor is None else max(floor, reached)
        if floor is not None:
            others = at_least(sums, others, -(-(floor - base - high) >> scale))
        at = np.flatnonzero(np.unpackbits(others.view(np.uint8), bitorder="little", count=self.n))
        return self.values[at].astype(np.int64) @ query, self.ids[at]


def _searched(k: int):
    def run(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, asked in queries.groupby("dim"):
            vectors, ids = matrix_of(asked), asked["id"].to_numpy()
            best = {}
            for row in index[index["dim"] == dim].itertuples():
                block = Block(row)
                fits(block.values, vectors)
                for query_id, query in zip(ids, vectors):
                    scores, found = best.get(query_id, (np.empty(0, np.int64),) * 2)
                    floor = int(scores[-1]) if len(scores) == k else None
                    more, which = block.search(query_id, query, k, floor)
                    scores, found = np.concatenate((scores, more)), np.concatenate((found, which))
                    first = np.lexsort((found, -scores))[:k]
                    best[query_id] = scores[first], found[first]
            out += [pd.DataFrame({"query_id": q, "vec_id": found, "score": scores}) for q, (scores, found) in best.items()]
        return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "vec_id", "score"])

    return run


def search(index: DataFrame, queries: DataFrame, k: int = BEST, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: of each query (id, vector) the k rows of the index with the largest inner product.

    Ties go to the smaller id. Rows under the query's own id don't count; a query under a repeated id is the one with the
    smallest vector. Repeated rows of the index count each. Rows are found among vectors of the query's length. Fewer than
    k rows are all returned, and none for a query without a whole vector.
    """
    asked = singles(queries.where("id is not null").select("id", F.lit(0).cast("long").alias("label"), "vector"), scale)
    asked = materialize(asked)
    strips = (index.agg(F.max("strip")).first()[0] or 0) + 1
    found = scored(index, asked, strips, asked.count(), _searched(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, every: int = EVERY, k: int = BEST) -> DataFrame:
    """The search of all rows whose vec_id is divisible by ``every`` among all rows of ``embeddings``."""
    rows = embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return search(build_index(rows), rows.where(F.col("id") % every == 0), k)
