"""Byte-level BPE: pre-tokens from a transition-function scan, cached pair merging, offsets kept for decoding."""

from __future__ import annotations

import base64
import bisect
import functools
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.llm.common import text_of
from roadweave.llm.lookup import Lookup
from roadweave.llm.pretokens import Coder

REMEMBERED = 250_000  # pre-tokens a worker remembers, about
CHUNK_CHARS = 1_000_000  # texts are worked on in runs of about so many code points


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: join the adjacent pair of lowest rank, the leftmost of equals, until none has one.

    Pairs wait in a heap over a linked list of parts, so a long pre-token costs n log n.
    """
    if piece in rank:
        return [rank[piece]]
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := rank.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, length = heapq.heappop(heap)
        left = parts[i]
        j = after[i]
        if left is None or j >= len(parts) or len(left) + len(parts[j]) != length:
            continue  # one of the two has been joined to something else
        parts[i], parts[j] = left + parts[j], None
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(parts):
                pair = parts[k] + parts[after[k]]
                if (r := rank.get(pair)) is not None:
                    heapq.heappush(heap, (r, k, len(pair)))
    return [rank[p] for p in parts if p is not None]


class Merger:
    """Merges many pre-tokens at once: a row of a matrix each, and in every step the best pair of every row.

    Pairs of ids are looked up in a table of all pairs that the vocabulary joins. Pre-tokens of about one length are
    worked on together, those of more bytes than any of ``WIDTHS`` one by one through ``merged``.
    """

    WIDTHS = (4, 6, 8, 10, 12, 16, 24)
    NONE = np.iinfo(np.int32).max

    def __init__(self, rank: dict[bytes, int]) -> None:
        self.rank = rank
        self.byte = np.array([rank[bytes([b])] for b in range(256)], dtype=np.int64)
        self.many = max(rank.values()) + 1
        joins = [
            (rank[token[:k]] * self.many + rank[token[k:]], whole)
            for token, whole in rank.items() for k in range(1, len(token)) if token[:k] in rank and token[k:] in rank
        ]
        pairs = np.array(joins, dtype=np.int64).reshape(-1, 2)
        self.pairs, self.joined = Lookup(pairs[:, 0].astype(np.uint64)), np.append(pairs[:, 1], self.NONE).astype(np.int32)
        self.of_bytes = self._rank(np.repeat(self.byte, 256), np.tile(self.byte, 256)).reshape(256, 256)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs join to; NONE where they don't, or where there is no right part (-1)."""
        row = self.pairs.find((left.astype(np.int64) * self.many + np.maximum(right, 0)).astype(np.uint64))
        return np.where(right < 0, self.NONE, self.joined[row])

    def __call__(self, pieces_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(pieces_)
        classes: list[list[int]] = [[] for _ in self.WIDTHS]
        width_class = [bisect.bisect_left(self.WIDTHS, n) for n in range(self.WIDTHS[-1] + 1)]
        for k, piece in enumerate(pieces_):
            whole = self.rank.get(piece)
            if whole is not None:
                out[k] = (whole,)
            elif len(piece) > self.WIDTHS[-1]:
                out[k] = merged(piece, self.rank)
            else:
                classes[width_class[len(piece)]].append(k)
        for chosen in classes:
            for start in range(0, len(chosen), 1 << 14):
                rows = chosen[start : start + (1 << 14)]
                for k, ids in zip(rows, self._merge([pieces_[k] for k in rows])):
                    out[k] = ids
        counts = np.fromiter(map(len, out), dtype=np.int64, count=len(out))
        return np.fromiter(chain.from_iterable(out), dtype=np.int32, count=int(counts.sum())), counts

    def _merge(self, pieces_: list[bytes]) -> list[list[int]]:
        n, wide = len(pieces_), max(map(len, pieces_))
        raw = np.frombuffer(b"".join(p.ljust(wide, b"\0") for p in pieces_), dtype=np.uint8).reshape(n, wide)
        sizes = np.fromiter(map(len, pieces_), dtype=np.int64, count=n)
        columns = np.arange(wide)
        parts = np.where(columns < sizes[:, None], self.byte[raw], -1)
        parts = np.hstack([parts, np.full((n, 1), -1)]).astype(np.int32)  # a last column without a part
        best = np.full((n, wide), self.NONE, dtype=np.int32)
        best[:, :-1] = np.where(parts[:, 1:-1] >= 0, self.of_bytes[raw[:, :-1], raw[:, 1:]], self.NONE)
        open_ = np.arange(n)
        while len(open_):
            at = best[open_].argmin(axis=1)
            join = best[open_, at]
            some = join != self.NONE
            open_, at, join = open_[some], at[some], join[some]
            if not len(open_):
                break
            # the right part of each joined pair goes, what follows moves up
            rows = parts[open_]
            rows = np.take_along_axis(rows, np.minimum(np.arange(wide + 1) + (np.arange(wide + 1) > at[:, None]), wide), axis=1)
            each = np.arange(len(open_))
            rows[each, at] = join
            parts[open_] = rows
            pair = best[open_]
            pair = np.take_along_axis(pair, np.minimum(columns + (columns > at[:, None]), wide - 1), axis=1)
            pair[:, -1] = self.NONE
            pair[each, at] = self._rank(join, rows[each, at + 1])
            before = at > 0
            pair[each[before], at[before] - 1] = self._rank(rows[each[before], at[before] - 1], join[before])
            best[open_] = pair
        return [row[row >= 0].tolist() for row in parts]


def runs(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``size`` code points together; a longer text is a run of its own."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > size:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


def _encoder(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = ranks(path)
        coder = Coder(Merger(rank), REMEMBERED)
        lengths = np.zeros(max(rank.values()) + 1, dtype=np.int32)
        for token, k in rank.items():
            lengths[k] = len(token)
        for batch in batches:
            ids_of, at = batch.column(0), 0
            for run in runs(batch.column(1).to_pylist()):
                ids, counts = coder.code(run)
                edges = np.concatenate([[0], np.cumsum(counts)])
                ends = np.cumsum(lengths[ids], dtype=np.int64)
                ends -= np.repeat(np.concatenate([[0], ends])[edges[:-1]], counts)
                cut = pa.array(edges, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of.slice(at, len(run)), pa.ListArray.from_arrays(cut, pa.array(ids)),
                        pa.ListArray.from_arrays(cut, pa.array(ends.astype(np.int32))),
                    ],
                    names=["doc_id", "ids", "ends"],
                )
                at += len(run)

    return work


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, ends for every row: the ids of the whole text by the ranks in ``path``, and where each token ends.

    Null and empty texts have no ids. Rows with one doc_id are encoded each for itself; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.mapInArrow(_encoder(path), f"doc_id {kind}, ids array<int>, ends array<int>")


def _decoder(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {k: t for t, k in ranks(path).items()}
        for batch in batches:
            ids, ends = batch.column("ids"), batch.column("ends")
            out = []
            for i in range(batch.num_rows):
                own = ids[i].values.to_numpy()
                data = b"".join(map(token.__getitem__, own.tolist()))
                if len(own) and ends[i].values[-1].as_py() != len(data):
                    raise ValueError("the tokens' bytes don't end where their offsets say")
                out.append(data)
            kept = [batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary())], names=[*batch.schema.names, "bytes"])

    return work


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids, ends) with the bytes its ids stand for, checked against the offsets."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decoder(path), f"{schema}, bytes binary")


def ids_digest(ids: str = "ids") -> Column:
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
