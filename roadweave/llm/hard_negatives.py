"""Hard negatives: of each anchor, rows of other labels that score somewhat less than its positives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.vectors import block_of, matrix_of, packed, products, scored, singles, strips_of
from roadweave.sources.tables import materialize

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score that a negative's lies between
RELABEL_EVERY, LABELS = 7, 10

SCORES = "anchor_id long, id long, score long"
KEYS = "anchor_id long, key binary"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
# Keys sort as bytes: anchor and id upwards, score downwards, a positive before negatives of its score.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("negative", "u1"), ("id", ">u8")])
_SIGN = np.uint64(1 << 63)
CELLS = 1 << 21  # scores worked on together
_NONE = np.iinfo(np.int64).min


def labelled(embeddings: DataFrame) -> DataFrame:
    """id, label, vector of ``embeddings``; where ``RELABEL_EVERY`` divides vec_id, the label is the next one."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = embeddings.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return rows.where("id is not null and label is not null")


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the k largest scores of each row of a matrix, ties by smaller id; ``_NONE`` doesn't count."""
    if scores.shape[1] > k:
        kth = np.partition(scores, -k, axis=1)[:, -k]
        at = np.nonzero((scores >= kth[:, None]) & (scores > _NONE))
    else:
        at = np.nonzero(scores > _NONE)
    order = np.lexsort((ids[at[1]], -scores[at], at[0]))
    rows, columns = at[0][order], at[1][order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


def _parts(blocks: pd.DataFrame, asked: pd.DataFrame) -> Iterator[tuple[np.ndarray, ...]]:
    """Scores of some of the queries against one block: (places of the queries, scores, ids, labels of the block)."""
    for dim, own in asked.groupby("dim"):
        vectors, places = matrix_of(own), asked.index.get_indexer(own.index)
        for row in blocks[blocks["dim"] == dim].itertuples():
            ids, labels, values = block_of(row)
            step = max(1, CELLS // len(ids))
            for i in range(0, len(places), step):
                yield places[i : i + step], products(values, vectors[i : i + step]), ids, labels


def _positives(k: int):
    def run(key: tuple, blocks: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        names, own = anchors["id"].to_numpy(), anchors["label"].to_numpy()
        out = [np.empty((3, 0), dtype=np.int64)]
        for places, scores, ids, labels in _parts(blocks, anchors):
            alike = (labels == own[places][:, None]) & (ids != names[places][:, None])
            rows, columns = _first(np.where(alike, scores, _NONE), ids, k)
            out.append(np.stack((names[places][rows], ids[columns], scores[rows, columns])))
        return pd.DataFrame(np.concatenate(out, axis=1).T, columns=["anchor_id", "id", "score"])

    return run


def _keys(anchors: np.ndarray, scores: np.ndarray, negative: bool, ids: np.ndarray) -> list[bytes]:
    """(anchor, descending score, id), packed."""
    keys = np.empty(len(ids), dtype=KEY)
    keys["anchor"], keys["id"] = (x.astype(np.int64).view(np.uint64) ^ _SIGN for x in (anchors, ids))
    keys["score"], keys["negative"] = ~(scores.astype(np.int64).view(np.uint64) ^ _SIGN), negative
    return [k.tobytes() for k in keys]


def _negatives(k: int, low: int, high: int):
    """Of each strip, the first k rows in each window; no other row can be among the first k of all strips."""

    def run(key: tuple, blocks: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        names, own = anchors["id"].to_numpy(), anchors["label"].to_numpy()
        most = max((len(p) for p in anchors["positive_scores"]), default=0)
        windows = np.full((len(anchors), most, 2), (1, 0), dtype=np.int64)  # empty ones where there are fewer positives
        for i, positive in enumerate(anchors["positive_scores"]):
            for j, score in enumerate(positive):
                windows[i, j] = -(-low * int(score) // 100), high * int(score) // 100
        found, keys = [], []
        for places, scores, ids, labels in _parts(blocks, anchors):
            unlike = np.where(labels != own[places][:, None], scores, _NONE)
            picked = np.zeros(scores.shape, dtype=bool)
            for j in range(most):
                least, top = windows[places, j, 0][:, None], windows[places, j, 1][:, None]
                picked[_first(np.where((unlike >= least) & (unlike <= top), unlike, _NONE), ids, k)] = True
            rows, columns = np.nonzero(picked)
            found.append(names[places][rows])
            keys += _keys(found[-1], scores[rows, columns], True, ids[columns])
        return pd.DataFrame({"anchor_id": np.concatenate(found) if found else np.empty(0, np.int64), "key": keys})

    return run


def _positive_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchors, scores, ids = (batch.column(c).to_numpy() for c in ("anchor_id", "score", "id"))
        keys = pa.array(_keys(anchors, scores, False, ids), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("anchor_id"), keys], ["anchor_id", "key"])


class Windows:
    """Reads an anchor's rows in descending order: a positive opens its window, a negative goes to the open ones."""

    def __init__(self, k: int, low: int, high: int) -> None:
        self.k, self.low, self.high = k, low, high
        self.anchor, self.open, self.out = None, [], []

    def read(self, anchor: int, score: int, negative: bool, id_: int) -> None:
        if anchor != self.anchor:
            self.anchor, self.open = anchor, []
        if not negative:
            self.open.append([id_, score, 0])
            return
        for window in self.open:
            positive, top, given = window
            if given < self.k and self.low * top <= 100 * score <= self.high * top:
                window[2] += 1
                self.out.append((anchor, positive, given + 1, id_, top, score))
        # What is full, or has got below its last score, gets nothing more.
        self.open = [w for w in self.open if w[2] < self.k and 100 * score >= self.low * w[1]]

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        names = [c.split()[0] for c in MINED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 6, types)], names)


def _opened(k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(k, low, high)
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), KEY)
            anchors, ids = ((keys[c].astype(np.uint64) ^ _SIGN).view(np.int64).tolist() for c in ("anchor", "id"))
            scores = (~keys["score"].astype(np.uint64) ^ _SIGN).view(np.int64).tolist()
            for row in zip(anchors, scores, keys["negative"].tolist(), ids):
                windows.read(*row)
            yield windows.taken()

    return run


def mined(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors``: id, label, vector. Scores are inner products of floor(scale * x), higher ones first, ties by
    smaller id. An anchor's positives are its first rows of its label under another id; each gets the first rows of other
    labels that score between ``low`` and ``high`` percent of the positive. Rows without id, label or a whole vector take no
    part; rows under a repeated id count each, but an anchor is the one with the smallest label and vector. Rows are
    compared with anchors whose vectors are as long. A positive without negatives, and an empty table, give no rows.

    Each strip of rows keeps what can be among the first. The rest is a secondary sort: keys (anchor, descending score, id)
    are dealt by anchor, sorted within partitions, and read by an iterator that holds an anchor's open windows only.
    """
    strips = strips_of(rows.count())
    usable = rows.where("id is not null and label is not null")
    blocks = materialize(packed(usable, scale, strips))
    asked = materialize(singles(anchors.where("id is not null and label is not null"), scale))
    n = asked.count()
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    best = scored(blocks, asked, strips, n, _positives(positives), SCORES)
    best = materialize(best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives))
    tops = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list("score").alias("positive_scores"))
    found = scored(blocks, asked.join(tops, "id"), strips, n, _negatives(negatives, low, high), KEYS)
    keys = found.unionByName(best.mapInArrow(_positive_keys, KEYS))
    return keys.repartition("anchor_id").sortWithinPartitions("key").mapInArrow(_opened(negatives, low, high), MINED)


def hard_negatives(embeddings: DataFrame, every: int = EVERY) -> DataFrame:
    """Hard negatives of all rows whose vec_id is divisible by ``every``, among all rows of ``embeddings``."""
    rows = labelled(embeddings)
    return mined(rows, rows.where(F.col("id") % every == 0))
