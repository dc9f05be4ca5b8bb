"""Exact duplicates by a minimal perfect hash over the distinct digests of a history.

The history's digests are dealt to shards by their leading bits. Each shard holds a minimal perfect hash: a bitmap
per level, where a digest takes the first level at which no other digest wants its bit, and its slot is the rank of
that bit. A slot holds the full digest (so that a stranger that lands on it is told apart byte by byte), the
locator of the winner, which is its smallest doc_id, and how many rows the digest stands for. A shard is one row of
the index table, of bounded size; the number of shards follows the number of digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.common import SPACE, pieces, text_of
from roadweave.sources.tables import materialize

SHARD_DIGESTS = 16384
INDEX = "shard long, n int, levels array<int>, bits binary, digests binary, winners binary, sizes binary"
_NONE = np.iinfo(np.int64).min  # a winner without a doc_id


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the text with white space normalised; null text is empty) and copy.

    ``copy`` numbers rows that agree in doc_id and digest, so that one of several repeated rows can be told.
    """
    rows = docs.select("doc_id", F.unhex(F.sha2(F.regexp_replace(text_of(), SPACE, " "), 256)).alias("digest"))
    same = Window.partitionBy("doc_id", "digest").orderBy(F.lit(0))
    return rows.withColumn("copy", F.row_number().over(same))


def winners(rows: DataFrame) -> DataFrame:
    """digest, winner (smallest doc_id; null if none has one), size."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count("*").alias("size"))


def _shard(shards: int):
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long"), F.lit(shards))


def _words(digest: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(digest), dtype="<u8").reshape(len(digest), 4)


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A new hash of all 32 bytes for each level (SplitMix64 over the four words)."""
    out = np.full(len(words), (level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for k in range(4):
        out = out ^ words[:, k]
        out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(31)
    return out


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels, and their bits end to end, for distinct digests."""
    sizes, bits, left = [], [], words
    while len(left):
        size = max(64, 3 * len(left) // 2)
        at = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, dtype=bool)


def slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where no level has its bit. A stranger may get a slot; its digest tells."""
    rank = np.cumsum(bits) - 1
    out = np.full(len(words), -1, dtype=np.int64)
    open_, base = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        if not len(open_):
            break
        at = base + (_mixed(words[open_], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        out[open_[hit]] = rank[at[hit]]
        open_, base = open_[~hit], base + size
    return out


def _built(pdf: pd.DataFrame) -> pd.DataFrame:
    words = _words(pdf["digest"].to_numpy())
    sizes, bits = perfect_hash(words)
    order = np.argsort(slots(words, sizes, bits))
    winner = np.array([_NONE if pd.isna(w) else int(w) for w in pdf["winner"].astype("Int64")], dtype="<i8")[order]
    return pd.DataFrame(
        {
            "shard": [pdf["shard"].iloc[0]], "n": [len(pdf)], "levels": [sizes], "bits": [np.packbits(bits).tobytes()],
            "digests": [words[order].tobytes()], "winners": [winner.tobytes()],
            "sizes": [pdf["size"].to_numpy(dtype="<i8")[order].tobytes()],
        }
    )


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """The index over ``winners`` of a history; a table of one row per shard."""
    return materialize(history.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(_built, INDEX))


def _found(key: tuple, index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame({"digest": asked["digest"], "winner": pd.array([pd.NA] * len(asked), "Int64"), "size": 0})
    member = np.zeros(len(asked), dtype=bool)
    if len(index) and len(asked):
        row = index.iloc[0]
        words = _words(asked["digest"].to_numpy())
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8))[: sum(row["levels"])].astype(bool)
        at = slots(words, list(row["levels"]), bits)
        stored = np.frombuffer(row["digests"], dtype="<u8").reshape(-1, 4)
        member = (at >= 0) & (stored[at] == words).all(axis=1)
        winner = np.frombuffer(row["winners"], dtype="<i8")[at]
        out["winner"] = pd.array(winner, "Int64")
        out.loc[~member | (winner == _NONE), "winner"] = pd.NA
        out["size"] = np.where(member, np.frombuffer(row["sizes"], dtype="<i8")[at], 0)
    out["member"] = member
    return out


def look_up(index: DataFrame, asked: DataFrame, shards: int, parts: int = 1) -> DataFrame:
    """digest, winner, size, member for distinct digests. ``parts`` splits each shard's questions, for large batches."""
    part = F.pmod(F.xxhash64("digest"), F.lit(parts))
    spread = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    mine = asked.select("digest", _shard(shards).alias("shard"), part.alias("part"))
    return (
        spread.groupBy("shard", "part").cogroup(mine.groupBy("shard", "part"))
        .applyInPandas(_found, "digest binary, winner long, size long, member boolean")
    )


def deduplicate(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Every row of ``history`` and ``batch`` (frames as ``digests`` gives) with keep_id, group_size and kept.

    Distinct digests of the batch are looked up in the index over the history. Those that are members join the
    winner their slot names; the others are grouped among themselves. Rows without doc_id count in group_size and
    are kept only where their whole group has none. Of rows that agree in doc_id and digest, one is kept.
    """
    old, new = materialize(winners(history)), materialize(winners(batch))
    known, fresh = old.count(), new.count()
    shards = pieces(known, SHARD_DIGESTS)
    index = build_index(old, shards)
    answers = materialize(look_up(index, new, shards, pieces(fresh, 4 * SHARD_DIGESTS * shards)))
    theirs = new.withColumnsRenamed({"winner": "new_winner", "size": "new_size"}).join(answers, "digest")
    groups = old.join(theirs.where("member").select("digest", "new_winner", "new_size"), "digest", "left").select(
        "digest", F.least("winner", "new_winner").alias("keep_id"),
        (F.col("size") + F.coalesce("new_size", F.lit(0))).alias("group_size"),
    )
    strangers = theirs.where("not member").select("digest", F.col("new_winner").alias("keep_id"), F.col("new_size").alias("group_size"))
    every = history.unionByName(batch)
    return every.join(groups.unionByName(strangers), "digest").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    The lower half of the range of doc_ids is the history, the rest (and rows without doc_id) the batch that
    arrives; both go through whole. An empty table gives an empty result.
    """
    rows = materialize(digests(docs))
    middle = rows.agg(F.expr("min(doc_id) div 2 + max(doc_id) div 2").alias("v")).scalar()
    old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return deduplicate(rows.where(~old), rows.where(old)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated texts, columns as given. Rows that agree in doc_id and text leave one."""
    kept = exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("_keep_id"), F.unhex("text_sha256").alias("_keep_digest")
    )
    marked = docs.withColumn("_keep_text", F.unhex(F.sha2(F.regexp_replace(text_of(), SPACE, " "), 256)))
    same = F.col("doc_id").eqNullSafe(F.col("_keep_id")) & (F.col("_keep_text") == F.col("_keep_digest"))
    once = Window.partitionBy("_keep_text", "doc_id").orderBy(F.lit(0))
    stay = marked.join(kept, same, "left_semi").withColumn("_keep_copy", F.row_number().over(once))
    return stay.where("_keep_copy = 1").select(*(F.col(f"`{c}`") for c in docs.columns))
