from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from edges import TEXTS, by, edge_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadweave.llm import sharding


def least_capacity(sizes, shards):
    """By trying every capacity that a run of groups adds up to."""

    def fits(capacity):
        used, at = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if at + s > capacity:
                used, at = used + 1, 0
            at += s
        return used <= shards

    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    return next((c for c in sums if fits(c)), 0)


def greedy(sizes, shards, capacity):
    out, shard, at = [], 0, 0
    for s in sizes:
        if at + s > capacity:
            shard, at = shard + 1, 0
        at += s
        out.append(shard)
    return out


def groups_of(docs):
    sizes: dict = defaultdict(int)
    for _, text, *_ in docs:
        sizes[hashlib.sha256((text or "").encode()).hexdigest()] += len((text or "").encode()) + 1
    return dict(sorted(sizes.items()))


def check(rows, docs, shards=sharding.SHARDS):
    sizes = groups_of(docs)
    capacity = least_capacity(list(sizes.values()), shards)
    place = dict(zip(sizes, greedy(list(sizes.values()), shards, capacity)))
    want = sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), place[hashlib.sha256((t or "").encode()).hexdigest()])
        for i, t, *_ in docs
    )
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"], r["capacity"]) for r in rows} == {("bytes", None, capacity)}
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_edges(spark):
    check(by(sharding.sharded(edge_documents(spark)), "size"), TEXTS)


def test_empty_table(spark):
    assert sharding.sharded(no_documents(spark)).collect() == []


def test_a_hot_text_stays_whole(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 3)  # many buckets of slots
    docs = [(i, "the hot text" if i % 3 == 0 else f"text {i} " + "x" * (i % 37), None, None) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    check(by(sharding.sharded(frame), "doc_id"), docs)


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_outline_is_refined_to_the_exact_answer(spark, monkeypatch, shards):
    """Ranges of digests in the hundreds of groups, so that the search has to look into them."""
    monkeypatch.setattr(sharding, "OUTLINE", 40)
    monkeypatch.setattr(sharding, "SMALL", 2)
    frame = spark.range(3000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("digest"),
        (F.pmod(F.xxhash64("id"), F.lit(900)) + F.when(F.col("id") % 501 == 0, 9000).otherwise(1)).alias("size"),
    )
    # coarse ranges: every digest moved below one of few prefixes, in its old order
    frame = frame.withColumn("digest", F.concat(F.lit("0" * 4), F.substring("digest", 1, 60)))
    rows = sorted(tuple(r) for r in frame.select("digest", "size").collect())
    sizes = [s for _, s in rows]
    capacity, cuts = sharding.minimax_cuts(frame, shards)
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if max(greedy(sizes, shards, middle)) < shards else (middle + 1, high)
    assert capacity == low
    place = greedy(sizes, shards, low)
    assert cuts == [d for (d, _), a, b in zip(rows[1:], place, place[1:]) if a != b]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=12), st.integers(1, 5))
def test_known_borders(sizes, shards):
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    outline = sharding.Outline(ends, [f"{i:02}" for i in range(len(sizes))], [1] * len(sizes), sizes)
    best = least_capacity(sizes, shards)
    assert outline.least(shards, True) == outline.least(shards, False) == best
    assert outline.touched(best, best, shards) == []
    place = greedy(sizes, shards, best)
    assert outline.cuts(best, shards) == [f"{i:02}" for i in range(1, len(sizes)) if place[i] != place[i - 1]]
