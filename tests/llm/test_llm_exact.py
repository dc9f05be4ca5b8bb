from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from edges import SPACE, TEXTS, by, edge_documents, no_documents
from pyspark.sql import functions as F

from roadweave.llm import exact_dedup as dedup


def expected(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[hashlib.sha256(SPACE.sub(" ", text or "").encode()).hexdigest()].append(i)
    out = []
    for key, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), key) for i in ids]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def test_edges(spark):
    result = dedup.exact_duplicates(edge_documents(spark))
    assert found(result) == expected(TEXTS)
    kept = [r.doc_id for r in result.where("kept").collect()]
    assert sorted(i for i in kept if i is not None) == [1, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15]
    assert kept.count(None) == 1  # the lone text; the copy of document 1 goes


def test_empty_table(spark):
    assert dedup.exact_duplicates(no_documents(spark)).collect() == []


def test_stage_keeps_columns_and_one_of_each(spark):
    docs = edge_documents(spark)
    left = dedup.without_duplicates(docs)
    assert left.schema == docs.schema and left.count() == 14
    assert [r["doc_id"] for r in by(left, "doc_id")].count(13) == 1


def test_large_groups_and_many_digests(spark, monkeypatch):
    """More digests than a shard holds, a group of a third of the rows, members and strangers in the batch."""
    monkeypatch.setattr(dedup, "SHARD_DIGESTS", 100)
    n = 3000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 1300).cast("string"))).alias("text"),
    )
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 1300}") for i in range(n)]
    assert found(dedup.exact_duplicates(docs)) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_the_hash_is_perfect_and_minimal(n):
    words = np.random.default_rng(n).integers(0, 1 << 63, size=(n, 4), dtype=np.uint64)
    sizes, bits = dedup.perfect_hash(words)
    assert sorted(dedup.slots(words, sizes, bits).tolist()) == list(range(n))
    assert int(bits.sum()) == n


def test_strangers_are_told_apart_by_their_bytes(spark):
    """A digest that isn't in the index may land on a slot, and is no member all the same."""
    digest = lambda i: hashlib.sha256(str(i).encode()).digest()
    known = spark.createDataFrame([(digest(i), i, 2) for i in range(500)], "digest binary, winner long, size long")
    asked = spark.createDataFrame([(digest(i), i, 1) for i in range(250, 5000)], "digest binary, winner long, size long")
    index = dedup.build_index(known, 3)
    assert index.count() == 3
    answers = dedup.look_up(index, asked, 3, parts=2).collect()
    members = {r.digest: (r.winner, r.size) for r in answers if r.member}
    assert len(answers) == 4750
    assert {bytes(k): v for k, v in members.items()} == {digest(i): (i, 2) for i in range(250, 500)}


def test_history_and_batch(spark):
    frame = lambda rows: dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    result = dedup.deduplicate(frame([(5, "b"), (2, "x y"), (9, "n"), (10, "n")]), frame([(3, "a"), (4, "x  y")]))
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in result.collect()} == {
        3: (3, 1, True), 4: (2, 2, False), 2: (2, 2, True), 5: (5, 1, True), 9: (9, 2, True), 10: (9, 2, False),
    }
