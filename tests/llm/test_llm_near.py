from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edges import TEXTS, by, edge_documents, no_documents, words
from pyspark.sql import functions as F

from roadweave.llm import near_dedup as near
from roadweave.llm.components import components


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text):
    own = words(lower(text))
    return {tuple(own[i : i + 4]) for i in range(len(own) - 3)} if len(own) >= 4 else ({tuple(own)} if own else set())


def brute(docs):
    """(doc_id, n_shingles, component_id) by looking at every pair that shares a shingle."""
    sets = [shingle_set(t) for _, t, *_ in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    having = defaultdict(list)
    for i, own in enumerate(sets):
        for j, n in Counter(j for s in own for j in having[s]).items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                up[find(i)] = find(j)
        for s in own:
            having[s].append(i)
    least: dict = {}
    for i, (doc, *_) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(((d[0], len(s), least.get(find(i)) if s else d[0]) for i, (d, s) in enumerate(zip(docs, sets))), key=str)


def check(spark, docs):
    frame = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(4)
    rows = near.near_duplicates(frame).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return rows


def text_of(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, own, edits):
    out = list(own)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def test_edges(spark):
    rows = near.near_duplicates(edge_documents(spark)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == brute(TEXTS)
    docs = edge_documents(spark)
    left = near.one_of_each(docs)
    assert left.schema == docs.schema
    assert {3, 4, 5, 1, 6, 7}.issubset({r.doc_id for r in left.collect()})


def test_empty_table(spark):
    assert near.near_duplicates(no_documents(spark)).collect() == []


def test_groups_of_all_sizes_near_the_border(spark):
    """Copies with similarities on both sides of 0.8, in groups from two to forty."""
    rng = random.Random(7)
    docs, i = [], 0
    for group in range(60):
        base = text_of(rng, rng.choice([30, 60, 120]))
        for _ in range(rng.choice([1, 2, 3, 8, 40]) if group < 50 else 1):
            docs.append((i, " ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 3, 4])))))
            i += 1
    rng.shuffle(docs)
    check(spark, docs)


def test_a_third_of_all_rows_in_one_group(spark, monkeypatch):
    """A group far larger than a region listed whole, read in parts; a passage shared by dissimilar documents."""
    monkeypatch.setattr(near, "BUFFER", 200)
    monkeypatch.setattr(near, "BLOCK", 6000)
    rng = random.Random(3)
    base, passage = text_of(rng, 100), text_of(rng, 60)
    docs = [(3 * k, " ".join(edited(rng, base, rng.choice([1, 2, 3])))) for k in range(400)]
    docs += [(3 * k + 1, " ".join(passage + text_of(rng, 25))) for k in range(200)]
    docs += [(3 * k + 2, " ".join(text_of(rng, 50))) for k in range(300)]
    rng.shuffle(docs)
    rows = check(spark, docs)
    assert max(Counter(r.component_id for r in rows).values()) > 300


@pytest.mark.parametrize("few", [1, 5, 64])
def test_outsiders_of_a_large_region_lose_no_link(spark, monkeypatch, few):
    """With neighbours and the middle member of no use, rare shingles and blocks still find all links."""
    monkeypatch.setattr(near, "FEW", few)
    monkeypatch.setattr(near, "FULL", 2)
    monkeypatch.setattr(near, "NEAR", 1)
    monkeypatch.setattr(near, "BLOCK", 700)
    rng = random.Random(11)
    docs, i = [], 0
    base = text_of(rng, 80)
    for family in range(12):  # families around variants of one text: related, most of them not linked
        variant = edited(rng, base, 14)
        for _ in range(6):
            docs.append((i, " ".join(edited(rng, variant, rng.choice([0, 1, 2])))))
            i += 1
    check(spark, docs)


def test_one_template_without_links_writes_no_pairs(spark):
    """Texts half alike stay apart without being compared; copies among them are found."""
    rng = random.Random(2)
    template = text_of(rng, 60)
    docs = [(k, " ".join(template + [f"u{k}x{i}" for i in range(28)])) for k in range(1500)]
    docs += [(5000 + k, docs[k][1].rsplit(" ", 3)[0] + f" z{k}") for k in range(0, 1500, 100)]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near.near_duplicates(frame).collect()}
    assert found == {k: k - 5000 if k >= 5000 else k for k, _ in docs}

    rows = near.signed(frame)
    sets = rows.join(frame.select("doc_id", F.col("text").cast("binary").alias("text")), "doc_id").select(
        F.col("doc_id").alias("rep"), F.col("doc_id").alias("label"), "text"
    )
    pairs, many = near._shared_rare(sets.mapInArrow(near._items, "rep long, label long, size long, items binary"))
    assert many.collect() == [] and pairs.count() == 15


def test_shared_rare_shingles_reach_every_similar_pair(spark):
    rng = random.Random(13)
    base = text_of(rng, 70)
    docs = [(k, " ".join(edited(rng, base, rng.choice([1, 2, 3, 5]))[: rng.choice([60, 70])])) for k in range(60)]
    sets = {k: shingle_set(t) for k, t in docs}
    near_ones = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    frame = spark.createDataFrame([(k, k, t.encode()) for k, t in docs], "rep long, label long, text binary")
    pairs, many = near._shared_rare(frame.mapInArrow(near._items, "rep long, label long, size long, items binary"))
    assert near_ones and near_ones <= {(r.a, r.b) for r in pairs.collect()} and many.count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(a, a + 1) for a in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 300)]
    edges += [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(250)] + [(7, 7)]
    up = {n: n for e in edges for n in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    rng.shuffle(edges)
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in up if find(n) != n}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_sketches_tell_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.8, 1.0):
        scores = []
        for _ in range(40):
            common = rng.integers(0, 1 << 63, size=int(400 * share), dtype=np.uint64)
            rest = rng.integers(0, 1 << 63, size=(2, (400 - len(common)) // 2), dtype=np.uint64)
            signs = np.stack([near.signature(np.concatenate([common, r])).astype(np.uint32) for r in rest])
            sketch = near._sketch(signs).view(np.uint64)
            scores.append(int(near.matches(sketch[0], sketch[1])))
        assert np.mean(scores) == pytest.approx(near.HASHES * (share + (1 - share) / 4), abs=3)
        assert share < 0.8 or min(scores) >= near.MATCHES


def test_forest_keys_hold_the_tree_and_its_hashes(spark):
    reps = near.representatives(near.signed(edge_documents(spark)))
    rows = near.forest(reps)
    assert rows.count() == near.TREES * reps.count()
    assert rows.where(F.length("key") != 1 + 4 * near.DEPTH).count() == 0
    assert {len(r["sketch"]) for r in by(rows, "rep", "key")} == {near.HASHES // 4}


def test_slots_are_counted_in_a_few_rows_a_task_however_large_the_group(spark):
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, size=300, dtype=np.uint64) * np.uint64(2) for _ in range(20)] * 8
    frame = spark.createDataFrame([(x.tobytes(),) for x in sets], "items binary").repartition(8)
    packed = frame.mapInArrow(near._slots, "part long, slots binary, n binary")
    assert packed.count() <= 8 * near.PARTS
    counts = Counter()
    for row in packed.repartition("part").mapInArrow(near._summed, packed.schema).collect():
        slots, n = (np.frombuffer(row[c], dtype=np.int64).tolist() for c in ("slots", "n"))
        assert not counts.keys() & set(slots)
        counts.update(dict(zip(slots, n)))
    assert counts == Counter(s for x in sets for s in near._slot(x).tolist())
