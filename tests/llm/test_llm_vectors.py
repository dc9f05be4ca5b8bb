from __future__ import annotations

import math
import random

import numpy as np
import pytest

from roadweave.llm import hard_negatives as hard
from roadweave.llm import top_k, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, strip int, score long, dim int"
CLASH = ("i", "v", 1, 2, 3)


def table(spark, rows, parts=3):
    """rows: (vec_id, embedding, label), under columns that operators use for their own."""
    return spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(parts)


def made(rng, n, dim=12, few=None):
    """Vectors, some of them equal to earlier ones; with ``few`` components from a handful of values, for ties."""
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.2:
            vector = rng.choice(rows)[1]
        else:
            vector = [np.float32(rng.choice(few) if few else rng.gauss(0, 0.3)).item() for _ in range(dim)]
        rows.append((i, vector, rng.randrange(3)))
    return rows


ODD = [
    (None, [0.1] * 12, 1), (100, None, 1), (200, [], 2), (300, [float("nan")] * 12, 1), (301, [None] + [0.5] * 11, 1),
    (302, [float("inf")] + [0.5] * 11, 0), (400, [0.5] * 5, 1), (401, [0.25] * 5, 2), (402, [-0.25] * 5, 1), (403, [0.5] * 12, None),
    (500, [0.0] * 12, 2), (7, [0.3] * 12, 2), (7, [0.3] * 12, 2), (600, [0.5] * 12, 2), (600, [-0.5] * 12, 1),
]


def whole(rows, scale, need_label=False):
    kept = [r for r in rows if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and not (need_label and r[2] is None)]
    return [(i, [math.floor(scale * float(x)) for x in v], label) for i, v, label in kept]


def asked(rows, every):
    """One query for each id: the smallest label and vector."""
    least = {}
    for i, v, label, *exact in rows:
        if i % every == 0:
            least[i] = min(least.get(i, (label, v)), (label, v))
    return least


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_nearest(rows, every, k):
    rows, out = [(i, v, 0) for i, v, _ in whole(rows, 1024)], []
    for q, (_, v) in asked(rows, every).items():
        best = sorted((-dot(v, w), i) for i, w, _ in rows if i != q and len(w) == len(v))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def brute_mined(rows, every):
    rows, out = [(i, v, (c + 1) % 10 if i % 7 == 0 else c) for i, v, c in whole(rows, 256, True)], []
    for q, (label, v) in asked(rows, every).items():
        scores = sorted((-dot(v, w), i, c) for i, w, c in rows if i != q and len(w) == len(v))
        for s, p, c in [x for x in scores if x[2] == label][:5]:
            inside = [(-t, i) for t, i, d in scores if d != label and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(q, p, n, i, -s, t) for n, (t, i) in enumerate(inside, 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("few", [None, [0.0, 0.5, -0.5]])
def test_top_k_against_all_pairs(spark, few):
    rows = made(random.Random(7), 300, few=few) + ODD
    frame = top_k.nearest(table(spark, rows), every=20)
    assert frame.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(frame) == brute_nearest(rows, 20, 10)


def test_top_k_with_small_blocks_and_several_groups(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES", 8)
    rows = made(random.Random(8), 200, dim=5)
    plain = table(spark, rows).selectExpr("vec_id as id", "embedding as vector")
    index = top_k.build_index(plain, strips=3)
    assert got(top_k.search(index, plain, 4)) == brute_nearest(rows, 1, 4)


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = made(random.Random(9), 4)
    assert got(top_k.nearest(table(spark, rows), every=2)) == brute_nearest(rows, 2, 10)
    assert got(top_k.nearest(table(spark, []))) == []
    assert got(top_k.nearest(table(spark, rows[1:]))) == []  # no query


def test_the_index_holds_every_row(spark):
    rows = made(random.Random(10), 500)
    index = top_k.build_index(table(spark, rows, 7).selectExpr("vec_id as id", "embedding as vector"))
    ids = [i for r in index.collect() for i in np.frombuffer(r.ids, "<i8").tolist()]
    assert sorted(ids) == list(range(500))


def test_slices(rng=np.random.default_rng(3)):
    for n in (1, 63, 64, 200):
        values = rng.integers(-500, 500, (n, 4))
        least, shift, slices = top_k.sliced(values)
        bits = np.unpackbits(slices.view(np.uint8), axis=-1, bitorder="little", count=n)
        back = (bits.transpose(2, 0, 1) * (1 << np.arange(top_k.BITS))).sum(axis=2)
        assert ((values - least) >> shift == back).all()
        # sums of slices, and the two ways down from the most significant slice
        weights = [slices[:, b] for b in range(top_k.BITS)]
        sums = top_k.add_slices(weights)
        total = back.sum(axis=1)
        out = [np.unpackbits(s.view(np.uint8), bitorder="little", count=n) for s in sums]
        assert (sum(o.astype(int) << i for i, o in enumerate(out)) == total).all()
        every = top_k._bitmaps(np.ones(n, dtype=bool))
        for k in {1, n // 2 + 1, n}:
            assert top_k.kth_largest(sums, every, k) == sorted(total)[-k]
        for value in (-1, 0, 40, int(total.max()), 10_000):
            assert (np.unpackbits(top_k.at_least(sums, every, value).view(np.uint8), bitorder="little", count=n) == (total >= value)).all()


def test_large_components_are_refused(spark):
    rows = [(0, [1e30] * 3, 1), (1, [1.0] * 3, 1)]
    with pytest.raises(Exception, match="too large"):
        got(top_k.nearest(table(spark, rows)))
    rows = [(0, [2.0**29] * 3, 1), (1, [2.0**29] * 3, 1)]
    with pytest.raises(Exception, match="may not fit"):
        got(top_k.nearest(table(spark, rows)))


@pytest.mark.parametrize("few", [None, [0.0, 0.5, -0.5], [0.25]])
def test_mining_against_all_pairs(spark, few):
    rows = made(random.Random(11), 300, few=few) + ODD
    frame = hard.hard_negatives(table(spark, rows), every=10)
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got(frame) == brute_mined(rows, 10)


def test_mining_in_several_groups(spark, monkeypatch):
    monkeypatch.setattr(vectors, "QUERIES", 16)
    monkeypatch.setattr(hard, "CELLS", 200)
    rows = made(random.Random(12), 200)
    assert got(hard.hard_negatives(table(spark, rows), every=2)) == brute_mined(rows, 2)


def test_mining_without_rows_anchors_or_positives(spark):
    rows = made(random.Random(13), 30)
    assert got(hard.hard_negatives(table(spark, []))) == []
    assert got(hard.hard_negatives(table(spark, rows[1:]))) == []
    alone = [(0, rows[0][1], 9)] + [(i, v, 1) for i, v, _ in rows[1:]]
    assert got(hard.hard_negatives(table(spark, alone))) == brute_mined(alone, 100)


def test_windows_open_and_close():
    reader = hard.Windows(2, 30, 90)
    for score, negative, id_ in [(100, False, 1), (95, True, 2), (90, True, 3), (50, False, 4), (50, True, 5), (45, True, 6), (40, True, 7), (10, True, 8)]:
        reader.read(0, score, negative, id_)
    assert reader.out == [(0, 1, 1, 3, 100, 90), (0, 1, 2, 5, 100, 50), (0, 4, 1, 6, 50, 45), (0, 4, 2, 7, 50, 40)]
    assert not reader.open


def test_keys_sort_by_anchor_then_falling_score():
    rows = [(a, s, n, i) for a in (-5, 0, 9) for s in (-300, 0, 700) for n in (False, True) for i in (-1, 0, 8)]
    keys = {r: hard._keys(np.array([r[0]]), np.array([r[1]]), r[2], np.array([r[3]]))[0] for r in rows}
    assert sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3])) == sorted(rows, key=keys.get)
