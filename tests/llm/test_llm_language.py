from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from edges import by, edge_documents, no_documents

from roadweave.llm import language
from roadweave.llm.common import documents

TRAIN = {"aa": [b"the cat sat on the mat", b"a cat and a hat"], "bb": [b"der hund und die katze", b"die matte"]}


def tree_bits(texts: list[bytes], text: bytes) -> float:
    """Code length by walking one language's context tree, byte by byte."""
    counts: dict = {}
    for t in texts:
        padded = language.PAD + t
        for i in range(language.ORDER, len(padded)):
            for k in range(language.ORDER + 1):
                counts.setdefault(padded[i - k : i], {}).setdefault(padded[i], 0)
                counts[padded[i - k : i]][padded[i]] += 1
    padded, bits = language.PAD + text, 0.0
    for i in range(language.ORDER, len(padded)):
        for k in range(language.ORDER, -1, -1):
            after = counts.get(padded[i - k : i])
            if not after:
                continue
            total, distinct = sum(after.values()), len(after)
            if padded[i] in after:
                bits -= math.log2(after[padded[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


@pytest.fixture(scope="module")
def model():
    return language.build(pd.concat([language.count_grams(t).assign(lang=n) for n, t in TRAIN.items()]))


def test_code_lengths_are_those_of_the_trees(model):
    rng = random.Random(1)
    texts = [b"the katze", b"", b"x", b"zzzz \xff\x00", b"die matte und the hat" * 20]
    texts += [bytes(rng.choice(b"thecat undie") for _ in range(rng.randrange(60))) for _ in range(60)]
    want = [[tree_bits(TRAIN[n], t) for n in model.languages] for t in texts]
    assert np.allclose(model.bits(texts), want, rtol=1e-5)


def test_a_text_counts_the_same_alone_and_among_others(model):
    texts = [b"the cat", b"", b"der hund", b"a" * 1000]
    assert np.allclose(model.bits(texts), np.concatenate([model.bits([t]) for t in texts]))


def test_table_finds_what_it_holds():
    rng = np.random.default_rng(0)
    grams = np.unique(rng.integers(0, 1 << 40, size=5000, dtype=np.uint64))
    table = language.Table(grams, np.zeros((len(grams), 1)))
    assert (table.find(grams) == np.arange(len(grams))).all()
    assert (table.find(grams + np.uint64(1 << 41)) == -1).all()


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = language.predict(docs, language.train(docs)).collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert len(held) > 200
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.99
    assert {r.doc_id for r in rows if r.held_out} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}


def test_nothing_is_learnt_from_held_out_rows_or_from_other_columns(spark):
    rows = [(i, f"{'eins zwei drei' if i % 2 else 'one two three'} {i}", "xx" if i % 2 else "yy", "s") for i in range(60)]
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    frame = lambda data: spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    model = language.train(frame(wrong))
    assert model.languages == ["xx", "yy"]
    want = [r["lang_pred"] for r in by(language.predict(frame(rows), model), "doc_id")]
    assert want == ["xx" if i % 2 else "yy" for i in range(60)]
    blind = [(i, t, None, None) for i, t, _, _ in rows]
    assert [r["lang_pred"] for r in by(language.predict(frame(blind), model), "doc_id")] == want


def test_sample_is_bounded(spark):
    rows = [(i, "some words " * (1 + i % 7), "ab"[i % 10 == 0], "s") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sample = language.training_sample(frame, 8000).collect()
    per = {n: sum(len(r.text) for r in sample if r.lang == n) for n in "ab"}
    assert all(3000 < n <= 4000 for n in per.values())


def test_long_texts_are_learnt_too(spark):
    """200 short English texts, and twenty German ones that are each longer than an eighth of the share."""
    rng = random.Random(3)
    english, german = "the cat sat on a mat and went to sleep there".split(), "der hund und die katze sitzen auf einer matte".split()
    texts = [(i, " ".join(rng.choices(english, k=40)), "en", "s") for i in range(200)]
    texts += [(1000 + i, " ".join(rng.choices(german, k=30_000)), "de", "s") for i in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string").repartition(6)
    sample = language.training_sample(frame, 200_000).collect()
    per = {n: sum(len(r.text) for r in sample if r.lang == n) for n in ("de", "en")}
    assert 90_000 < per["de"] <= 100_000  # its share, within a tenth
    trained = [t for i, t, lang, _ in texts if lang == "en" and zlib.crc32(str(i).encode()) % 4 != 2]
    assert per["en"] == sum(map(len, trained))  # all there is
    got = by(language.predict(frame, language.train(frame, 200_000)), "doc_id")
    assert [r["lang_pred"] for r in got] == [lang for _, _, lang, _ in texts]


def test_pieces_of_a_text_are_its_own(spark):
    """Cut at code points, whole ones together giving the text back; repeated rows count as often as they come."""
    text = "".join(chr(0xE0 + i % 30) + "ab"[i % 2] for i in range(700))
    frame = spark.createDataFrame([(1, text, "xx", "s"), (1, text, "xx", "s"), (3, "b", "yy", "s")], "doc_id long, text string, lang string, source string")
    rows = [(r.lang, bytes(r.text).decode()) for r in language.training_sample(frame).collect()]
    assert sorted(n for n, _ in rows) == ["xx", "xx", "yy"] and {t for n, t in rows if n == "xx"} == {text}
    small = [bytes(r.text).decode() for r in language.training_sample(frame.limit(1), 10_000).collect()]
    assert all(t in text and len(t) <= 156 for t in small) and sum(map(len, small)) == len(text)


def test_edges(spark):
    docs = edge_documents(spark)
    rows = by(language.predict(docs, language.train(docs)), "doc_id", "score")
    und = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert len(rows) == docs.count() and und == {3, 4, 5, 15}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert language.train(no_documents(spark)) is None
    assert {r["lang_pred"] for r in by(language.predict(docs, None), "doc_id")} == {"und"}
    assert language.predict(no_documents(spark), None).collect() == []
