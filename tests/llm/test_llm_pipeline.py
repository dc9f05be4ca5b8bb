from __future__ import annotations

import hashlib
import sys
from collections import Counter
from fractions import Fraction
from pathlib import Path

import pytest
from edges import SPACE, TEXTS, edge_documents, no_documents, words
from test_llm_mix import reshared
from test_llm_near import brute
from test_llm_quality import verdicts

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from roadweave.llm import bpe  # noqa: E402
from roadweave.llm.common import vocabulary  # noqa: E402

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"


def copies(docs):
    """How often the mix takes each document whole."""
    sizes = Counter()
    for _, text, _, source in docs:
        sizes[source] += len(words(text))
    out = {}
    for source, target in reshared(dict(sizes)).items():
        due = round(float(target))
        passes, before = due // sizes[source], 0
        for i, text, *_ in sorted((d for d in docs if d[3] == source), key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()):
            size = len(words(text))
            cut = max(0, min(size, due - passes * sizes[source] - before))
            out[i] = passes + (cut > 0 and Fraction(cut) * 2 >= size)
            before += size
    return out


def by_hand(docs):
    """doc_id -> (times in the result, text)."""
    docs = [d for d, v in zip(docs, verdicts(docs)) if v["kept"]]
    first: dict = {}
    for d in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        first.setdefault(SPACE.sub(" ", d[1] or ""), d)
    docs = list(first.values())
    keep = {i for i, _, component in brute(docs) if i == component}
    docs = [d for d in docs if d[0] in keep]
    times = copies(docs)
    return {d[0]: (times[d[0]], d[1]) for d in docs if times[d[0]]}


def test_against_brute_force(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    want = by_hand(docs)
    assert Counter(r.doc_id for r in rows) == {i: n for i, (n, _) in want.items()}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(vocabulary("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(want[r.doc_id][1])


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "curriculum_mix", "byte_bpe"]


def test_boilerplate_does_not_reach_later_stages(spark):
    banner = "Read more of our stories every day and tell your friends about them"
    docs = [(i, f"{banner}\n" + " ".join(f"w{i}q{k}" for k in range(14)), "h") for i in range(20)]
    out = corpus_pipeline.quality(spark, spark.createDataFrame(docs, "doc_id long, text string, source string"), "")
    assert {r.doc_id: r.text for r in out.collect()} == {i: t.partition("\n")[2] for i, t, _ in docs}


@pytest.mark.parametrize("make", [edge_documents, no_documents])
def test_edges_through_all_stages(spark, make, tmp_path):
    """Nulls, odd texts, repeated rows and clashing columns pass through; every stage but the last keeps the columns."""
    docs = make(spark)
    schema, left = docs.schema, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.schema == schema
        left.append(docs.count())
    if make is edge_documents:
        # rejected: less than ten words, or too many repeated; then copies, the repeated row, and the near copy
        kept = [d for d, v in zip(TEXTS, verdicts(TEXTS)) if v["kept"]]
        texts = {SPACE.sub(" ", d[1]) for d in kept}
        assert left[:3] == [len(kept), len(texts), len(texts) - 1]
        assert set(docs.columns) == {"doc_id", "ids", "ends"}
    else:
        assert left == [0] * 5
