from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from edges import SPACE, TEXTS, by, edge_documents, no_documents, words

from roadweave.llm import quality


def measures(text):
    text = text or ""
    own = words(text)
    windows = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    covered = {k for i in range(len(own) - 4) if windows[tuple(own[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(own), "word_chars": sum(map(len, own)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": len(own) < 10 or 100 * len(covered) > 20 * len(own),
    }


def normal(line):
    return SPACE.sub(" ", line).strip(" ").lower()


def verdicts(docs):
    """kept by brute force: lines counted in distinct documents of a host."""
    hashed = lambda x: hashlib.md5(x.encode()).hexdigest()[:16]
    lines = {i: [normal(x) for x in (t or "").split("\n") if words(x)] for i, (_, t, _, _) in enumerate(docs)}
    seen, texts = defaultdict(set), defaultdict(set)
    for i, (_, text, _, host) in enumerate(docs):
        texts[host].add(text or "")
        own = sorted({hashed(x) for x in lines[i]})
        for h in own:
            seen[host, h].add(text)
    out = []
    for i, (_, text, _, host) in enumerate(docs):
        m = measures(text)
        gone = sum(len(words(x)) for x in lines[i] if len(seen[host, hashed(x)]) > 5 and 100 * len(seen[host, hashed(x)]) > 5 * len(texts[host]))
        left = m["n_words"] - gone
        out.append(m | {"n_boilerplate_words": gone, "kept": not m["base_failed"] and left >= 10 and 100 * left >= 50 * m["n_words"]})
    return out


def check(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = sorted(repr(tuple(sorted((k, v) for k, v in r.items() if k not in ("host", "text_key")))) for r in by(quality.judged(frame), "n_words"))
    want = sorted(repr(tuple(sorted(({"doc_id": d[0]} | m).items()))) for d, m in zip(docs, verdicts(docs)))
    assert got == want


def test_edges(spark):
    check(spark, TEXTS)


def test_clashing_columns_and_empty_table(spark):
    docs = edge_documents(spark)
    kept = quality.passing(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 8, 9, 13}
    assert quality.judged(no_documents(spark)).collect() == []
    assert quality.passing(no_documents(spark)).schema == docs.schema


def own_line(i, n=14):
    return " ".join(f"w{i}q{k}" for k in range(n))


def test_boilerplate_goes_and_depleted_documents_with_it(spark):
    banner = "Subscribe now to our newsletter and never miss any of the great offers we make to all readers"
    docs = [(i, f"{banner}\n{own_line(i)}\n{own_line(i + 1000)}", None, "h") for i in range(40)]
    docs += [(100 + i, f"{banner}\n{banner.upper()}\n{banner}  \nonly {i} few words", None, "h") for i in range(10)]
    docs += [(200 + i, f"{banner}\n{own_line(i + 2000)}", None, "other") for i in range(3)]
    check(spark, docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.passing(frame).collect()}
    assert kept == {*range(40), 200, 201, 202}


def test_kept_documents_lose_their_boilerplate_lines(spark):
    banner = "Subscribe now to our newsletter and never miss any of the great offers we make to all readers"
    docs = [(i, f"{banner}\n{own_line(i)}\n\n  {banner.upper()} \nMy  {own_line(i + 1000, 30)}", "h", -1, "k") for i in range(40)]
    docs += [(100, f"{banner}\nfew words", "h", -1, "k"), (200, f"{banner}\n{own_line(1)}", "other", -1, "k"), (201, None, "other", None, "k")]
    docs += [(i, own_line(i), "h", -1, "k") for i in (300, 300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars int, kept string")
    out = quality.cleaned(frame)
    assert out.schema == frame.schema
    want = [(i, f"{own_line(i)}\n\nMy  {own_line(i + 1000, 30)}", "h", "k") for i in range(40)]
    want = [(*r[:3], len(r[1]), r[3]) for r in want] + [docs[41], *docs[43:]]
    assert [tuple(r.values()) for r in by(out, "doc_id")] == want


def test_copies_do_not_make_each_other_boilerplate(spark):
    """Exact copies are one document; near copies are documents of their own, so what they share is boilerplate."""
    shared = [own_line(k) for k in range(8)]
    docs = [(i, "\n".join(shared), None, "h") for i in range(60)]
    docs += [(300 + i, own_line(7000 + i), None, "h") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    assert quality.passing(frame).count() == len(docs)
    check(spark, docs)
    docs += [(100 + i, "\n".join([*shared[:7], own_line(5000 + i)]), None, "h") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.passing(frame).collect()} == set(range(300, 320))
    check(spark, docs)


@pytest.mark.parametrize("lines", [5, 20, 40])
def test_every_line_of_a_template_is_found(spark, lines):
    """200 pages of one host that share a template, however many lines it has, with one or three lines of their own."""
    template = [own_line(9000 + k, 6) for k in range(lines)]
    docs = [(i, "\n".join([*template, *(own_line(3 * i + k, 40 * lines) for k in range(1 + 2 * (i % 2)))]), "h", -1, "k") for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars int, kept string")
    out = {r.doc_id: r.text for r in quality.cleaned(frame).collect()}
    assert out == {i: "\n".join(t.split("\n")[lines:]) for i, t, *_ in docs}
    assert {r.n_boilerplate_words for r in quality.judged(frame).collect()} == {6 * lines}


def test_depleted_whatever_is_left(spark):
    """Of 1,000 words, 990 of boilerplate: ten words left are less than half."""
    banner = "\n".join(own_line(8000 + k, 10) for k in range(99))
    docs = [(i, f"{banner}\n{own_line(i, 10)}", None, "h") for i in range(40)]
    docs += [(100 + i, f"{own_line(8000, 10)}\n{own_line(500 + i, 12)}", None, "h") for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    assert {r.doc_id for r in quality.passing(frame).collect()} == set(range(100, 105))
    check(spark, docs)


def test_repeated_windows(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a", "a b c d e f", "x " * 4, "a b c d e x a b c d e y a b c d", "1 2 3 4 5 6 7 2 3 4 5 6 9"]
    frame = spark.createDataFrame([(i, t, None, "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert [r["n_repeat_words"] for r in by(quality.judged(frame), "doc_id")] == [measures(t)["n_repeat_words"] for t in texts]


def test_no_python_in_the_plan(spark):
    for plan in (quality.text_measures(edge_documents(spark)), quality.judged(edge_documents(spark))):
        assert not any(word in plan._jdf.queryExecution().toString() for word in ("Python", "Pandas", "Arrow"))
