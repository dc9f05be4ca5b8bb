from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from edges import LONG, TEXTS, by, edge_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from roadweave.llm import bitplanes, bpe, pretokens
from roadweave.llm.common import vocabulary

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

RANKS = vocabulary("byte_bpe_50k.tiktoken")
LIBRARY = vocabulary("byte_bpe_50k.json")
TRICKY = st.text(st.sampled_from(list("  \n\t\r''''streveldmSTa9²½Ⅷ.,!-　 日é\U0001f600\x1c\x85́")), max_size=60)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})


CODERS = {}


def ours(texts, limit=500_000):
    if limit not in CODERS:
        CODERS[limit] = pretokens.Coder(bpe.Merger(bpe.ranks(RANKS)), limit)
    ids, counts = CODERS[limit].code(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


def test_what_a_coder_forgets_changes_nothing(reference):
    texts = [" ".join(f"w{k}x{i * 31 % 997}" for k in range(40)) for i in range(60)] + ["a" * 90, ""]
    for _ in range(3):
        for t in texts:
            assert ours([t], limit=100) == [reference.encode_ordinary(t)]


def test_pieces_are_the_library_s(reference):
    text = "It's 12 o'clock,  isn't it?\n\n  Yes 日本 !!"
    parts, counts = pretokens.pieces([text, ""])
    assert b"".join(parts).decode() == text and counts.tolist() == [len(parts), 0]
    assert [k for p in parts for k in bpe.merged(p, bpe.ranks(RANKS))] == reference.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(TRICKY, st.text(max_size=40)), max_size=8))
def test_as_the_library(reference, texts):
    assert ours(texts) == [reference.encode_ordinary(t) for t in texts]


def test_every_code_point(reference):
    texts = [f"a{c}a1{c}1.{c}. {c}'s" for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff"]
    for at in range(0, len(texts), 100_000):
        part = texts[at : at + 100_000]
        assert ours(part) == [reference.encode_ordinary(t) for t in part]


@pytest.mark.parametrize("text", ["ab" * 20_000, "a" * 30_000, " " * 9_999, "日本" * 5_000, LONG])
def test_long_texts(reference, text):
    assert ours([text]) == [reference.encode_ordinary(text)]


def test_scan_is_the_automaton():
    """The blocked scan gives the states that stepping through gives."""
    go, _ = pretokens._transitions()
    _, of_symbol, products, *_ = pretokens._tables()
    marks = np.random.default_rng(1).integers(0, 9, size=1000)
    state, want = pretokens.FRESH, []
    for m in marks:
        want.append(state)
        state = go[m, state]
    assert pretokens.states_before(of_symbol[marks]).tolist() == want
    a, b, c = (np.random.default_rng(2).integers(0, len(products), size=(3, 500)))
    assert (products[products[a, b], c] == products[a, products[b, c]]).all()


def test_edges_round_trip(spark, reference):
    docs = edge_documents(spark)
    encoded = bpe.encode(docs, RANKS)
    rows = by(bpe.decode(encoded, RANKS).withColumn("digest", bpe.ids_digest()), "doc_id", "bytes")
    want = []
    for i, text, *_ in TEXTS:
        ids = reference.encode_ordinary(text or "")
        want.append((i, ids, (text or "").encode(), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [(r["doc_id"], r["ids"], bytes(r["bytes"]), r["digest"]) for r in rows] == want
    for r in rows:
        assert len(r["ends"]) == len(r["ids"]) and (not r["ends"] or r["ends"][-1] == len(r["bytes"]))
    assert bpe.encode(no_documents(spark), RANKS).collect() == []


def test_offsets_that_do_not_fit_are_found(spark):
    wrong = spark.createDataFrame([(1, [64, 65], [1, 3])], "doc_id long, ids array<int>, ends array<int>")
    with pytest.raises(Exception, match="offsets"):
        bpe.decode(wrong, RANKS).collect()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=40), max_size=8), st.sampled_from([1, 7, 8, 64]))
def test_files_of_planes(documents, chunk):
    arrays = [np.array(d, dtype="<u4") for d in documents]
    file = bitplanes.pack(arrays, chunk)
    assert [a.tolist() for a in bitplanes.unpack(file)] == documents
    flat = [x for d in documents for x in d]
    for k in range(-(-len(flat) // chunk)):
        assert bitplanes.read_chunk(file, k).tolist() == flat[k * chunk : (k + 1) * chunk]


def test_a_broken_file_is_found():
    file = bytearray(bitplanes.pack([np.arange(5000, dtype="<u4")]))
    with pytest.raises(ValueError, match="no such chunk"):
        bitplanes.read_chunk(bytes(file), 1)
    # the checksum of the only chunk, after the header, one document and the chunk's offset and count
    file[16 + 4 + 12] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        bitplanes.read_chunk(bytes(file), 0)


def planes_expected(docs):
    library = tokenizers.Tokenizer.from_file(LIBRARY)
    library.encode_special_tokens = True
    out, start = [], 0
    digest = lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), seed=42)).astype(np.int64)
    for i, text in sorted(((i, t or "") for i, t, *_ in docs), key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1]))):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize(("chunk", "file"), [(bitplanes.CHUNK_IDS, bitplanes.FILE_IDS), (64, 500)])
def test_edges_written_and_read(spark, chunk, file):
    newer = "".join(map(chr, (0x1C89, 0x1C8A, 0xA7CB, 0x10D6A, 0x2EBF0, 0x32000)))  # newer than some Unicode tables
    assert len(bitplanes.Library(LIBRARY).whole(newer)) and not bitplanes.plain(newer + "\U0003fffd")
    files = bitplanes.write_files(edge_documents(spark), LIBRARY, 2, chunk, file)
    rows = sorted(map(tuple, bitplanes.read_files(files).collect()), key=lambda r: r[1])
    assert rows == planes_expected(TEXTS)


def test_rows_without_id_are_dealt_to_many_files(spark):
    """Half of all rows have no doc_id, and many of those one text."""
    rows = [(None, "" if i % 2 else f"text {i}") for i in range(400)] + [(i, f"text {i} {'x' * (i % 50)}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which puts small ranges together
    try:
        files = bitplanes.write_files(frame, LIBRARY, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = {r.part: sum(i is None for i in r.doc_ids) for r in files.collect()}
    assert sum(n > 0 for n in parts.values()) >= 2 and max(parts.values()) < 400
    got = sorted(map(tuple, bitplanes.read_files(files).collect()), key=lambda r: r[1])
    assert got == planes_expected([(*r, None) for r in rows])


def test_a_worker_forgets_without_changing_ids(monkeypatch):
    texts = [f"word{i} and {i * 7919} more" for i in range(300)]
    whole = bitplanes.Library(LIBRARY)
    coder = pretokens.Coder(whole, 50)
    for k in range(0, 300, 30):
        ids, counts = coder.code(texts[k : k + 30])
        assert ids.tolist() == [i for t in texts[k : k + 30] for i in whole.whole(t).tolist()]
    assert bitplanes.odd(["plain", "ünï", "x\U0003fffd"]) == [2] and bitplanes.odd(["a", ""]) == []


def test_no_documents_no_files(spark):
    assert bitplanes.read_files(bitplanes.write_files(no_documents(spark), LIBRARY, 2)).collect() == []
