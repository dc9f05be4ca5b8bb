"""Documents that break things, and plain restatements of what operators promise."""

from __future__ import annotations

import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, digest string, size bigint, "
    "bucket int, position double, shard int, text_key string, component_id string, host string, copies string, _words string"
)
CLASH = (True, "d", -1, 0, 0.5, 3, "k", "c", "h", "x", "w")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
BODY = "the quick brown fox jumps over the lazy dog and then goes home to sleep for a long while under the old tree"

TEXTS = [
    (1, BODY, "en", "a"),
    (2, BODY.replace(" ", "\n\t"), "en", "a"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n\x0b\x0c\r ", "en", None),
    (6, "single", "fr", "b"),
    (7, "a b c", "fr", "b"),
    (8, LONG, "en", "b"),
    (9, BODY + " quietly", "en", "b"),
    (10, "x" * 50_000, None, "b"),
    (11, "Ünïcödé 日本語 \U0001f600 text's end here   ok", "de", "c"),
    (12, "same line here\nsame line here\nsame line here\nother words follow", "en", "c"),
    (None, BODY, "en", None),
    (None, "no id here, only a text of some words that stands alone", None, "c"),
    (13, "twice the same row in every column of the table it is", "en", "c"),
    (13, "twice the same row in every column of the table it is", "en", "c"),
    (14, "<|endoftext|> is ordinary text ''s 'll don't DON'T", "en", "z"),
    (15, "123 456 !!! ??? 2024-05-06", None, "z"),
]


def edge_documents(spark):
    rows = [(i, t, lang, source, None if t is None else len(t), *CLASH) for i, t, lang, source in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def by(df, *keys: str) -> list[dict]:
    """Rows as dicts, ordered by some columns, nulls last."""
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: [(r[k] is None, r[k]) for k in keys])
