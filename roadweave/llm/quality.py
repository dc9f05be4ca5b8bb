"""Quality rules with the frequency of lines across documents, by built-in functions alone.

Lines are normalised (lower case, one space for white space, trimmed) and hashed. A line that is in too many distinct
documents of a host is boilerplate. Exact copies of one text are one document, so that they don't make each other's
lines boilerplate; near copies are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.llm.common import SPACE, SPACES, text_of, word_count
from roadweave.sources.tables import materialize

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
LEAST_DOCUMENTS = 5  # a line in at most so many documents of a host always stays
MAX_HOST_PERCENT = 5
MIN_LEFT_PERCENT = 50
SYMBOLS = "#*$%&|<>"


def _normal(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE, " "))


def _line_key(normal: Column) -> Column:
    return F.substring(F.md5(normal), 1, 16)


def _tail(array: str, start: int) -> Column:
    return F.slice(array, start, F.greatest(F.size(array), F.lit(1)))


def _repeated_words(frame: DataFrame) -> DataFrame:
    """Adds n_repeat_words from the array ``_words``: words covered by windows that occur more than once.

    Windows are compared by a 64-bit hash. Only documents with a repeated window sort them.
    """
    shifted = F.arrays_zip(*(_tail("_words", k + 1).alias(f"w{k}") for k in range(WINDOW)))
    count = F.size("_words") - (WINDOW - 1)
    frame = frame.withColumn(
        "_hashes", F.when(count >= 2, F.slice(F.transform(shifted, lambda x: F.xxhash64(x)), 1, F.greatest(count, F.lit(1))))
    )
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    at = F.sequence(F.lit(0), F.size("_hashes") - 1)
    frame = frame.withColumn(
        "_sorted", F.when(repeats, F.sort_array(F.arrays_zip(F.col("_hashes").alias("h"), at.alias("i"))))
    )
    frame = frame.withColumn(
        "_same", F.zip_with("_sorted", F.slice("_sorted", 2, F.greatest(F.size("_sorted"), F.lit(1))), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    )
    beside = F.arrays_zip(
        F.col("_sorted").alias("s"), F.col("_same").alias("next"), F.concat(F.array(F.lit(False)), "_same").alias("prev")
    )
    starts = F.sort_array(
        F.transform(F.filter(beside, lambda x: x["s"].isNotNull() & (x["next"] | x["prev"])), lambda x: x["s"]["i"])
    )
    begin = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        starts, begin,
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"],
    )
    return frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_hashes", "_sorted", "_same")


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id, host, text_key, the base measures, and the document's distinct lines (hash, words, occurrences).

    ``text_key`` is a digest of the text: rows that agree in doc_id, host and text are judged alike. Null text has no
    words and no lines.
    """
    text = text_of()
    bare = F.btrim("_text", F.lit(SPACES))
    frame = docs.select("doc_id", F.col("source").cast("string").alias("host"), text.alias("_text"))
    frame = frame.withColumn("_words", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)))
    frame = _repeated_words(frame)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    frame = frame.withColumn("_lines", lines)
    normal = F.transform("_lines", _normal)
    return frame.select(
        "doc_id", "host", F.md5("_text").alias("text_key"), F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(normal, lambda x: F.struct(_line_key(x).alias("line"), word_count(x).alias("words"))).alias("lines"),
    )


def frequent_lines(
    measures: DataFrame, least: int = LEAST_DOCUMENTS, percent: int = MAX_HOST_PERCENT
) -> DataFrame:
    """host, line, n_documents of lines in more than ``least`` and ``percent`` of the host's distinct documents."""
    distinct = F.array_distinct(F.transform("lines", lambda x: x["line"]))
    docs = measures.select("host", "text_key", distinct.alias("_lines")).dropDuplicates(["host", "text_key"])
    counts = docs.select("host", F.explode("_lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_documents"))
    sizes = measures.groupBy("host", "text_key").agg(F.count("*").alias("n")).groupBy(F.col("host").alias("h_host")).agg(
        F.count("*").alias("host_documents")
    )
    over = (F.col("n_documents") > least) & (F.col("n_documents") * 100 > F.col("host_documents") * percent)
    some = counts.where(F.col("n_documents") > least)
    return some.join(sizes, F.col("host").eqNullSafe(F.col("h_host"))).where(over).select("host", "line", "n_documents")


def _judged(docs: DataFrame) -> DataFrame:
    """``judged`` with the digests of each document's boilerplate lines, null where it has none."""
    measures = materialize(text_measures(docs))
    common = frequent_lines(measures).select(F.col("host").alias("f_host"), F.col("line").alias("f_line"))
    key = ["doc_id", "host", "text_key"]
    lines = measures.groupBy(*key).agg(F.first("lines").alias("lines")).select(*key, F.explode("lines").alias("x"))
    hit = F.col("host").eqNullSafe(F.col("f_host")) & (F.col("line") == F.col("f_line"))
    removed = lines.select(*key, "x.line", "x.words").join(common, hit).groupBy(
        F.col("doc_id").alias("r_id"), F.col("host").alias("r_host"), F.col("text_key").alias("r_key")
    ).agg(F.sum("words").alias("removed"), F.collect_set("line").alias("gone_lines"))
    mine = F.col("doc_id").eqNullSafe(F.col("r_id")) & F.col("host").eqNullSafe(F.col("r_host")) & (F.col("text_key") == F.col("r_key"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    gone = F.coalesce("removed", F.lit(0))
    left = F.col("n_words") - gone
    stays = (left >= MIN_WORDS) & (100 * left >= MIN_LEFT_PERCENT * F.col("n_words"))
    return measures.drop("lines").join(removed, mine, "left").select(
        *key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        gone.alias("n_boilerplate_words"), (~failed & stays).alias("kept"), "gone_lines",
    )


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the base measures, words in boilerplate lines, base_failed and kept.

    Hosts are sources; null is a host. A document that passes the base rules is depleted, and goes, if fewer than ten
    words, or less than half of its words, are left without boilerplate lines. Empty and null texts fail the base rules;
    an empty table gives an empty result.
    """
    return _judged(docs).drop("gone_lines")


def passing(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents, columns as given."""
    bad = judged(docs).where("not kept").select(F.col("doc_id").alias("_bad_id"), F.col("host").alias("_bad_host"), F.col("text_key").alias("_bad_key"))
    marked = docs.withColumn("_bad_text", F.md5(text_of()))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_bad_id")) & F.col("source").cast("string").eqNullSafe(F.col("_bad_host"))
        & (F.col("_bad_text") == F.col("_bad_key"))
    )
    return marked.join(bad, same, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents and without the boilerplate lines of the others, columns as given.

    The lines that stay are the original ones, in order, blank ones included; a text without boilerplate is not touched.
    Where a text is, n_chars, if there is such a column, is its new length.
    """
    key = {"_bad_id": "doc_id", "_bad_host": "host", "_bad_key": "text_key"}
    marks = _judged(docs).where(~F.col("kept") | F.col("gone_lines").isNotNull()).select(
        *(F.col(c).alias(n) for n, c in key.items()), F.col("kept").alias("_bad_kept"), F.col("gone_lines").alias("_bad_lines")
    ).dropDuplicates(list(key))
    marked = docs.withColumn("_bad_text", F.md5(text_of()))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_bad_id")) & F.col("source").cast("string").eqNullSafe(F.col("_bad_host"))
        & (F.col("_bad_text") == F.col("_bad_key"))
    )
    stays = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_bad_lines", _line_key(_normal(x))))
    left = F.when(F.col("_bad_lines").isNotNull(), F.array_join(stays, "\n")).otherwise(F.col("text"))
    out = marked.join(marks, same, "left").where(F.coalesce("_bad_kept", F.lit(True))).withColumn("_bad_left", left)
    new = {"text": F.col("_bad_left")}
    if "n_chars" in docs.columns:
        size = F.length("_bad_left").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("_bad_lines").isNotNull(), size).otherwise(F.col("n_chars"))
    return out.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))
