"""Language of a text by prediction by partial matching over bytes.

For each language a tree of contexts of up to ``ORDER`` bytes counts what follows them in a bounded sample of labelled
texts. A byte seen after its longest context costs -log2(count / (total + distinct)) bits; an unseen one first costs the
escape -log2(distinct / (total + distinct)), then what it costs after the context shortened by a byte, down to 8 bits
(escape method C, no exclusions). Contexts a language hasn't seen cost nothing to leave. The counts stay as
trained. The language under which the whole text, in lower case, has the shortest code wins.

Scoring looks grams up, not trees: the code length of a byte after a context depends on at most ORDER + 1 bytes, so the
lengths of all grams any language has seen are tabled once, for all languages side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.lookup import Lookup
from roadweave.sources.tables import materialize

ORDER = 4
SAMPLE_BYTES = 2_000_000  # of training text, over all languages; the model's size follows from it
PIECES, LEAST_PIECE = 64, 64  # of a share; code points of the shortest piece
PAD = b"\n" * ORDER
CHUNK_BYTES = 1 << 20


def _grams(data: np.ndarray, length: int) -> np.ndarray:
    """Each position's last ``length`` bytes as a number; the first positions are of no use."""
    out = np.zeros(len(data), dtype=np.uint64)
    for k in range(length):
        out[k:] |= data[: len(data) - k].astype(np.uint64) << np.uint64(8 * k)
    return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end, each after ORDER line feeds; which positions are text; the texts' lengths."""
    data = np.frombuffer(b"".join(PAD + t for t in texts), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    pads = np.repeat(np.cumsum(lengths + ORDER) - lengths - ORDER, ORDER) + np.tile(np.arange(ORDER), len(texts))
    real = np.ones(len(data), dtype=bool)
    real[pads] = False
    return data, real, lengths


def count_grams(texts: list[bytes]) -> pd.DataFrame:
    """length, gram, n of every gram of 1 to ORDER + 1 bytes that ends in a text."""
    data, real, _ = _joined(texts)
    out = []
    for length in range(1, ORDER + 2):
        gram, n = np.unique(_grams(data, length)[real], return_counts=True)
        out.append(pd.DataFrame({"length": length, "gram": gram.astype(np.int64), "n": n}))
    return pd.concat(out)


class Table(Lookup):
    """Grams of one length, each with its cost under every language."""

    def __init__(self, grams: np.ndarray, cost: np.ndarray) -> None:
        super().__init__(grams)
        self.cost = cost.astype(np.float32)


@dataclass
class Model:
    """Code lengths of all languages: ``code[m]`` tables grams of m bytes, ``leave[m]`` the escapes from contexts of m."""

    languages: list[str]
    code: list[Table | None]
    leave: list[Table | None]
    root: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language."""
        data, real, lengths = _joined(texts)
        total = np.zeros((int(lengths.sum()), len(self.languages)), dtype=np.float32)
        grams = _grams(data, ORDER + 1)[real]
        open_ = np.arange(len(total))
        for length in range(ORDER + 1, 0, -1):
            own = grams if length == ORDER + 1 else grams[open_] & np.uint64((1 << 8 * length) - 1)
            row = self.code[length].find(own)
            hit = row >= 0
            if length == ORDER + 1:
                total[hit] = self.code[length].cost[row[hit]]
            else:
                total[open_[hit]] += self.code[length].cost[row[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
            if length > 1:
                context = (grams[open_] & np.uint64((1 << 8 * length) - 1)) >> np.uint64(8)
                row = self.leave[length - 1].find(context)
                known = row >= 0
                total[open_[known]] += self.leave[length - 1].cost[row[known]]
            else:
                total[open_] += self.root
        out = np.zeros((len(texts), len(self.languages)))
        some = lengths > 0
        if some.any():
            starts = (np.cumsum(lengths) - lengths)[some]
            out[some] = np.add.reduceat(total, starts, axis=0, dtype=np.float64)
        return out


def build(counts: pd.DataFrame) -> Model:
    """``counts``: lang, length, gram, n."""
    languages = sorted(counts["lang"].unique(), key=lambda x: x.encode())
    number = {name: k for k, name in enumerate(languages)}
    width = len(languages)
    code: list[Table | None] = [None] * (ORDER + 2)
    leave: list[Table | None] = [None] * (ORDER + 1)
    shorter, shorter_cost, root = np.zeros(1, dtype=np.uint64), np.full((1, width), 8.0), np.zeros(width)
    for length in range(1, ORDER + 2):
        part = counts[counts["length"] == length]
        gram = part["gram"].to_numpy().astype(np.uint64)
        grams, row = np.unique(gram, return_inverse=True)
        n = np.zeros((len(grams), width))
        n[row, part["lang"].map(number).to_numpy()] = part["n"].to_numpy()
        contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
        total, distinct = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, of, n)
        np.add.at(distinct, of, n > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            seen = -np.log2(n / (total + distinct)[of])
        # what the gram costs without its first byte: 8 bits for one byte, else from the table of shorter grams
        low = grams & np.uint64((1 << 8 * (length - 1)) - 1)
        below = shorter_cost[np.searchsorted(shorter, low)] if length > 1 else np.full((len(grams), width), 8.0)
        cost = np.where(n > 0, seen, escape[of] + below)
        code[length] = Table(grams, cost)
        if length > 1:
            leave[length - 1] = Table(contexts, escape)
        else:
            root = escape[0] + 8.0
        shorter, shorter_cost = grams, cost
    return Model(languages, code, leave, root)


def _held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


def training_sample(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """lang, text (lower case, bytes) of labelled documents that aren't held out, an equal share of bytes a language.

    Texts are cut into pieces of a 64th of the share, and pieces come in the order of a digest until the share is used up;
    so short and long texts give as much as they have, and every label with a letter in its texts is learnt. A language
    with less than its share gives all of it. The bound is on what is used to fit; predictions look at whole texts.
    """
    text = F.lower("text")
    known = F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~_held_out()
    rows = docs.where(known).select(
        F.col("lang").cast("string").alias("lang"), F.octet_length(text).cast("long").alias("size"),
        F.md5(F.concat_ws(" ", F.col("doc_id").cast("string"), F.md5("text"))).alias("key"), text.alias("text"),
    )
    # one entry per language, looked up where the rows are, so that only the thinned selection is cut and shuffled
    sizes = rows.groupBy("lang").agg(F.sum("size").alias("all")).agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "all"))).alias("sizes")
    ).scalar()
    share = F.lit(sample_bytes) / F.greatest(F.size(sizes), F.lit(1))
    chars = F.greatest(F.floor(share / PIECES), F.lit(LEAST_PIECE)).cast("int")
    thin = share / F.element_at(sizes, F.col("lang")) * F.lit(float(4 << 32))
    last = F.floor((F.length("text") - 1) / F.col("chars")).cast("int")
    drawn = lambda i: F.pmod(F.xxhash64("key", i), F.lit(1 << 32)) < F.col("thin")
    picked = rows.withColumns({"share": share, "chars": chars, "thin": thin}).select(
        "lang", "share", "key", "chars", "text", F.explode(F.filter(F.sequence(F.lit(0), last), drawn)).alias("piece")
    ).select("lang", "share", "key", "piece", F.substring("text", F.col("piece") * F.col("chars") + 1, F.col("chars")).alias("text"))
    before = Window.partitionBy("lang").orderBy(F.xxhash64("key", "piece"), "key", "piece")
    used = F.sum(F.octet_length("text").cast("long")).over(before)
    return picked.withColumn("used", used).where("used <= share").select("lang", F.col("text").cast("binary").alias("text"))


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    return count_grams(list(pdf["text"])).assign(lang=pdf["lang"].iloc[0])


def train(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """The model of a bounded sample; None if nothing is labelled. Counts reach the driver, a few times the sample."""
    sample = materialize(training_sample(docs, sample_bytes))
    counts = sample.groupBy("lang").applyInPandas(_counted, "lang string, length long, gram long, n long")
    table = counts.toArrow().to_pandas()
    return build(table) if len(table) else None


def _scorer(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            best, score = [], []
            run: list[bytes] = []

            def settle() -> None:
                if run:
                    bits = model.bits(run)
                    best.extend(bits.argmin(axis=1).tolist())
                    score.extend((1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)).tolist())
                    run.clear()

            held = 0
            for text in texts:
                if held + len(text) > CHUNK_BYTES:
                    settle()
                    held = 0
                run.append(text)
                held += len(text) + ORDER
            settle()
            lettered = batch.column("lettered").to_pylist()
            columns = [
                batch.column("doc_id"), batch.column("held_out"),
                pa.array([model.languages[k] if ok else "und" for k, ok in zip(best, lettered)], pa.string()),
                pa.array([s if ok else 0.0 for s, ok in zip(score, lettered)], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return work


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; ``und`` and 0 where the text is null or has no letter.

    The score is the posterior probability of the language with equal priors. Of equal code lengths, the language
    first in code-point order wins. Without a model everything is ``und``. Only the text is looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", _held_out().alias("held_out"), lettered.alias("lettered"), F.col("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    text = F.when(F.col("lettered"), F.lower("text")).otherwise(F.lit("")).cast("binary")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.withColumn("text", text).mapInArrow(
        _scorer(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
