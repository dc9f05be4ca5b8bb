"""Near-duplicates by an LSH forest: several sorted orders of MinHash signatures.

Texts become sets of hashed shingles, equal sets one representative. A signature is cut into trees of ``DEPTH`` hashes;
a tree sorts all representatives by its hashes. Neighbours in an order share a long prefix and are candidates; those
that share the first ``BASE`` hashes form a region. In a region of at most ``FULL`` all are candidates of each other.
A larger one goes deeper: there, the candidates are the ``NEAR`` next in sorted order, which share the longest
prefixes, and the member closest to all. A sketch of all hashes, two bits each, drops pairs that can't be similar.

Candidates are confirmed on whole sets, first each representative's best ones. Candidates of a small region that a
component so found doesn't hold together are confirmed too. The members of the large regions that stay in several
components go deeper by their rarest shingles: sets similar enough share one of the first of each, rarest first, so
whoever shares none is done with, however many the region holds. A shingle of few sets gives pairs; sets that share a
frequent one are compared within their regions, set by set, in blocks, and a block gives no more links than join its
components. So going deeper loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.llm.common import text_of
from roadweave.llm.components import components
from roadweave.sources.tables import materialize

WORDS, PERCENT = 4, 80
TREES, DEPTH, BASE = 16, 8, 3
HASHES = TREES * DEPTH
FULL, NEAR = 32, 4
MATCHES = 84  # of 128 two-bit hashes: six standard deviations below the mean of a similarity of 0.8
BUFFER = 50_000
BLOCK = 400_000  # shingles in a block of a large region, about
FEW = 64  # sets that share a rare shingle and are paired by it
SLOTS = 1 << 20  # counters of shingles, by the upper bits of their hashes; they go to every worker, 4 MB
PARTS = 16  # ranges of slots, each a row of packed counts
SALTS = 16
WORD_CACHE = 300_000
NO_ID = (1 << 62) + (1 << 61)  # representatives without doc_id get numbers from here
REGION = 1 + 4 * BASE

_FACTORS = np.random.default_rng(20240229).integers(1, 1 << 63, size=(2, HASHES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hash of a word; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, cache: _Words, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=len(words))], dtype=np.uint64)
    last = len(words) - width + 1
    out = hashes[:last].copy()
    for k in range(1, width):
        out = out * _STEP + hashes[k : k + last]
    return np.unique(_mix(out))


def signature(items: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(items), 1024):
        part = items[at : at + 1024, None] * _FACTORS[0]
        least = np.minimum(least, part.min(axis=0))
    return (_mix(least ^ _FACTORS[1]) >> np.uint64(32)).astype(">u4")


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Words()
    for batch in batches:
        sizes, keys, signs = [], [], []
        for text in batch.column("text"):
            items = shingles(text.as_py(), cache)
            sizes.append(len(items))
            keys.append(xxhash.xxh3_128_digest(items.tobytes()))
            signs.append(signature(items).tobytes() if len(items) else b"")
        columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys), pa.array(signs)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_shingles", "set_key", "sign"])


def signed(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.unhex(F.md5(text_of())).alias("text_key"), text_of().cast("binary").alias("text"))
    return rows.mapInArrow(_signed, "doc_id long, text_key binary, n_shingles long, set_key binary, sign binary")


def representatives(rows: DataFrame) -> DataFrame:
    """One row per distinct set: rep (smallest doc_id, or a number past all ids), where its text is, size, signature."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_key").alias("text_key"))
    found = rows.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(place).alias("p"), F.first("n_shingles").alias("n_shingles"), F.first("sign").alias("sign")
    )
    other = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64("set_key"), 3)
    return found.select(
        "set_key", F.coalesce("p.id", other).alias("rep"), F.col("p.id").alias("rep_id"), F.col("p.text_key").alias("text_key"),
        "n_shingles", "sign",
    )


def _sketch(signs: np.ndarray) -> np.ndarray:
    bits = np.stack([signs >> 1 & 1, signs & 1], axis=-1).astype(np.uint8).reshape(len(signs), -1)
    return np.packbits(bits, axis=1)


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        raw = np.frombuffer(b"".join(batch.column("sign").to_pylist()), dtype=np.uint8).reshape(n, 4 * HASHES)
        sketch = _sketch(raw.view(">u4").astype(np.uint32))
        for tree in range(TREES):
            part = raw[:, 4 * DEPTH * tree : 4 * DEPTH * (tree + 1)]
            key = np.hstack([np.full((n, 1), tree, dtype=np.uint8), part])
            yield pa.RecordBatch.from_arrays(
                [_binary(key), batch.column("rep"), batch.column("n_shingles"), _binary(sketch)],
                names=["key", "rep", "n_shingles", "sketch"],
            )


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def forest(reps: DataFrame) -> DataFrame:
    """A row per representative and tree: key (tree, hashes), rep, n_shingles, sketch, sorted by key."""
    rows = reps.select("rep", "n_shingles", "sign").mapInArrow(_planted, "key binary, rep long, n_shingles long, sketch binary")
    return rows.repartitionByRange("key", "rep").sortWithinPartitions("key", "rep")


def matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many two-bit hashes of the sketches (rows of 32 bytes as four words) agree."""
    x = a ^ b
    x = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
    return HASHES - np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes allow the similarity."""
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


class _Rows:
    """Sorted rows of the forest as arrays."""

    def __init__(self, key: np.ndarray, rep: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> None:
        self.key, self.rep, self.size, self.sketch = key, rep, size, sketch

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Rows:
        n = batch.num_rows
        key = np.frombuffer(b"".join(batch.column("key").to_pylist()), dtype=np.uint8).reshape(n, -1)[:, :REGION]
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(n, HASHES // 32)
        return cls(key, batch.column("rep").to_numpy(), batch.column("n_shingles").to_numpy(), sketch)

    def part(self, chosen) -> _Rows:
        return _Rows(self.key[chosen], self.rep[chosen], self.size[chosen], self.sketch[chosen])

    def after(self, other: _Rows) -> _Rows:
        pair = lambda name: np.concatenate([getattr(other, name), getattr(self, name)])
        return _Rows(pair("key"), pair("rep"), pair("size"), pair("sketch"))

    def __len__(self) -> int:
        return len(self.rep)


# what a pair comes from
SMALL_REGION, NEXT, MIDDLE = range(3)
CANDIDATES = "a long, b long, matches long, kind long, region binary, n_shingles long"


def _pairs(rows: _Rows, i: np.ndarray, j: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    fits = alike(rows.size[i], rows.size[j])
    i, j, kind = i[fits], j[fits], kind[fits]
    score = matches(rows.sketch[i], rows.sketch[j])
    good = (score >= MATCHES) & (rows.rep[i] != rows.rep[j])
    a, b = rows.rep[i[good]], rows.rep[j[good]]
    return np.minimum(a, b), np.maximum(a, b), score[good], kind[good]


def _candidates_in(rows: _Rows, full: int, near: int, large: bool = False) -> Iterator[pa.RecordBatch]:
    """Pairs of whole regions, and the members of large ones. ``large``: rows is a part of one large region."""
    n = len(rows)
    new = np.append(True, (rows.key[1:] != rows.key[:-1]).any(axis=1))
    region = np.cumsum(new) - 1
    sizes = np.bincount(region)
    mine = sizes[region]
    open_ = np.flatnonzero(mine > 1)
    big = (mine > full) | large
    found = []
    for step in range(1, max(full, near + 1)):
        open_ = open_[open_ + step < n]
        open_ = open_[(region[open_] == region[open_ + step]) & ((step <= near) | ~big[open_])]
        if not len(open_):
            break
        found.append(_pairs(rows, open_, open_ + step, np.where(big[open_], NEXT, SMALL_REGION)))
    starts = np.flatnonzero(new)
    for r in np.unique(region[big]) if big.any() else ():
        own = np.arange(starts[r], starts[r] + sizes[r])
        bits = np.unpackbits(rows.sketch[own].view(np.uint8), axis=1)
        usual = np.packbits(bits.mean(axis=0) >= 0.5).view(np.uint64)
        middle = own[np.argmax(matches(rows.sketch[own], usual[None, :]))]
        found.append(_pairs(rows, np.full(len(own), middle), own, np.full(len(own), MIDDLE)))
    if found:
        a, b, score, kind = (pa.array(np.concatenate(x)) for x in zip(*found))
        none = pa.nulls(len(a), pa.int64())
        yield pa.RecordBatch.from_arrays([a, b, score, kind, pa.nulls(len(a), pa.binary()), none], names=_NAMES)
    if big.any():
        own = rows.part(big)
        none = pa.nulls(len(own), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.rep), none, none, none, _binary(own.key), pa.array(own.size)], names=_NAMES
        )


_NAMES = ["a", "b", "matches", "kind", "region", "n_shingles"]


def _scanner(full: int, near: int, buffer: int):
    """Over rows in sorted order: a region is worked on once its end is seen, one that outgrows the buffer in parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Rows | None = None
        inside = False  # held belongs to a large region of which a part is done
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Rows.of(batch)
            held = rows if held is None else rows.after(held)
            ended = np.flatnonzero((held.key != held.key[-1]).any(axis=1))
            cut = int(ended[-1]) + 1 if len(ended) else 0
            if cut:
                first = int(np.flatnonzero((held.key != held.key[0]).any(axis=1))[0]) if inside else 0
                if first:
                    yield from _candidates_in(held.part(slice(0, first)), full, near, large=True)
                if first < cut:
                    yield from _candidates_in(held.part(slice(first, cut)), full, near)
                held, inside = held.part(slice(cut, None)), False
            if len(held) > buffer:
                yield from _candidates_in(held, full, near, large=True)
                held, inside = held.part(slice(-near, None)), True
        if held is not None:
            yield from _candidates_in(held, full, near, large=inside)

    return work


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Words()
    for batch in batches:
        sets = [shingles(text.as_py(), cache) for text in batch.column("text")]
        items, size = pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("label"), size, items], names=["rep", "label", "size", "items"])


def _slot(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _packed(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The counts that aren't 0, a row for each range of slots."""
    for part, held in enumerate(counts.reshape(PARTS, -1)):
        used = np.flatnonzero(held)
        if len(used):
            slots = (used + part * len(held)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([slots.tobytes()]), pa.array([held[used].tobytes()])], names=["part", "slots", "n"]
            )


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets have a shingle of each slot: at most ``PARTS`` rows a task, however many sets and shingles it has."""
    counts = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        for items in batch.column("items"):
            np.add.at(counts, _slot(np.frombuffer(items.as_py(), dtype=np.uint64)), 1)
    yield from _packed(counts)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of packed counts."""
    counts = np.zeros(SLOTS, dtype=np.int64)
    for batch in batches:
        for slots, n in zip(batch.column("slots"), batch.column("n")):
            counts[np.frombuffer(slots.as_py(), dtype=np.int64)] += np.frombuffer(n.as_py(), dtype=np.int64)
    yield from _packed(counts)


def _rarest(counts):
    """Over sets: the shingles of which similar sets share one, in order of their slot's count, with their place.

    Sets with 100 * common >= 80 * union have at least 80 % of either's shingles in common. A shingle alone in its slot
    is in no other set and is left out, its place isn't.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, places, rows = [], [], []
            for k, items in enumerate(batch.column("items")):
                own = np.frombuffer(items.as_py(), dtype=np.uint64)
                often = counts.value[_slot(own)]
                order = np.lexsort((own, often))[: len(own) + (-len(own) * PERCENT // 100) + 1]
                shared = np.flatnonzero(often[order] > 1)
                tokens.append(own[order[shared]].view(np.int64))
                places.append(shared)
                rows.append(np.full(len(shared), k))
            at = pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64), pa.int64())
            flat = [pa.array(np.concatenate(x) if x else np.zeros(0, dtype=np.int64), pa.int64()) for x in (tokens, places)]
            yield pa.RecordBatch.from_arrays(
                [*flat, *(batch.column(c).take(at) for c in ("rep", "label", "size"))], names=["token", "place", "rep", "label", "size"]
            )

    return work


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            raw = np.frombuffer(b"".join(batch.column("sign").to_pylist()), dtype=">u4").reshape(batch.num_rows, HASHES)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), _binary(_sketch(raw.astype(np.uint32)))], names=["rep", "sketch"])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(-1, HASHES // 32) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array(matches(a, b) >= MATCHES))


def _joining(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join the components of a block of those outside with those of a block of their region.

    One row of the left block against all of the right one is a look at each of the right block's shingles. Labels
    that a link has joined count as one from there on, so there are fewer links than labels.
    """
    left, right = rows[rows["outside"]], rows[~rows["outside"]]
    out: dict[str, list[int]] = {"a": [], "b": []}
    if len(left) and len(right):
        sets = [np.frombuffer(x, dtype=np.uint64) for x in right["items"]]
        size = np.array([len(x) for x in sets])
        vocabulary, codes = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(size) - size
        names, label = np.unique(np.concatenate([left["label"], right["label"]]), return_inverse=True)
        root = np.arange(len(names))
        theirs, rep = label[len(left) :], right["rep"].to_numpy()
        for own_rep, own_label, items in zip(left["rep"], label, left["items"]):
            own = np.frombuffer(items, dtype=np.uint64)
            at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
            mark = np.zeros(len(vocabulary), dtype=np.int64)
            mark[at[vocabulary[at] == own]] = 1
            common = np.add.reduceat(mark[codes], starts)
            linked = 100 * common >= PERCENT * (size + len(own) - common)
            for k in np.flatnonzero(linked & (root[theirs] != root[own_label])):
                if root[theirs[k]] != root[own_label]:
                    root[root == root[theirs[k]]] = root[own_label]
                    out["a"].append(min(own_rep, rep[k]))
                    out["b"].append(max(own_rep, rep[k]))
    return pd.DataFrame(out, dtype="int64")


def _labelled(frame: DataFrame, labels: DataFrame, column: str, to: str) -> DataFrame:
    """Adds ``to``: the label of the node in ``column``, itself where it has none."""
    named = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return frame.join(named, column, "left").withColumn(to, F.coalesce("_label", column)).drop("_label")


def _parted(members: DataFrame) -> DataFrame:
    """The members (region, rep, label) of regions that hold several labels; a hot region is spread by a salt."""
    mixed = members.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    each = mixed.select(F.col("region").alias("_region"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    here = (F.col("region") == F.col("_region")) & (F.pmod(F.xxhash64("rep"), F.lit(SALTS)) == F.col("_salt"))
    return members.join(each, here, "left_semi")


def _shared_rare(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different labels that share a rare shingle of few sets; rep of the sets that share one of many."""
    spark = sets.sparkSession
    packed = "part long, slots binary, n binary"
    found = sets.select("items").mapInArrow(_slots, packed).repartition("part").mapInArrow(_summed, packed).collect()
    counts = np.zeros(SLOTS, dtype=np.uint32)
    for row in found:
        n = np.frombuffer(row["n"], dtype=np.int64)
        counts[np.frombuffer(row["slots"], dtype=np.int64)] = np.minimum(n, np.iinfo(np.uint32).max)
    work = _rarest(spark.sparkContext.broadcast(counts))
    rare = materialize(sets.mapInArrow(work, "token long, place long, rep long, label long, size long"))
    having = rare.groupBy("token").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    mine = materialize(rare.join(having.select("token", "n"), "token"))
    few = mine.where(F.col("n") <= FEW)
    x, y = (few.select("token", *(F.col(c).alias(f"{c}_{side}") for c in ("rep", "label", "size", "place"))) for side in "ab")
    # from the first shingle in common on, both must have enough left
    left = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    enough = (100 + PERCENT) * left >= PERCENT * (F.col("size_a") + F.col("size_b"))
    pairs = x.join(y, "token").where((F.col("rep_a") < F.col("rep_b")) & (F.col("label_a") != F.col("label_b")) & enough)
    many = mine.where(F.col("n") > FEW).select("rep").distinct()
    return pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), many


def _in_blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of regions from outside the region's largest component, enough to join what is linked."""
    counts = rows.groupBy("region", "label").agg(F.sum("n_shingles").alias("n"))
    totals = counts.groupBy("region").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("inside"), F.count("*").alias("labels")
    )
    # regions of one component are done with
    known = rows.join(totals.where("labels > 1"), "region").withColumn("outside_n", F.col("all") - F.col("inside"))
    known = materialize(known.join(sets.select("rep", "items"), "rep"))
    blocks = lambda total: F.greatest(F.ceil(F.col(total) / BLOCK), F.lit(1)).cast("long")
    every = lambda total: F.sequence(F.lit(0).cast("long"), blocks(total) - 1)
    mine = lambda total: F.pmod(F.xxhash64("rep"), blocks(total))
    cols = ["region", "i", "j", "rep", "items", "label"]
    left = known.where("label <> main").withColumn("i", mine("outside_n")).withColumn("j", F.explode(every("all")))
    right = known.withColumn("j", mine("all")).withColumn("i", F.explode(every("outside_n")))
    both = left.select(*cols, F.lit(True).alias("outside")).unionByName(right.select(*cols, F.lit(False).alias("outside")))
    return both.groupBy("region", "i", "j").applyInPandas(_joining, "a long, b long").distinct()


def _outside_links(members: DataFrame, labels: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components that share a large region, enough to join what is linked."""
    rows = materialize(_parted(materialize(_labelled(members, labels, "rep", "label"))))
    open_ = rows.select("rep", "label").distinct()
    sets = materialize(texts.join(open_, "rep").mapInArrow(_items, "rep long, label long, size long, items binary"))
    pairs, many = _shared_rare(sets)
    sketches = materialize(reps.select("rep", "sign").join(open_, "rep", "left_semi").mapInArrow(_sketched, "rep long, sketch binary"))
    for side in "ab":
        pairs = pairs.join(sketches.select(F.col("rep").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)
    likely = materialize(pairs.mapInArrow(_likely, "a long, b long"))
    return confirm(likely, texts).unionByName(_in_blocks(rows.join(many, "rep", "left_semi"), sets))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache, last = _Words(), (None, None)
    for batch in batches:
        links = []
        for i in range(batch.num_rows):
            a = batch.column("a")[i].as_py()
            if last[0] != a:
                last = a, shingles(batch.column("text_a")[i].as_py(), cache)
            x, y = last[1], shingles(batch.column("text_b")[i].as_py(), cache)
            common = len(x) + len(y) - len(np.union1d(x, y))
            links.append(100 * common >= PERCENT * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))


def _best(pairs: DataFrame) -> DataFrame:
    """Of each representative, its likeliest partner, and its likeliest among the middle members of large regions."""
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("e"), "matches", "most")
    score = F.struct("matches", F.col("e.y").alias("y"))
    chosen = ends.groupBy("e.x").agg(
        F.max(score)["y"].alias("likely"), F.max(F.when(F.col("most") == MIDDLE, score))["y"].alias("middle")
    )
    each = chosen.select("x", F.explode(F.array("likely", "middle")).alias("y")).where("y is not null")
    return each.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; ``texts``: rep, text."""
    first = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirmed, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key for every row of ``docs``.

    Null, empty and white texts have no shingles and are linked with nothing, repeated rows included: their component
    is themselves. Rows without doc_id count in their component, whose id is null only if no row in it has one. Rows
    that agree in doc_id and text get the same answer.
    """
    rows = materialize(signed(docs))
    reps = materialize(representatives(rows))
    found = materialize(forest(reps).mapInArrow(_scanner(FULL, NEAR, BUFFER), CANDIDATES))
    pairs = materialize(
        found.where("b is not null").groupBy("a", "b").agg(
            F.max("matches").alias("matches"), F.min("kind").alias("least"), F.max("kind").alias("most")
        )
    )
    members = found.where("region is not null").select("region", F.col("a").alias("rep"), "n_shingles").distinct()

    nodes = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).union(members.select("rep")).distinct()
    places = reps.select("rep", F.col("rep_id").alias("_rep_id"), F.col("text_key").alias("_text_key")).join(nodes, "rep", "left_semi")
    written = docs.select("doc_id", F.unhex(F.md5(text_of())).alias("text_key"), text_of().cast("binary").alias("text"))
    here = F.col("doc_id").eqNullSafe(F.col("_rep_id")) & (F.col("text_key") == F.col("_text_key"))
    texts = materialize(written.join(places, here).select("rep", "text").dropDuplicates(["rep"]))

    links = materialize(confirm(_best(pairs), texts))
    labels = materialize(components(links))
    apart = _labelled(_labelled(pairs.where(F.col("least") == SMALL_REGION), labels, "a", "la"), labels, "b", "lb")
    rest = apart.where("la <> lb").join(_best(pairs), ["a", "b"], "left_anti").select("a", "b")
    more = materialize(confirm(rest, texts).unionByName(_outside_links(members, labels, reps, texts)))
    # links between components join them; most often there are none
    across = _labelled(_labelled(more, labels, "a", "la"), labels, "b", "lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    joined = components(across)
    raised = _labelled(labels, joined, "label", "top").select("node", F.col("top").alias("label"))
    final = raised.unionByName(joined.join(raised, "node", "left_anti"))
    sets = reps.select("set_key", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("label", "rep").alias("component")
    )
    linked = rows.select("doc_id", "text_key", "n_shingles", "set_key").join(sets, "set_key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("component") < NO_ID, F.col("component"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), "text_key").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    ).select("doc_id", "n_shingles", "component_id", "kept", "text_key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, columns as given."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key"))
    marked = docs.withColumn("_gone_text", F.unhex(F.md5(text_of())))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.col("_gone_text") == F.col("_gone_key"))
    return marked.join(gone, same, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
