"""Contiguous shards of near-equal size: the smallest feasible capacity over ordered groups of equal texts.

Groups are ordered by the SHA-256 of their text and never split. Whether a capacity suffices is checked greedily: each
shard takes groups until the next one doesn't fit. The check needs the running sizes, of which the driver only ever
holds a bounded outline: running sizes at the borders of digest ranges. Ranges whose inside could matter for the
answer are split further, each time by one job over the groups in them, until the search is exact.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.common import pieces, text_of
from roadweave.sources.tables import materialize

SHARDS = 16
OUTLINE = 4096  # ranges that one job returns at most, about
SMALL = 64  # a range of at most so many groups is listed whole
BUCKET_ROWS = 20_000


@dataclass
class Outline:
    """Border k is the end of a known run of groups: ``ends[k]`` its running size, ``firsts[k]`` its first digest,
    ``opens[k]`` whether it holds more than one group, whose sizes are unknown but for the largest."""

    ends: list[int]
    firsts: list[str]
    opens: list[int]
    largest: list[int]
    starts: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.starts = [0, *self.ends[:-1]]

    def reach(self, start: int, capacity: int, hopeful: bool) -> tuple[int, int]:
        """How far a shard from ``start`` gets, and the border up to which all is known to fit.

        Hopeful: inside an open range, any size might be the end of a group; otherwise none is.
        """
        k = bisect.bisect_right(self.ends, start + capacity)
        known = self.ends[k - 1] if k else 0
        if hopeful and k < len(self.ends) and self.opens[k] > 1:
            return max(known, start + capacity), k
        return max(known, start), k

    def fits(self, capacity: int, shards: int, hopeful: bool) -> bool:
        at, total = 0, self.ends[-1]
        for _ in range(shards):
            at, _ = self.reach(at, capacity, hopeful)
            if at >= total:
                return True
        return False

    def least(self, shards: int, hopeful: bool) -> int:
        low, high = max([max(self.largest), -(-self.ends[-1] // shards)]), self.ends[-1]
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(middle, shards, hopeful) else (middle + 1, high)
        return low

    def touched(self, low: int, high: int, shards: int) -> list[int]:
        """Open ranges in which a cut may fall for a capacity from low to high."""
        out, at_low, at_high = set(), 0, 0
        for _ in range(shards):
            at_low, first = self.reach(at_low, low, False)
            at_high, last = self.reach(at_high, high, True)
            out.update(k for k in range(first, min(last + 1, len(self.ends))) if self.opens[k] > 1)
            if at_low >= self.ends[-1]:
                break
        return sorted(out)

    def cuts(self, capacity: int, shards: int) -> list[str]:
        """The first digests of the shards after the first."""
        out, at = [], 0
        for _ in range(shards - 1):
            at, k = self.reach(at, capacity, False)
            if k >= len(self.ends):
                break
            out.append(self.firsts[k])
        return out


def _ranges(groups: DataFrame, digits: int) -> list[tuple]:
    """(first digest, last digest, groups, size, largest) of each range of digests with equal leading hex digits."""
    per = groups.groupBy(F.substring("digest", 1, digits).alias("prefix")).agg(
        F.min("digest").alias("first"), F.max("digest").alias("last"), F.count("*").alias("n"), F.sum("size").alias("size"),
        F.max("size").alias("largest"),
    )
    return sorted((r["first"], r["last"], r["n"], r["size"], r["largest"]) for r in per.collect())


def minimax_cuts(groups: DataFrame, shards: int = SHARDS) -> tuple[int, list[str]]:
    """The smallest capacity that ``shards`` contiguous shards of whole groups need, and where to cut.

    ``groups``: digest (hex), size. Each job returns about ``OUTLINE`` rows, whatever the input.
    """
    digits = 3
    found = _ranges(groups, digits)
    if not found:
        return 0, []
    while True:
        ends, total = [], 0
        for r in found:
            total += r[3]
            ends.append(total)
        outline = Outline(ends, [r[0] for r in found], [r[2] for r in found], [r[4] for r in found])
        low, high = outline.least(shards, True), outline.least(shards, False)
        unsure = outline.touched(low, high, shards)
        if not unsure:
            return low, outline.cuts(low, shards)
        # split the ranges in doubt; a range of few groups is listed whole
        digits = 64 if sum(found[k][2] for k in unsure) <= OUTLINE or max(found[k][2] for k in unsure) <= SMALL else digits + 1
        inside = None
        for lo, hi in _joined(found, unsure):
            part = F.col("digest").between(lo, hi)
            inside = part if inside is None else inside | part
        finer = _ranges(groups.where(inside), digits)
        gone = set(unsure)
        found = sorted([r for k, r in enumerate(found) if k not in gone] + finer)


def _joined(found: list[tuple], chosen: list[int]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for k in chosen:
        if out and k - 1 in chosen and out[-1][1] == found[k - 1][1]:
            out[-1] = (out[-1][0], found[k][1])
        else:
            out.append((found[k][0], found[k][1]))
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, capacity for every row of ``docs``.

    Size is the bytes of the text (null: none) plus one; equal texts share a shard. Slots follow a hash of doc_id
    and text, then doc_id. With fewer groups than shards some shards stay empty; an empty table gives no rows.
    """
    text = text_of()
    rows = materialize(
        docs.select(
            "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        )
    )
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("size")))
    capacity, cuts = minimax_cuts(groups, shards)
    shard = sum(((F.col("digest") >= cut).cast("int") for cut in cuts), F.lit(0))
    buckets = pieces(rows.count(), BUCKET_ROWS * shards)
    dealt = rows.select(
        "doc_id", "size", "text_crc32", "digest", shard.cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)).alias("bucket"),
    )
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    place = Window.partitionBy("shard", "bucket").orderBy("doc_id", "digest")
    return dealt.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.row_number().over(place) - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.lit(capacity).cast("long").alias("capacity"),
    )
