"""Mixing sources to target weights along a curriculum, by built-in functions alone.

A source's weight is a piecewise-linear function of training time from 0 to 1. Its integral is the share the source
gets; capped targets scale it. A document starts at the time at which the source's cumulative demand of words
reaches the words that precede it in the source, the inverse of the integral. Documents sorted by that time are the
training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.llm.common import pieces, text_of, word_count
from roadweave.sources.tables import materialize

Schedule = Sequence[tuple[float, float]]
# Mean weights 5, 2 and 1 (steady, rising, falling), repeating over the sources in code-point order.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 5.0), (1.0, 5.0)),
    ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)),
    ((0.0, 2.0), (0.5, 1.0), (1.0, 0.0)),
)
MOST = 3
BUCKET_ROWS = 1 << 12


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def inverse(schedule: Schedule, share: Column) -> Column:
    """The time at which ``share`` (0 to 1) of the schedule's integral is reached."""
    whole, before, out = integral(schedule), 0.0, None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        area, slope = (t1 - t0) * (w0 + w1) / 2, (w1 - w0) / (t1 - t0)
        rest = share * F.lit(whole) - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        time = F.when(rest <= 0, F.lit(t0)).otherwise(F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + root))
        before += area
        inside = share * F.lit(whole) <= F.lit(before)
        out = F.when(inside, time) if out is None else out.when(inside, time)
    return out.otherwise(F.lit(float(schedule[-1][0])))


def targets(sizes: DataFrame, schedules: Sequence[Schedule], most: int) -> DataFrame:
    """source, source_size, kind, target: shares by mean weight, none above ``most`` times its size.

    Sources fill up in order of cap over weight; what the full ones leave is shared by weight among the rest, so one
    pass gives what resharing until nothing is above gives. One row per source goes through this.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    means = F.array(*(F.lit(float(integral(s))) for s in schedules))
    named = per.withColumn("kind", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(schedules))
    weighed = named.withColumn("weight", F.element_at(means, F.col("kind") + 1)).withColumn(
        "full_at", F.lit(most) * F.col("source_size") / F.col("weight")
    )
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    every, earlier = Window.partitionBy(F.lit(0)), order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    left = F.sum("source_size").over(every) - F.lit(most) * F.coalesce(F.sum("source_size").over(earlier), none)
    shared = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), none)
    level = weighed.withColumn("level", left / shared)
    is_full = F.col("full_at") <= F.col("level")
    # the level of the first source that stays below its cap holds for all after it
    final = F.min(F.when(~is_full, F.struct("full_at", "level"))).over(every)["level"]
    return level.withColumn("final", final).select(
        "source", "source_size", "kind",
        F.when(is_full, (F.lit(most) * F.col("source_size")).cast("double")).otherwise(F.col("final") * F.col("weight")).alias("target"),
    )


def mixed(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, most: int = MOST, whole: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, position, from the words of every text.

    A source's documents are taken in the order of a digest of their doc_id, over and over, until the target, rounded
    to words, is reached; the last document is cut there. With ``whole`` it is taken in full if at least half of it
    was due and not at all otherwise. ``copies`` counts passes begun, ``position`` is the first one's time (null if
    not taken). Null text has no words; documents without words take none but keep a position; null is a source of
    its own; rows with one doc_id follow each other by size, and with ``whole`` by ``digest``, which is then returned too.
    """
    own = [F.unhex(F.md5(text_of())).alias("digest")] if whole else []
    rows = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(text_of()).alias("size"), *own))
    goal = targets(rows, schedules, most)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    buckets = min(pieces(rows.count(), BUCKET_ROWS), 1 << 24)
    dealt = rows.withColumn("key", key).withColumn(
        "bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32))
    )
    # running sums in two steps: over the buckets of a source, then within one bucket
    sums = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
        F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0)).alias("start"),
    ).join(goal.withColumnRenamed("source", "g_source"), F.col("b_source").eqNullSafe(F.col("g_source")))
    here = F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *(["digest"] if whole else [])).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.join(starts, here).withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    words = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(words / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    due = words - passes * F.col("source_size") - F.col("before")
    cut = F.greatest(F.lit(0), F.least("size", due))
    last = F.when(cut * 2 >= F.col("size"), F.col("size")).otherwise(0) if whole else cut
    taken = (passes * F.col("size") + last).cast("long")
    share = F.when(F.col("target") > 0, F.least(F.lit(1.0), F.col("before") / F.col("target"))).otherwise(0.0)
    time = None
    for kind, schedule in enumerate(schedules):
        at = inverse(schedule, share)
        time = F.when(F.col("kind") == kind, at) if time is None else time.when(F.col("kind") == kind, at)
    empty = F.col("size") == 0
    copies = F.when(empty, F.lit(1)).otherwise(passes + (last > 0).cast("long")).cast("int")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), copies.alias("copies"),
        F.when(copies > 0, time).alias("position"), "before", "kind", *(["digest"] if whole else []),
    )


def training_order(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, most: int = MOST) -> DataFrame:
    """``docs`` as the mix takes them, columns as given: each pass over a document is a row, sorted by position.

    Whole documents only. Null texts count as empty; documents without words are taken once. Rows that agree in doc_id
    (null included), source and text each follow the smallest number of passes any of them gets; rows that differ in
    one of these are documents of their own. An empty table gives none.
    """
    plan = mixed(docs, schedules, most, whole=True).groupBy("doc_id", "source", "digest").agg(
        F.min("copies").alias("copies"), F.min("before").alias("before"),
        *(F.first(c).alias(c) for c in ("source_size", "target", "kind")),  # alike in all rows of a source
    )
    begun = plan.where("copies > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    share = F.least(F.lit(1.0), (F.col("before") + F.col("pass") * F.col("source_size")) / F.greatest("target", F.lit(1e-300)))
    time = None
    for kind, schedule in enumerate(schedules):
        at = inverse(schedule, share)
        time = F.when(F.col("kind") == kind, at) if time is None else time.when(F.col("kind") == kind, at)
    named = [F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("digest").alias("_mix_digest")]
    due = begun.select(*named, time.alias("_mix_position"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_mix_id")) & F.col("source").eqNullSafe(F.col("_mix_source"))
        & (F.col("_mix_text") == F.col("_mix_digest"))
    )
    marked = docs.withColumn("_mix_text", F.unhex(F.md5(text_of())))
    return marked.join(due, same).orderBy("_mix_position", "doc_id", "_mix_text").select(*(F.col(f"`{c}`") for c in docs.columns))
