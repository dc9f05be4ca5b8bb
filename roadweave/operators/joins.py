"""Joins on measures, intervals and segment ends.

No side is ever broadcast by hint: Catalyst and AQE broadcast a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffle otherwise, and AQE splits hot partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions.measures import guarded


class RoundedKey(NamedTuple):
    """One measure to match: ``side`` says which of the two values is rounded before comparing."""

    left: str
    right: str
    digits: int
    side: str = "both"

    def columns(self) -> tuple[Column, Column]:
        def key(name: str, rounded: bool) -> Column:
            exact = guarded(F.col(name), self.digits)
            return F.round(exact, self.digits).cast(f"decimal(28,{self.digits + 6})") if rounded else exact

        return key(self.left, self.side in ("both", "left")), key(self.right, self.side in ("both", "right"))


def rounded_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[RoundedKey],
    equal: Sequence[tuple[str, str]] = (),
    how: str = "inner",
) -> DataFrame:
    """Equi-join on rounded measures.

    Keys are decimals, so two doubles that print alike match. Column names of the two sides must differ.
    """
    conditions = []
    for i, key in enumerate(on):
        lkey, rkey = key.columns()
        left, right = left.withColumn(f"__l{i}", lkey), right.withColumn(f"__r{i}", rkey)
        conditions.append(F.col(f"__l{i}") == F.col(f"__r{i}"))
    conditions += [F.col(lname) == F.col(rname) for lname, rname in equal]
    joined = left.join(right, reduce(and_, conditions), how)
    return joined.drop(*(f"__{s}{i}" for i in range(len(on)) for s in "lr"))


LEVEL_FACTOR = 8


class IntervalSides(NamedTuple):
    """Both sides of an interval join with their buckets, and the conditions that join them."""

    points: DataFrame
    intervals: DataFrame
    on: Column
    helpers: tuple[str, ...]


def interval_sides(
    points: DataFrame, intervals: DataFrame, key: tuple[str, str], at: str, lo: str, hi: str,
    bin: float | None = None, salt: int = 1,
) -> IntervalSides:
    """The sides of ``interval_join``. A point is repeated once per level of interval lengths that occurs."""
    on = [F.col(key[0]) == F.col(key[1]), F.col(at) >= F.col(lo), F.col(at) <= F.col(hi)]
    intervals = intervals.where(F.col(lo) <= F.col(hi))
    if bin is not None:
        size = lambda level: F.lit(float(bin)) * F.pow(F.lit(float(LEVEL_FACTOR)), F.col(level))
        bucket = lambda name, level: F.floor(F.col(name) / size(level))
        steps = F.log(float(LEVEL_FACTOR), F.greatest((F.col(hi) - F.col(lo)) / F.lit(float(bin)), F.lit(1.0)))
        intervals = intervals.withColumn("__level", F.ceil(steps).cast("int"))
        levels = intervals.agg(F.collect_set("__level").alias("levels")).scalar()
        points = points.select("*", F.posexplode_outer(levels).alias("__copy", "__at_level")).withColumn("__at_bin", bucket(at, "__at_level"))
        intervals = intervals.withColumn("__bin", F.explode(F.sequence(bucket(lo, "__level"), bucket(hi, "__level"))))
        on += [F.col("__at_bin") == F.col("__bin"), F.col("__at_level") == F.col("__level")]
    if salt > 1:
        points = points.withColumn("__at_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salt)).cast("int"))
        intervals = intervals.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        on.append(F.col("__at_salt") == F.col("__salt"))
    helpers = ("__copy", "__at_bin", "__at_level", "__bin", "__level", "__at_salt", "__salt")
    return IntervalSides(points, intervals, reduce(and_, on), helpers)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: tuple[str, str],
    at: str,
    lo: str,
    hi: str,
    bin: float | None = None,
    how: str = "inner",
    salt: int = 1,
) -> DataFrame:
    """Join each point to the intervals of its key that contain it, both ends included.

    ``bin`` adds a bucket of the measure to the equi-key, so that one route spreads over as many tasks as it has
    buckets, and a point only meets intervals near it. Buckets come in levels, each ``LEVEL_FACTOR`` times as wide
    as the one before; an interval goes to the first level whose buckets are as long as it is, or to the next
    longer one, and so touches two buckets at most there, whatever its length. A point has one bucket in each
    level that occurs among the intervals, which is one or two as a rule. Choose ``bin`` about as long as a typical
    interval. ``salt`` splits points further when a single bucket is hot: the intervals are repeated ``salt``
    times, each point takes one copy, chosen by its values so that a recomputed task chooses alike.

    ``how`` is ``'inner'`` or ``'left'``; the latter numbers the points and tells by a flag over all copies of a point
    which have no interval, in the same join. Column names of the two sides must differ.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if how == "inner":
        sides = interval_sides(points, intervals, key, at, lo, hi, bin, salt)
        return sides.points.join(sides.intervals, sides.on).drop(*sides.helpers)
    named = points.withColumn("__point", F.monotonically_increasing_id())
    sides = interval_sides(named, intervals, key, at, lo, hi, bin, salt)
    pairs = sides.points.join(sides.intervals, sides.on, "left")
    if bin is not None:  # a point has a copy for each level of intervals; of those without any, the first one stays
        met = F.col(lo).isNotNull()
        ever = F.max(met).over(Window.partitionBy("__point"))
        first = F.coalesce("__copy", F.lit(0)) == 0
        pairs = pairs.withColumn("__met", met).withColumn("__ever", ever).where(F.col("__met") | (~F.col("__ever") & first))
    return pairs.drop(*sides.helpers, "__point", "__met", "__ever")


class MatchClasses(NamedTuple):
    """A match by equal keys that is not written out: ``classes`` has a row for each key that all ``sides`` have, with the
    rows of each side and of the match."""

    classes: DataFrame
    sides: dict[str, DataFrame]

    def members(self, name: str) -> DataFrame:
        """The rows of a side that have partners, with the key columns that side knows."""
        side = self.sides[name]
        known = [c for c in side.columns if c in self.classes.columns]
        return side.join(self.classes, known, "left_semi")

    def expanded(self, chosen: Column | None = None, without: str | None = None) -> DataFrame:
        """The rows of the match, of all classes or of those that a condition on ``classes`` chooses.

        ``without`` names a key column to leave out, of the first side and perhaps others. Rows that differ in nothing else are
        then one, if no side has repeats. Only rows of the first side that differ in that column alone can give such rows:
        they are matched apart, and nothing else of the match is compared.
        """
        keys = [c for c in self.classes.columns if any(c in side.columns for side in self.sides.values())]
        rows = None if chosen is None else self.classes.where(chosen).select(*keys)
        first, *rest = self.sides.values()

        def product(side: DataFrame) -> DataFrame:
            found = rows
            for other in (side, *rest):
                found = other if found is None else found.join(other, [c for c in other.columns if c in keys])
            return found

        if without is None:
            return product(first)
        alike = [c for c in first.columns if c != without]
        ends = first.groupBy(*alike).agg(F.min(without).alias("__least"), F.max(without).alias("__most"))
        one = ends.where("__least = __most").select(*alike, F.col("__least").alias(without))
        several = ends.where("__least < __most").select(*(F.col(c).alias(f"__{c}") for c in alike))
        more = first.join(several, reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in alike)), "left_semi")
        return product(one).drop(without).unionByName(product(more).drop(without).distinct())


def match_classes(sides: Mapping[str, DataFrame], key: Sequence[str]) -> MatchClasses:
    """Rows of several sides that agree in their keys, by classes of equal keys.

    ``sides`` maps a name to a frame with some of the ``key`` columns, the first side with all of them; other columns must
    differ between sides. Equal keys cost the sum of their rows here and not the product: each side is counted on its own, and
    only counts are joined. ``rows`` is null where the product is beyond a long. Null keys match nothing. Members are the
    given rows, repeats included; ``expanded`` multiplies them, for whoever needs that.
    """
    classes: DataFrame | None = None
    product = F.lit(1).cast("bigint")
    for name, side in sides.items():
        own = [c for c in key if c in side.columns]
        counts = side.groupBy(*own).agg(F.count(F.lit(1)).alias(f"{name}_rows"))
        classes = counts.dropna(subset=own) if classes is None else classes.join(counts, own)
        product = F.try_multiply(product, F.col(f"{name}_rows"))
    return MatchClasses(classes.select(*key, *(f"{n}_rows" for n in sides), product.alias("rows")), dict(sides))


def lookup_ends(
    segments: DataFrame,
    nodes: DataFrame,
    key: str,
    node: str,
    ends: dict[str, dict[str, str]],
) -> DataFrame:
    """Left-join the same lookup once per segment end.

    ``ends`` maps a node column of ``segments`` to the lookup columns wanted for it and their new names,
    e.g. ``{"beg_gn": {"tis_mi": "tis_begmi"}}``.
    """
    for end, wanted in ends.items():
        side = nodes.select(
            F.col(key).alias("__key"), F.col(node).alias("__node"),
            *(F.col(source).alias(target) for source, target in wanted.items()),
        )
        segments = segments.join(
            side, (F.col(key) == F.col("__key")) & (F.col(end) == F.col("__node")), "left"
        ).drop("__key", "__node")
    return segments


def not_in_present(
    df: DataFrame, col: str, codes: Sequence[str], source: DataFrame | None = None, check: bool = False
) -> DataFrame:
    """Rows whose code is not among those of ``codes`` that occur in ``source``.

    This is ``NOT IN (subquery)``: a null code is dropped, except when none of the codes occurs at all, for
    then the list is empty and every row stays. That some code occurs is taken for granted, and the list is a
    plain filter, pushed to the scan. ``check`` looks: one uncorrelated EXISTS over ``source``, which costs
    another scan and keeps the filter from being pushed.
    """
    outside = ~F.col(col).isin(*codes)
    if not check:
        return df.where(outside)
    occurs = (df if source is None else source).where(F.col(col).isin(*codes)).select(col).exists()
    return df.where(outside | ~occurs)
