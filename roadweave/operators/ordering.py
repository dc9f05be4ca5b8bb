"""Order-dependent operators that don't gather a whole key, or the whole table, in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key.

    Spark keeps one row per key and task before the shuffle (``WindowGroupLimit``). ``order`` should end
    in a tie-breaker.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") == 1).drop("__rn")


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order (O4); without an order a preview differs from run to run."""
    if not order_by:
        raise ValueError("order_by is required: an unordered preview is not reproducible")
    return df.orderBy(*order_by).limit(n)


def _written(df: DataFrame) -> DataFrame:
    from roadweave.sources.tables import materialize  # which checks keys by operators of this package

    return materialize(df)


def next_value(
    df: DataFrame, key: str, order: str, value: str, bucket: Column | None = None, into: str = "next_value",
    changes: bool = False,
) -> DataFrame:
    """The next row's ``value`` within ``key``, ordered by ``order`` and then ``value``, nulls last.

    Rows are dealt to ranges of (key, order, value) whose splitters Spark samples from those columns, so a key that
    holds a third of all rows, however close together, is spread over as many tasks as it needs. What the last row of a
    range still lacks is the first row of the next one: a second window, over the first and last row of each range,
    hands it over. The ranges are written to the shared folder before they are read twice, as sampling anew may draw
    other splitters. Equal rows can't be dealt apart: make rows distinct first, as ``county_crossings`` does.

    ``changes`` keeps the rows whose next value is another one, neither being null, and writes little more than those.

    ``bucket``, a non-decreasing function of ``order`` (a prefix of a text, a floor of a number), takes the place of the
    ranges where the caller knows that its groups within a key are small; then nothing is sampled or written.
    """
    by_order = [F.col(order).asc_nulls_last(), F.col(value).asc_nulls_last()]
    if bucket is None:
        ranges = [F.col(key).asc_nulls_first(), *by_order]
        parts, group = df.repartitionByRange(*ranges).withColumn("__bucket", F.spark_partition_id()), ["__bucket"]
        by_order = ranges
    else:
        parts, group = df.withColumn("__bucket", bucket), [key, "__bucket"]
    within = Window.partitionBy(*group).orderBy(*by_order)
    # Wrapped in a struct, the absence of a next row differs from a next row whose value is null.
    following = F.struct(F.col(key).alias("key"), F.col(value).alias("value"))
    rows = parts.withColumn("__next", F.lead(following).over(within)).withColumn("__rn", F.row_number().over(within))
    last, first = F.col("__next").isNull(), F.col("__rn") == 1
    of_key = lambda after: F.when(after["key"].eqNullSafe(F.col(key)), after["value"])
    changed = F.col(value) != of_key(F.col("__next"))
    if bucket is None:
        rows = _written(rows.where(last | first | changed) if changes else rows)
    across = Window.partitionBy(*(group[:-1] or [F.lit(1)])).orderBy(F.col("__bucket").asc_nulls_last(), "__rn")
    handed = (
        rows.where(last | first)
        .withColumn("__handed", F.lead(following).over(across))
        .where(last)
        .select(*df.columns, of_key(F.col("__handed")).alias(into))
    )
    found = rows.where(~last).select(*df.columns, of_key(F.col("__next")).alias(into)).union(handed)
    return found.where(F.col(value) != F.col(into)) if changes else found


def place_of_groups(df: DataFrame, order: Sequence[Column], into: str = "place", count: str = "n") -> DataFrame:
    """Distinct rows in a stated order: each with its number of repeats and the place, from 1, of the first of them (O1, O2).

    Rows are counted, sorted by ranges whose splitters Spark samples, and written; the rows of each range are numbered on
    their own and the sizes of the ranges before are added, one number a range. So no window sees more than a range.
    Rows that ``order`` leaves equal are ordered by all columns, ascending, nulls last.
    """
    names = df.columns
    by_all = [*order, *(F.col(c).asc_nulls_last() for c in names)]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias(count))
    sorted_ = counted.repartitionByRange(*by_all).sortWithinPartitions(*by_all)
    # The id of a row has its partition in the bits from 33 up, and its place there below.
    rows = _written(sorted_.withColumn("__id", F.monotonically_increasing_id())).withColumn("__range", F.shiftright("__id", 33))
    sizes = rows.groupBy("__range").agg(F.sum(count).alias("size"))
    upto = Window.partitionBy(F.lit(1)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range.
    before = sizes.select("__range", F.coalesce(F.sum("size").over(upto), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__range").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    through = F.sum(count).over(within)
    numbered_ = rows.withColumn("__through", through).join(F.broadcast(before), "__range")
    return numbered_.select(*names, count, (F.col("__before") + F.col("__through") - F.col(count) + 1).alias(into))


REPEATS = 4096  # of one row that are written out together


def numbered(df: DataFrame, order: Sequence[Column], into: str = "place") -> DataFrame:
    """Every row with its place, from 1, in a stated order (O1, O2); equal rows have consecutive places.

    See ``place_of_groups``: a row that stands a million times is sorted once and written out again here, in pieces.
    """
    groups = place_of_groups(df, order, "__place", "__n")
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / F.lit(REPEATS)).cast("int"))).alias("__piece")
    split = groups.select(*df.columns, "__n", "__place", pieces)
    first = F.col("__piece").cast("bigint") * REPEATS
    upto = F.least(first + REPEATS, F.col("__n")) - 1
    return split.select(*df.columns, F.explode(F.sequence(F.col("__place") + first, F.col("__place") + upto)).alias(into))


LONGEST_CODES = 16 << 20  # bytes of distinct values that are broadcast


class ValueCodes(NamedTuple):
    """Distinct values by rank: ``codes`` has each value with its code, from 1, in the order of values."""

    codes: DataFrame
    ordered: Column

    def values(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``df`` with the values of the codes in ``columns``; null stays null."""
        held = df.withColumn("__ordered", self.ordered)
        value = lambda c: F.element_at("__ordered", F.col(c)).alias(c)
        return held.select(*(value(c) if c in columns else F.col(c) for c in df.columns))


def value_codes(df: DataFrame, col: str, most: int) -> ValueCodes | None:
    """Order-keeping codes of a column's distinct values, for minima and maxima by hash aggregates of numbers.

    None where there are more than ``most`` distinct values or more than ``LONGEST_CODES`` bytes of them, so that what is
    broadcast has a bound. Runs at once: the distinct values are written, and two numbers come to the driver. Null has no
    code; a table without values has no codes.
    """
    values = _written(df.select(F.col(col).alias(col)).where(F.col(col).isNotNull()).distinct())
    n, size = values.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(col).cast("string")).cast("bigint")), F.lit(0))).first()
    if n > most or size > LONGEST_CODES:
        return None
    listed = values.agg(F.array_sort(F.collect_set(col)).alias("ordered"))
    codes = listed.select(F.posexplode("ordered").alias("code", col)).select(col, (F.col("code") + 1).alias("code"))
    return ValueCodes(codes, listed.scalar())


def running_count_at_key(
    df: DataFrame, within: str, key: str, into: str, totals: Sequence[str] = ()
) -> DataFrame:
    """Per ``key``: the largest running row count through that key in any ``within`` group.

    Equal to numbering the rows of each group by key and taking the largest number per key, but the rows are
    counted first; only distinct (group, key) pairs are ordered. The row count per key, and sums of the
    columns in ``totals``, come out of the same pass.
    """
    pairs = df.groupBy(within, key).agg(F.count(F.lit(1)).alias("rows"), *(F.sum(c).alias(c) for c in totals))
    through = Window.partitionBy(within).orderBy(F.col(key).asc_nulls_first())
    running = pairs.withColumn(into, F.sum("rows").over(through.rowsBetween(Window.unboundedPreceding, 0)))
    return running.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max(into).alias(into), F.sum("rows").alias("rows"), *(F.sum(c).alias(c) for c in totals)
    )


# Bits of a value's place after the binary point of its logarithm.
_PLACE_BITS = 40
_PAST = 1 << 52  # the place of infinity; NaN comes after it, and null before everything
# Bits below the cells of the counting passes: cells are a thousandth of a doubling wide, then 2**-30 and 2**-40 of one.
_SHIFTS = (30, 10, 0)
# Rows that one task may order, about.
_CROWD = 1 << 20


def _place(col: Column) -> Column:
    """A whole number, non-decreasing in ``col``: the logarithm of the magnitude in units of 2**-40, mirrored for
    negatives. Neighbours within 10**-12 of their size may share one; infinities and NaN have their own."""
    magnitude = F.abs(col)
    log = F.log2(F.when((magnitude > 0) & (magnitude < F.lit(float("inf"))), magnitude).otherwise(F.lit(1.0)))
    place = F.floor((log + F.lit(1100.0)) * F.lit(float(1 << _PLACE_BITS))) + F.lit(1)
    past = F.lit(_PAST).cast("bigint")
    place = F.when(magnitude == F.lit(float("inf")), past).otherwise(place)
    placed = F.when(col == 0, F.lit(0).cast("bigint")).when(F.isnan(col), past + 1).when(col < 0, -place).otherwise(place)
    return F.when(col.isNull(), -past - 1).otherwise(placed)


class _Cell(NamedTuple):
    """Where a wanted row lies: in the places that begin with the bits ``cell``, of which ``rows`` follow ``below`` others."""

    fraction: float
    row: int
    cell: int
    shift: int
    below: int
    rows: int

    def holds(self) -> Column:
        return F.shiftright("place", self.shift) == self.cell


def _first_cells(placed: DataFrame, fractions: Sequence[float]) -> list[_Cell]:
    """One pass that counts the rows of each cell: a summary of ranks that merges by addition."""
    shift, every = _SHIFTS[0], Window.partitionBy(F.lit(1))
    counts = placed.groupBy(F.shiftright("place", shift).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    upto = every.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("through", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(every))
    asked = F.array(*(F.struct(F.lit(q).alias("q"), F.floor(F.col("total") * F.lit(q)).alias("row")) for q in map(float, fractions)))
    holds = lambda w: (F.col("through") - F.col("n") < w["row"]) & (w["row"] <= F.col("through"))
    found = running.select("cell", "n", "through", F.explode(F.filter(asked, holds)).alias("w")).collect()
    return [_Cell(r.w.q, r.w.row, r.cell, shift, r.through - r.n, r.n) for r in found]


def _counted(placed: DataFrame, cells: Sequence[_Cell], by: Column, name: str) -> DataFrame:
    """One pass over the rows in some cells: which of ``cells``, each value of ``by``, its rows, and the rows through it."""
    distinct = list({(c.cell, c.shift): c for c in cells}.values())
    place = F.coalesce(*(F.when(c.holds(), F.lit(i)) for i, c in enumerate(distinct)))
    below = F.coalesce(*(F.when(F.col("within") == i, F.lit(c.below)) for i, c in enumerate(distinct)))
    inside = placed.where(reduce(or_, (c.holds() for c in distinct)))
    counts = inside.groupBy(place.alias("within"), by.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("within").orderBy(F.col(name).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumn("through", below + F.sum("n").over(upto))
    asked = F.array(*(
        F.struct(F.lit(c.fraction).alias("q"), F.lit(c.row).cast("bigint").alias("row"), F.lit([(d.cell, d.shift) for d in distinct].index((c.cell, c.shift))).alias("at"))
        for c in cells
    ))
    holds = lambda w: (w["at"] == F.col("within")) & (F.col("through") - F.col("n") < w["row"]) & (w["row"] <= F.col("through"))
    return running.select(name, "n", "through", F.explode(F.filter(asked, holds)).alias("w"))


def rank_quantiles(df: DataFrame, col: str, fractions: Sequence[float]) -> DataFrame:
    """Values at rows ``trunc(n * fraction)`` of the table ordered by ``col``, one row per fraction found.

    Nulls sort first and count as rows. A fraction whose row number is 0 finds none. The result is exact and of
    the column's type:

    1. one pass, run at once, counts rows per cell of close values, a histogram that merges by addition, and brings to the
       driver the cell of each wanted row and how many rows come before it. Only where a cell has over a million rows
       another pass divides those cells;
    2. one more pass counts the rows of each value inside the cells. A running count over those finds the wanted values.

    So neither the rows nor the distinct values are ever sorted as a whole, and a repeated value is one counted row.
    The last cells are 10**-12 of a value wide: some thousand doubles at most, whatever the table. Longs beyond 2**53 and
    decimals of many digits are ordered exactly inside a cell, but not divided further.
    """
    value = df.select(F.col(col).alias("value"))
    placed = value.select("value", _place(F.col("value").cast("double")).alias("place"))
    cells = _first_cells(placed, fractions)
    for shift in _SHIFTS[1:]:
        crowded = [c for c in cells if c.rows > _CROWD]
        if crowded:
            found = _counted(placed, crowded, F.shiftright("place", shift), "cell").collect()
            cells = [c for c in cells if c.rows <= _CROWD]
            cells += [_Cell(r.w.q, r.w.row, r.cell, shift, r.through - r.n, r.n) for r in found]
    if not cells:
        return value.limit(0).select(F.lit(0.0).alias("fraction"), F.col("value").alias(col))
    return _counted(placed, cells, F.col("value"), "found").select(F.col("w.q").alias("fraction"), F.col("found").alias(col))


def upper_fence_filter(
    df: DataFrame, col: str, low: float = 0.25, high: float = 0.75, width: float = 1.5
) -> DataFrame:
    """Rows strictly below ``q3 + width * (q3 - q1)``, quartiles by row number.

    With too few rows for a lower quartile both quartiles are the upper one; with a single row none is found
    and the result is empty.
    """
    quartiles = rank_quantiles(df, col, (low, high))
    spread = F.max(col) - F.min(col)
    fence = quartiles.agg((F.max(col) + F.lit(width) * spread).alias("fence"))
    return df.where(F.col(col) < fence.scalar())
