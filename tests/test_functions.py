from __future__ import annotations

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from roadweave.functions import (
    blank_as_null,
    concat_present,
    corridor_number,
    divide,
    exact_sum,
    from_limbs,
    km_to_mi,
    length_ratio_pct,
    limbs,
    milepost_to_double,
    milepost_to_number,
    per_capita,
    reference_point,
    reference_point_to_number,
    round_half_up,
)
from roadweave.functions.measures import guarded, quick_guarded, quick_half_up


def one(frame, schema, row, column):
    return frame(schema, [row]).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "mile"),
    [("12+0.345", "12.345"), ("12-0.5", "11.5"), ("+0.3", "0.3"), ("7", "7"), (None, "0"), ("", "0"), ("105+1.25", "106.25")],
)
def test_milepost_text(frame, text, mile):
    assert one(frame, "t string", (text,), milepost_to_number(F.col("t"))) == Decimal(mile)


@pytest.mark.parametrize(
    ("a", "b", "joined"), [("C1", "N", "C1N"), ("C1", None, "C1"), (None, "N", "N"), (None, None, None)]
)
def test_concat_treats_null_as_empty(frame, a, b, joined):
    assert one(frame, "a string, b string", (a, b), concat_present("a", "b")) == joined


@pytest.mark.parametrize(
    ("marker", "offset", "text"),
    [(12, 0.523, " 012+0.523"), (12, 1.25, " 012+1.250"), (1, 0.0, " 001+0.000"), (123, 0.1235, " 123+0.124"), (None, 0.5, "+0.500")],
)
def test_reference_point_text(frame, marker, offset, text):
    assert one(frame, "m int, o double", (marker, offset), reference_point(F.col("m"), F.col("o"))) == text


@pytest.mark.parametrize(
    ("text", "by_position", "exact"), [(" 012+0.523", 12.523, 12.523), (" 012+1.250", 12.25, 13.25), (None, None, None)]
)
def test_reference_point_number(frame, text, by_position, exact):
    assert one(frame, "t string", (text,), reference_point_to_number(F.col("t"))) == by_position
    assert one(frame, "t string", (text,), reference_point_to_number(F.col("t"), exact=True)) == exact


def test_reference_point_round_trip(frame):
    df = frame("m int, o double", [(m, o / 1000) for m in (1, 45, 999) for o in (0, 1, 500, 999)])
    back = reference_point_to_number(reference_point(F.col("m"), F.col("o")))
    assert all(r.back == pytest.approx(r.m + r.o) for r in df.withColumn("back", back).collect())


@pytest.mark.parametrize(("km", "mile"), [(7.0, 4.35), (13.0, 8.078), (None, None), (0.0, 0.0)])
def test_km_to_mi(frame, km, mile):
    assert one(frame, "k double", (km,), km_to_mi(F.col("k"))) == mile


@pytest.mark.parametrize(
    ("value", "digits", "rounded"), [(1.005, 2, 1.01), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.1 + 0.2, 3, 0.3), (None, 2, None)]
)
def test_round_half_up(frame, value, digits, rounded):
    assert one(frame, "v double", (value,), round_half_up(F.col("v"), digits)) == rounded


def test_rates(frame):
    assert one(frame, "c bigint, p bigint", (5, 3000), per_capita(F.col("c"), F.col("p"), 100_000)) == 166.67
    assert one(frame, "c bigint, p bigint", (1, 8), per_capita(F.col("c"), F.col("p"))) == 12.5


def test_length_ratio_rounds_before_scaling(frame):
    assert one(frame, "f double, m double", (528.0, 10.0), length_ratio_pct(F.col("f"), F.col("m"))) == 1.0


def test_division_by_zero(frame):
    df = frame("a int, b int", [(1, 0)])
    assert df.select(divide(F.col("a"), F.col("b"), "null").alias("v")).first().v is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(divide(F.col("a"), F.col("b"))).collect()
    with pytest.raises(ValueError):
        divide(F.col("a"), F.col("b"), "ignore")


def test_corridor_number(frame):
    assert one(frame, "c string", ("C000015N",), corridor_number(F.col("c"))) == 15
    assert one(frame, "c string", ("C000600N",), corridor_number(F.col("c"))) == 600
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(frame, "c string", ("CxxxxxxN",), corridor_number(F.col("c")))


@pytest.mark.parametrize(("text", "kept"), [(" ", None), ("", None), (None, None), ("  ", "  "), ("7", "7")])
def test_blank_as_null(frame, text, kept):
    assert one(frame, "t string", (text,), blank_as_null(F.col("t"))) == kept


def test_mileposts_are_exact_until_the_end(frame):
    df = frame("p string", [("12-0.3455",), ("1+0.0001",), ("1+0.0004",), ("12",), ("+0.5",), (None,)])
    got = [(float(r.a), float(r.b)) for r in df.select(milepost_to_number(F.col("p")).alias("a"), milepost_to_number(F.col("p"), None).alias("b")).collect()]
    assert got == [(11.655, 11.6545), (1.0, 1.0001), (1.0, 1.0004), (12.0, 12.0), (0.5, 0.5), (0.0, 0.0)]


POSTS = ["12+0.345", "12-0.5", "+0.3", "7", None, "", "105+1.25", "0-0.0005", "0-0.0004", "1-2.0005", "12345678+0.999999999", "123456789+0.5",
         "3+0.1234567895", "3+00000001.5", "3+5", "x12+0.5", "12+0.5.", " 12+0.5", "1+0.0005", "7-7.0", "3+.5"]


def test_mileposts_as_doubles_are_those_of_decimals(frame):
    """Through the long and around it."""
    df = frame("p string", [(p,) for p in POSTS if p != "12+0.5."])
    got = df.select(*(f(F.col("p"), d).cast("double") for d in (0, 3, 9) for f in (milepost_to_double, milepost_to_number))).collect()
    assert all(r[i] == r[i + 1] for r in got for i in (0, 2, 4))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame("p string", [("12+0.5.5",)]).select(milepost_to_double(F.col("p"))).collect()


def test_exact_sums(spark):
    rng = random.Random(1)
    data = [rng.choice([rng.uniform(-1e6, 1e6), rng.gauss(0, 1), 0.1, -0.3, 1e-12, None, float("nan"), float("inf")]) for _ in range(4000)]
    exact = sum(Fraction(x) for x in data if x is not None and math.isfinite(x))
    df = spark.createDataFrame([(x, i % 3) for i, x in enumerate(data)], "x double, k int")
    for digits in (3, 9, 12):
        sums = {df.repartition(n).agg(exact_sum(F.col("x"), digits).alias("s")).first().s for n in (1, 7, 64)}
        assert sums == {float(Fraction(round(exact * 10**digits), 10**digits))}
    parts = df.repartition(7, "k").groupBy("k").agg(*(F.sum(v).alias(f"l{i}") for i, v in enumerate(limbs(F.col("x")))))
    assert parts.agg(from_limbs([F.sum(f"l{i}") for i in range(4)], 12).alias("s")).first().s == float(Fraction(round(exact * 10**12), 10**12))


@pytest.mark.parametrize(
    ("data", "digits", "total"),
    [([], 9, None), ([None], 9, None), ([float("nan")], 9, None), ([-0.5, -0.25], 1, -0.8), ([0.5, 0.25], 1, 0.8), ([0.1] * 10, 9, 1.0),
     ([1e-12] * 1000, 12, 1e-9), ([1e15, 0.1, -1e15], 9, 0.1), ([0.1, 0.2], 9, 0.3), ([-1e-300], 9, 0.0), ([2.0**62, -(2.0**62), 3.5], 9, 3.5)],
)
def test_exact_sum_cases(frame, data, digits, total):
    assert frame("x double", [(x,) for x in data]).agg(exact_sum(F.col("x"), digits).alias("s")).first().s == total


def test_sums_beyond_a_long_raise(frame):
    with pytest.raises(Exception, match="OVERFLOW"):
        frame("x double", [(2.0**62,), (2.0**62,)]).agg(exact_sum(F.col("x"))).collect()


def test_reference_points_beyond_ten_miles(frame):
    df = frame("m int, o double", [(5, 0.5), (5, 12.5), (7, 100.25), (1234, 3.125)])
    text = reference_point(F.col("m"), F.col("o"))
    shown = df.select(text.alias("t"), reference_point_to_number(text).alias("read"), reference_point_to_number(text, exact=True).alias("exact"))
    assert [tuple(r) for r in shown.collect()] == [
        (" 005+0.500", 5.5, 5.5), (" 005+12.500", 5.5, 17.5), (" 007+100.250", 7.25, 107.25), (" 1234+3.125", 1234.125, 1237.125),
    ]


@pytest.mark.parametrize("digits", [0, 3, 4])
def test_quick_rounding_is_the_plain_one(frame, digits):
    """Ties, their neighbours, noise, negative zero, large values and nulls among them."""
    rng = random.Random(7)
    ties = [(k + 0.5) / 10**digits for k in (0, 1, 2, 5, 1004, 99999, 5 * 10**8, 10**11)]
    values = [*ties, *(math.nextafter(t, math.inf) for t in ties), *(math.nextafter(t, 0) for t in ties), *(t - 4e-7 / 10**digits for t in ties)]
    values += [rng.randrange(10**9) / 10**digits for _ in range(200)] + [rng.uniform(0, 10**rng.randrange(-6, 14)) for _ in range(300)]
    values += [k / 1000 + 1e-10 for k in range(50)] + [0.1 + 0.2, 1e17, 0.0]
    rows = [(float(v),) for v in values] + [(-float(v),) for v in values] + [(None,)]
    x = F.col("x")
    both = frame("x double", rows).select(
        "x", round_half_up(x, digits).alias("a"), quick_half_up(x, digits).alias("b"),
        guarded(x, digits).cast("double").alias("c"), quick_guarded(x, digits).alias("d"),
    ).collect()
    assert len(both) == len(rows)
    assert [r for r in both if repr((r.a, r.c)) != repr((r.b, r.d))] == []
