from __future__ import annotations

import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadweave import operators as ops
from roadweave.operators import ordering
from roadweave.sources.schemas import layout

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.one_of(st.none(), st.integers(0, 3))


# --- uniqueness and conflicts ---------------------------------------------------------------------------------


def test_keep_unique_case(frame):
    df = frame("id int, dc string, mi double", [(1, "A", 1.0), (1, "B", 2.0), (1, "B", 3.0), (None, "C", 4.0)])
    assert rows(ops.keep_unique(df, ["id", "dc"])) == [(1, "A", 1.0)]


@few
@given(st.lists(st.tuples(small, small, small), max_size=25))
def test_unambiguous_equals_self_join_form(frame, data):
    df = frame("a int, b int, v int", data)
    by_aggregate = rows(ops.keep_unambiguous(df, ["a", "b"]))
    left = df.distinct()
    right = left.select(F.col("a").alias("x"), F.col("b").alias("y"))
    joined = left.join(right, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")))
    by_self_join = joined.groupBy("a", "b", "v").count().where("count = 1").drop("count")
    assert by_aggregate == rows(by_self_join) == rows(ops.keep_unique(left, ["a", "b"]))


@few
@given(st.lists(st.tuples(small, small, small), max_size=25))
def test_conflicts_equal_self_join_form(frame, data):
    df = frame("id int, p int, q int", data)
    other = df.toDF("i", "p2", "q2")
    by_join = df.join(other, F.expr("id = i and (p <> p2 or q <> q2)")).select("id").distinct()
    assert rows(ops.conflicting_keys(df, "id", ["p", "q"])) == rows(by_join)


def test_conflict_case(frame):
    df = frame(
        "id string, assay string, ph string",
        [("s1", None, "7"), ("s1", None, "8"), ("s2", None, "7"), ("s2", None, None), ("s3", "1", "7"), ("s3", "2", "7")],
    )
    assert rows(ops.conflicting_keys(df, "id", ["ph"])) == [("s1",)]


def test_key_violations(frame):
    df = frame("a int, b int", [(1, 1), (1, 1), (2, None), (3, 1), (None, None), (None, None)])
    assert rows(ops.key_violations(df, ["a", "b"])) == [(1, 1, 2), (2, None, 1), (None, None, 2)]
    assert rows(ops.key_violations(df, ["a", "b"], allow_null=True)) == [(1, 1, 2), (None, None, 2)]
    ops.assert_key(df.where("a = 3"), ["a"])
    with pytest.raises(ValueError, match="violated"):
        ops.assert_key(df, ["a"])


def test_blank_to_null(frame):
    df = frame("a string, b string, c string", [(" ", "x", " ")])
    assert rows(ops.blank_to_null(df, ["a", "b"])) == [(None, "x", " ")]


# --- joins ------------------------------------------------------------------------------------------------------


def test_interval_ends_are_inclusive(frame):
    points = frame("r string, km double", [("A", 10.0), ("A", 20.5), ("B", 10.0), ("A", None)])
    spans = frame("s string, lo double, hi double", [("A", 0.0, 10.0), ("A", 10.0, 20.0), ("A", 5.0, 1.0), ("A", None, 9.0)])
    for bin in (None, 1.0, 10.0, 1000.0):
        got = ops.interval_join(points, spans, ("r", "s"), "km", "lo", "hi", bin=bin)
        assert rows(got) == [("A", 10.0, "A", 0.0, 10.0), ("A", 10.0, "A", 10.0, 20.0)]
        outer = ops.interval_join(points, spans, ("r", "s"), "km", "lo", "hi", bin=bin, how="left")
        assert outer.columns == ["r", "km", "s", "lo", "hi"]
        assert outer.count() == 5 and outer.where("s is null").count() == 3


@few
@given(st.integers(0, 10_000), st.sampled_from([0.5, 3.0, 40.0]), st.sampled_from([1, 3]))
def test_interval_join_is_the_same_for_all_bins_and_salts(frame, seed, bin, salt):
    rng = random.Random(seed)
    # One route holds most points, as a hot key would.
    points = frame("r int, km double", [(min(rng.randrange(6), 1), rng.randrange(-40, 40) / 4) for _ in range(60)])
    spans = frame("s int, lo double, hi double", [(rng.randrange(2), a, a + rng.randrange(9)) for a in [rng.uniform(-10, 10) for _ in range(20)]])
    plain = points.join(spans, F.expr("r = s and km between lo and hi"))
    assert rows(ops.interval_join(points, spans, ("r", "s"), "km", "lo", "hi", bin, salt=salt)) == rows(plain)


def test_left_interval_join_keeps_repeated_points(frame):
    points = frame("r string, km double", [("A", 1.0), ("A", 1.0), ("A", 99.0), ("A", 99.0), (None, 1.0), ("B", None)])
    spans = frame("s string, lo double, hi double", [("A", 0.0, 2.0), ("A", 0.0, 2.0), ("A", 0.5, 60.0), ("A", 1.0, 1.0)])
    for salt in (1, 3):
        got = ops.interval_join(points, spans, ("r", "s"), "km", "lo", "hi", bin=2.0, how="left", salt=salt)
        assert rows(got) == rows(points.join(spans, F.expr("r = s and km between lo and hi"), "left"))
        assert got.where("lo is not null").count() == 8 and got.where("lo is null").count() == 4
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip("+-: ").startswith("Join ") for line in text.splitlines()) == 1


def test_interval_join_rejects_other_joins(frame):
    df = frame("a int, b double", [(1, 1.0)])
    with pytest.raises(ValueError):
        ops.interval_join(df, df, ("a", "a"), "b", "b", "b", how="full")


def test_rounded_join(frame):
    left = frame("a double, len double", [(1.23449, 5.0), (1.2345, 5.0), (2.0, 5.0)])
    right = frame("b double, whole double", [(1.234, 5.3), (1.235, 4.6), (2.0, 9.0)])
    on = [ops.RoundedKey("a", "b", 3, "left"), ops.RoundedKey("len", "whole", 0, "right")]
    joined = ops.rounded_join(left, right, on)
    assert rows(joined.select("a", "b")) == [(1.2345, 1.235), (1.23449, 1.234)] or rows(joined.select("a", "b")) == [
        (1.23449, 1.234), (1.2345, 1.235)
    ]
    assert joined.columns == ["a", "len", "b", "whole"]


def test_rounded_join_compares_the_unrounded_side_as_it_is(frame):
    left, right = frame("a double", [(1.2341,)]), frame("b double", [(1.2342,)])
    assert ops.rounded_join(left, right, [ops.RoundedKey("a", "b", 3)]).count() == 1
    assert ops.rounded_join(left, right, [ops.RoundedKey("a", "b", 3, "left")]).count() == 0


def test_lookup_ends(frame):
    segs = frame("c string, b int, e int", [("A", 1, 2), ("A", 1, 9), ("B", 1, 2)])
    nodes = frame("c string, n int, mi double", [("A", 1, 0.5), ("A", 2, 1.5)])
    got = ops.lookup_ends(segs, nodes, "c", "n", {"b": {"mi": "bm"}, "e": {"mi": "em"}})
    assert rows(got) == [("A", 1, 2, 0.5, 1.5), ("A", 1, 9, 0.5, None), ("B", 1, 2, None, None)]


def test_not_in_drops_null_unless_no_code_occurs(frame):
    df = frame("id int, code string", [(1, "OFF"), (2, None), (3, "PRI")])
    assert rows(ops.not_in_present(df, "code", ["OFF", "OUT"])) == [(3, "PRI")]
    assert ops.not_in_present(df, "code", ["XXX"]).count() == 2
    assert ops.not_in_present(df, "code", ["XXX"], check=True).count() == 3
    assert rows(ops.not_in_present(df, "code", ["OFF", "OUT"], check=True)) == [(3, "PRI")]
    listed = frame("code string", [("PRI",)])
    assert rows(ops.not_in_present(df, "code", ["PRI", "OFF"], source=listed)) == []


@few
@given(st.lists(st.tuples(st.integers(0, 9), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))), max_size=12),
       st.lists(st.sampled_from(["a", "b", "x"]), min_size=1, unique=True))
def test_not_in_equals_sql(spark, frame, data, codes):
    df = frame("id int, code string", data)
    df.createOrReplaceTempView("coded")
    listed = ", ".join(f"'{c}'" for c in codes)
    literal = spark.sql(f"select * from coded where code not in (select code from coded where code in ({listed}))")
    assert rows(ops.not_in_present(df, "code", codes, check=True)) == rows(literal)


# --- shaping and sets -------------------------------------------------------------------------------------------


def test_minus_treats_nulls_as_equal(frame):
    left, right = frame("v int", [(1,), (1,), (None,)]), frame("v int", [(None,)])
    assert rows(ops.minus(left, right)) == [(1,)]
    assert rows(ops.minus(left, left)) == []


def test_stack_fills_missing_columns(frame):
    a, b = frame("k int, v int", [(1, 2), (1, 2)]), frame("k int", [(1,), (3,)])
    assert rows(ops.stack(a, b)) == [(1, 2), (1, None), (3, None)]


def test_conform(frame):
    got = ops.conform(frame("b int, x int", [(1, 2)]), layout("a string, b bigint"))
    assert got.dtypes == [("a", "string"), ("b", "bigint")] and rows(got) == [(None, 1)]


def test_select_star_prefixes_clashes(frame):
    a, b = frame("k int, v int", [(1, 2)]), frame("k int, w int", [(1, 3)])
    joined = a.alias("a").join(b.alias("b"), F.col("a.k") == F.col("b.k"))
    assert ops.select_star({"a": a, "b": b}, joined).columns == ["k", "v", "b_k", "w"]


def test_sanitize_columns(frame):
    df = frame("`a b (Percent)` int, `c,000` int", [(1, 2)])
    assert ops.sanitize_columns(df).columns == ["a_b_Percent", "c_000"]
    with pytest.raises(ValueError, match="collide"):
        ops.sanitize_columns(frame("`a b` int, `a_b` int", [(1, 2)]))


def test_reversing_twice_is_the_identity(frame):
    df = frame("b int, e int, m string", [(1, 2, "x")])
    once = ops.reverse_ends(df, [("b", "e")])
    assert rows(once) == [(2, 1, "x")] and once.columns == df.columns
    assert rows(ops.reverse_ends(once, [("b", "e")])) == rows(df)


# --- order ------------------------------------------------------------------------------------------------------


def test_next_value_keeps_nulls_apart_from_the_end(frame):
    df = frame("r string, m int, c string", [("A", 1, "x"), ("A", 2, None), ("A", 30, "y"), ("A", None, "z"), ("B", 1, "q")])
    got = ops.next_value(df, "r", "m", "c", F.floor(F.col("m") / 10), "n")
    assert rows(got) == [("A", 1, "x", None), ("A", 2, None, "y"), ("A", 30, "y", "z"), ("A", None, "z", None), ("B", 1, "q", None)]


@few
@given(st.integers(0, 10_000), st.sampled_from([1, 7, 1000]))
def test_next_value_equals_one_window(frame, seed, width):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    data = [(rng.choice(["hot", "hot", "b", None]), pick(*range(30)), pick("x", "y")) for _ in range(50)]
    df = frame("r string, m int, c string", data)
    df.createOrReplaceTempView("posts")
    plain = df.sparkSession.sql(
        "select *, lead(c) over (partition by r order by m asc nulls last, c asc nulls last) as n from posts"
    )
    assert rows(ops.next_value(df, "r", "m", "c", F.floor(F.col("m") / width), "n")) == rows(plain)
    assert rows(ops.next_value(df, "r", "m", "c", into="n")) == rows(plain)
    changed = rows(plain.where("c <> n"))
    assert rows(ops.next_value(df, "r", "m", "c", into="n", changes=True)) == changed
    assert rows(ops.next_value(df, "r", "m", "c", F.floor(F.col("m") / width), "n", changes=True)) == changed


def test_top_per_group(frame):
    df = frame("k string, m int, id int", [("a", 1, 2), ("a", 1, 1), ("a", None, 0), ("b", None, 5)])
    low = ops.top_per_group(df, ["k"], [F.col("m").asc_nulls_last(), F.col("id")])
    high = ops.top_per_group(df, ["k"], [F.col("m").desc_nulls_first(), F.col("id")])
    assert rows(low) == [("a", 1, 1), ("b", None, 5)]
    assert rows(high) == [("a", None, 0), ("b", None, 5)]


def test_preview_needs_an_order(frame):
    df = frame("a int", [(3,), (1,), (2,)])
    assert rows(ops.preview(df, 2, ["a"])) == [(1,), (2,)]
    with pytest.raises(ValueError):
        ops.preview(df, 2, [])


def test_running_count_case(frame):
    df = frame("zip string, county int, beds int", [("Z1", 1, 10), ("Z1", 1, 20), ("Z1", 3, 5), ("Z2", 3, 7)])
    got = ops.running_count_at_key(df, "zip", "county", "rank", totals=["beds"])
    assert rows(got) == [(1, 2, 2, 30), (3, 3, 2, 12)]


@few
@given(st.lists(st.tuples(st.sampled_from(["p", "q", None]), small), max_size=30))
def test_running_count_equals_row_number(frame, data):
    df = frame("z string, k int", data)
    df.createOrReplaceTempView("homes")
    plain = df.sparkSession.sql(
        "select k, max(i) from (select k, row_number() over (partition by z order by k nulls first) i from homes) where k is not null group by k"
    )
    assert rows(ops.running_count_at_key(df, "z", "k", "i").select("k", "i")) == rows(plain)


values = st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e12, 1e12, allow_nan=False), st.just(0.001))


@few
@given(st.lists(values, min_size=1, max_size=40))
def test_rank_quantiles_equal_row_numbers(frame, data):
    df = frame("v double", [(x,) for x in data])
    df.createOrReplaceTempView("measured")
    plain = df.sparkSession.sql(
        """select q, v from (select v, row_number() over (order by v nulls first) i, count(*) over () n from measured)
        join values (0.25D), (0.5D), (0.75D) as f(q) on i = floor(n * q)"""
    )
    assert rows(ops.rank_quantiles(df, "v", (0.25, 0.5, 0.75))) == rows(plain)


@pytest.mark.parametrize(
    ("data", "kept"),
    [([1, 2, 3, 4, 5, 6, 7, 100], [1, 2, 3, 4, 5, 6, 7]), ([1, 2, 3], [1]), ([5], [])],
)
def test_upper_fence(frame, data, kept):
    df = frame("v double", [(float(x),) for x in data])
    assert [r[0] for r in rows(ops.upper_fence_filter(df, "v"))] == kept


def test_quantiles_are_exact_for_any_values(frame, spark):
    big = 9007199254740993  # one more than doubles can hold
    longs = frame("v bigint", [(big + k,) for k in range(-3, 4)] + [(None,)])
    got = ops.rank_quantiles(longs, "v", (0.25, 0.5, 0.75, 1.0))
    assert dict(got.dtypes)["v"] == "bigint"
    assert rows(got) == [(0.25, big - 3), (0.5, big - 1), (0.75, big + 1), (1.0, big + 3)]
    inf = float("inf")
    odd = frame("v double", [(-inf,), (-1.5,), (0.0,), (5e-324,), (1e300,), (inf,), (inf,), (float("nan"),)])
    found = [r.v for r in ops.rank_quantiles(odd, "v", tuple(k / 8 for k in range(1, 9))).orderBy("fraction").collect()]
    assert found[:7] == [-inf, -1.5, 0.0, 5e-324, 1e300, inf, inf] and found[7] != found[7]


@pytest.fixture
def crowded(monkeypatch):
    """Brackets and further passes also for a few thousand rows."""
    monkeypatch.setattr(ordering, "_CROWD", 3)


def test_quantiles_by_several_passes(spark, frame, crowded, monkeypatch):
    passes = []
    real = ordering._counted
    monkeypatch.setattr(ordering, "_counted", lambda *a: passes.append(a) or real(*a))
    rng = random.Random(4)
    data = [rng.choice([None, float("inf"), -float("inf"), float("nan"), 7.5, rng.gauss(0, 1), rng.gauss(0, 1) * 1e9, rng.random() * 1e-300]) for _ in range(3000)]
    df = frame("v double", [(x,) for x in data]).repartition(5)
    fractions = tuple(k / 16 for k in range(17))
    rank = lambda x: (x is not None, x != x if x is not None else False, 0.0 if x is None or x != x else x)
    ordered = sorted(data, key=rank)
    got = {r.fraction: r.v for r in ops.rank_quantiles(df, "v", fractions).collect()}
    assert {q: repr(v) for q, v in got.items()} == {q: repr(ordered[int(3000 * q) - 1]) for q in fractions[1:]}
    assert len(passes) == 3


def test_quantiles_of_close_values_and_long_decimals(spark, frame, crowded):
    df = spark.range(100_000).select((1e9 + F.col("id") / 10).alias("v"))
    got = {r.fraction: r.v for r in ops.rank_quantiles(df, "v", (0.25, 0.5, 0.75)).collect()}
    assert got == {0.25: 1e9 + 2499.9, 0.5: 1e9 + 4999.9, 0.75: 1e9 + 7499.9}
    exact = spark.range(1000).select((F.lit("1234567890123456789").cast("decimal(38,12)") + (F.col("id") / 1000).cast("decimal(38,12)")).alias("v"))
    ordered = sorted(r.v for r in exact.collect())
    assert [r.v for r in ops.rank_quantiles(exact, "v", (0.1, 0.9)).orderBy("fraction").collect()] == [ordered[99], ordered[899]]


def test_quantiles_of_an_empty_table(frame):
    assert rows(ops.rank_quantiles(frame("v double", []), "v", (0.5, 1.0))) == []
    assert rows(ops.rank_quantiles(frame("v double", [(None,)] * 5), "v", (0.1, 1.0))) == [(1.0, None)]


def test_a_quantile_costs_two_scans_and_few_exchanges(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_quantity")
    text = ops.rank_quantiles(df, "l_quantity", (0.25, 0.5))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange ") == 2  # the other scan has two more, of cells


# --- numbering ---------------------------------------------------------------------------------------------------


@few
@given(st.lists(st.tuples(small, st.sampled_from(["x", "y", None])), max_size=40))
def test_numbered_equals_row_number(frame, data):
    df = frame("a int, b string", data).repartition(3)
    order = [F.col("b").desc_nulls_first()]
    ordered = sorted(data, key=lambda r: ({None: 0, "y": 1, "x": 2}[r[1]], r[0] is None, r[0] or 0))
    assert rows(ops.numbered(df, order)) == sorted(((*r, i) for i, r in enumerate(ordered, 1)), key=lambda r: [(v is None, str(type(v)), v) for v in r])


def test_numbering_a_row_that_fills_the_table(spark, monkeypatch):
    monkeypatch.setattr(ordering, "REPEATS", 64)
    df = spark.range(10_000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("v"))
    got = [(r.v, r.place) for r in ops.numbered(df, [F.col("v").asc()]).orderBy("place").collect()]
    assert got == list(zip(sorted(0 if i % 3 < 2 else i for i in range(10_000)), range(1, 10_001)))
    groups = {r.v: (r.n, r.place) for r in ops.place_of_groups(df, [F.col("v").desc()]).collect()}
    assert groups[0] == (6667, 3334) and groups[9998] == (1, 1) and len(groups) == 3334


@few
@given(st.lists(st.tuples(small, st.one_of(st.none(), st.text(max_size=4))), max_size=30))
def test_value_codes_keep_the_order(frame, data):
    df = frame("k int, v string", data)
    coded = ops.value_codes(df, "v", 100)
    found = coded.codes.orderBy("code").collect()
    assert [r.v for r in found] == sorted({v for _, v in data if v is not None}, key=lambda v: v.encode())
    assert [r.code for r in found] == list(range(1, len(found) + 1))
    joined = df.withColumnRenamed("v", "w").join(coded.codes, F.col("w") == F.col("v"), "left")
    by_code = joined.groupBy("k").agg(F.min("code").alias("lo"), F.max("code").alias("hi"))
    assert rows(coded.values(by_code, ["lo", "hi"])) == rows(df.groupBy("k").agg(F.min("v"), F.max("v")))


def test_too_many_or_too_long_values_have_no_codes(frame, monkeypatch):
    df = frame("v string", [("a",), ("b",), ("b",), (None,)])
    assert ops.value_codes(df, "v", 1) is None and ops.value_codes(df, "v", 2) is not None
    monkeypatch.setattr(ordering, "LONGEST_CODES", 1)
    assert ops.value_codes(df, "v", 2) is None


# --- matches by classes --------------------------------------------------------------------------------------------


def test_match_classes_count_what_a_join_writes(frame):
    left = frame("k int, m int, a string", [(1, 1, "x"), (1, 1, "x"), (1, 2, "y"), (2, 1, "z"), (None, 1, "n")])
    right = frame("k int, b int", [(1, 10), (1, 11), (3, 12), (None, 13)])
    third = frame("m int, c int", [(1, 5), (1, 6), (1, 7), (2, 8)])
    found = ops.match_classes({"l": left, "r": right, "t": third}, ["k", "m"])
    assert rows(found.classes) == [(1, 1, 2, 2, 3, 12), (1, 2, 1, 2, 1, 2)]
    assert rows(found.members("l")) == [(1, 1, "x"), (1, 1, "x"), (1, 2, "y")]
    assert rows(found.members("r")) == [(1, 10), (1, 11)] and found.members("t").count() == 4
    joined = left.join(right, "k").join(third, "m")
    assert rows(found.expanded().select("k", "m", "a", "b", "c")) == rows(joined.select("k", "m", "a", "b", "c"))
    assert rows(found.expanded(F.col("rows") < 10).select("k", "m", "a", "b", "c")) == [(1, 2, "y", 10, 8), (1, 2, "y", 11, 8)]


def test_a_key_column_left_out_of_a_match(frame):
    """One row for rows that differ in it alone, nulls among the others kept; nothing matches by it alone."""
    left = frame("k int, m double, a string", [(1, 1.0, "x"), (1, 1.5, "x"), (1, 1.7, "x"), (1, 1.5, None), (1, 1.0, None), (2, 3.0, "y"), (3, 1.0, "z")])
    right = frame("k int, b int", [(1, 10), (2, 11), (3, 12)])
    third = frame("k int, m double, c string", [(1, 1.0, "s"), (1, 1.5, "s"), (1, 1.6, "t"), (1, 1.7, "u"), (2, 3.0, "s"), (3, 9.0, "s")])
    found = ops.match_classes({"l": left, "r": right, "t": third}, ["k", "m"])
    shown = ["k", "a", "b", "c"]
    assert rows(found.expanded(without="m").select(*shown)) == [
        (1, "x", 10, "s"), (1, "x", 10, "u"), (1, None, 10, "s"), (2, "y", 11, "s")]
    assert rows(found.expanded(without="m").select(*shown)) == rows(found.expanded().select(*shown).distinct())
    assert rows(found.expanded(F.col("k") == 2, without="m").select(*shown)) == [(2, "y", 11, "s")]


def test_a_key_with_a_third_of_both_sides_costs_its_sum(spark):
    """Thirty billion matches of one key, none written."""
    one = lambda n, c: spark.range(n, numPartitions=4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias(c))
    found = ops.match_classes({"a": one(600_000, "x"), "b": one(450_000, "y")}, ["k"])
    top = found.classes.orderBy(F.desc("rows")).first()
    assert tuple(top) == (-1, 200_000, 150_000, 30_000_000_000)
    assert found.classes.count() == 300_001 and found.members("b").count() == 450_000
    assert found.expanded(F.col("rows") == 1).count() == 300_000


def test_more_matches_than_a_long_holds(frame, monkeypatch):
    many = frame("k int, n bigint", [(1, 1)] * 3)
    classes = ops.match_classes({c: many.select("k", F.col("n").alias(c)) for c in "abc"}, ["k"]).classes
    assert rows(classes) == [(1, 3, 3, 3, 27)]
    huge = classes.select(F.try_multiply(F.lit(1 << 62), F.col("a_rows")).alias("v"))
    assert huge.first().v is None


def test_one_interval_over_a_whole_hot_route(frame, spark):
    """Repeats are bounded whatever the length; results are those of the plain condition."""
    points = spark.range(2000).select(F.lit("r").alias("r"), (F.col("id") * 1.7e6).alias("x"))
    spans = [("r", 0.0, 1e12), ("r", 5.0, 5.0), ("r", 1e6, 1.00001e6), ("r", -3.0, 2e9), ("q", 0.0, 1.0)]
    intervals = frame("k string, lo double, hi double", spans)
    sides = ops.interval_sides(points, intervals, ("r", "k"), "x", "lo", "hi", bin=5.0)
    assert sides.intervals.count() <= 3 * len(spans)
    for how in ("inner", "left"):
        plain = points.join(intervals, F.expr("r = k and x >= lo and x <= hi"), how)
        assert rows(ops.interval_join(points, intervals, ("r", "k"), "x", "lo", "hi", bin=5.0, how=how)) == rows(plain)
    none = intervals.where("false")
    assert ops.interval_join(points, none, ("r", "k"), "x", "lo", "hi", bin=5.0).count() == 0
    assert ops.interval_join(points, none, ("r", "k"), "x", "lo", "hi", bin=5.0, how="left").count() == 2000
