"""Plans and hot keys: what has to hold at a thousand times the data."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from roadweave import operators as ops  # noqa: E402
from roadweave.checks.queries import registered  # noqa: E402
from roadweave.plans import countylines, nodes  # noqa: E402
from roadweave.sources import derived  # noqa: E402

SMALL = "/root/testdata/sf0.001"
QUERIES = registered()
# One row per fraction, per table or per range, or a checked number of distinct values, is gathered here, never the rows of a table.
GATHERS = {"min_scalar_filter", "global_total", "quartile_rows", "length_outliers", "iqr_filter", "iqr_filter_distress",
           "corridor_candidates_literal", "corridor_extremes_literal", "delivered_rows", "delivery_order",
           "lab_pivot", "lab_pivot_blank_to_null"}
# Two rows of each sampled range are gathered here.
RANGES = {"county_crossings", "county_crossings_numeric", "county_lines_inside_segments"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", QUERIES)
def test_no_plan_pairs_all_rows_or_runs_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SMALL))
    for operator in ("CartesianProduct", "NestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "Scan ExistingRDD"):
        assert operator not in text, operator
    if name not in GATHERS:
        # the levels of interval lengths are gathered: a handful of numbers, made distinct before
        levels = text.count("partial_collect_set(__level")
        assert text.count("SinglePartition") == levels + (name in RANGES)
        assert "Broadcast" not in re.sub(r"autoBroadcast\w+", "", text)


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [("maintained_routes", 1), ("distress_agg", 1), ("traffic_agg", 1), ("facility_rollup_corrected", 2), ("facility_rollup", 3), ("group_by_expr", 1)],
)
def test_number_of_shuffles(spark, no_broadcast, name, shuffles):
    assert plan(QUERIES[name](spark, SMALL)).count("Exchange ") == shuffles


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["star_join"](spark, SMALL).where("gn_id > 5").select("gn_id", "y_coord"))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("GreaterThan(o_orderkey,5)" in line for line in scans)
    assert all("o_totalprice" not in line and "o_custkey" not in line for line in scans)
    log = plan(QUERIES["maintained_routes"](spark, SMALL))
    assert "l_extendedprice" not in log and "l_orderkey" not in log


def test_partial_aggregation_before_every_grouping_shuffle(spark):
    """A hot key reaches its task as one partial row per map task."""
    for name in ("gn_locate_unique", "key_violations", "distress_agg", "lab_conflicts"):
        assert "partial_" in plan(QUERIES[name](spark, SMALL)), name


def test_a_larger_table_is_made_distinct_in_more_tasks(spark, no_broadcast, monkeypatch):
    whole = derived.Inputs(spark, SMALL)["sec_segments"].distinct()
    monkeypatch.setattr(derived, "TASK_ROWS", 500)
    dealt = derived.Inputs(spark, SMALL)["sec_segments"].distinct()
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L?, \d\d+\), REPARTITION_BY_NUM", plan(dealt))
    assert plan(dealt).count("Exchange ") == 2  # both sides of the join; the distinct rows lie in the same tasks
    assert max(r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()) < 1000
    key = ["beg_gn", "end_gn", "begin_mi", "end_mi", "to_descr"]
    assert rows(dealt.select(*key)) == rows(whole.select(*key))


def test_a_short_list_of_forests_shuffles_no_segment(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "20k")
    try:
        text = plan(QUERIES["section_totals"](spark, "/root/testdata/sf0.1"))
    finally:
        for key in keys:
            spark.conf.unset(key)
    assert re.search(r"BroadcastHashJoin .*LeftAnti", text)


def test_corridors_of_a_dataset_need_no_distinct_rows(spark):
    for name in ("maintained_hpms", "maintained_or_hpms"):
        assert "to_descr" not in plan(QUERIES[name](spark, SMALL)), name


def test_segments_are_looked_up_once_before_they_snap(spark):
    text = plan(QUERIES["begin_node_snap"](spark, SMALL))
    assert "l_orderkey" not in text and "p_partkey" not in text
    assert text.count("Exchange hashpartitioning") == 1  # of segments at a node's mile


# --- a third and more of all rows under one key ---------------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """60,000 posts, two thirds of them on one route."""
    n = spark.range(60_000, numPartitions=8)
    route = F.when(F.col("id") % 3 < 2, F.lit("HOT")).otherwise(F.concat(F.lit("R"), (F.col("id") % 97).cast("string")))
    post = F.concat((F.col("id") % 211).cast("string"), F.lit("+0."), F.lpad((F.col("id") % 997).cast("string"), 3, "0"))
    return n.select(
        route.alias("nrlg_dept_route"), post.alias("nrlg_milepoint"),
        F.concat(F.lit("K"), F.floor((F.col("id") % 211) / 10).cast("string")).alias("nrlg_county"), "id",
    )


def test_crossings_of_a_hot_route(spark, hot):
    hot.createOrReplaceTempView("hot_posts")
    expected = spark.sql(
        """select nrlg_dept_route, nrlg_milepoint, nrlg_county, n from (
        select *, lead(nrlg_county) over (partition by nrlg_dept_route order by nrlg_milepoint, nrlg_county) n
        from (select distinct nrlg_dept_route, nrlg_milepoint, nrlg_county from hot_posts)) where nrlg_county <> n"""
    )
    assert rows(countylines.county_crossings(hot)) == rows(expected)


def test_nine_tenths_of_a_route_within_one_mile(spark):
    """The ranges are sampled from the posts themselves: no task orders more than a few times its share."""
    n = spark.range(40_000, numPartitions=8)
    mile = F.when(F.col("id") % 10 < 9, F.lit(17)).otherwise(F.col("id") % 300)
    posts = n.select(
        F.when(F.col("id") % 50 < 49, F.lit("HOT")).otherwise(F.lit("COLD")).alias("nrlg_dept_route"),
        F.concat(mile.cast("string"), F.lit("+0."), F.lpad(F.col("id").cast("string"), 6, "0")).alias("nrlg_milepoint"),
        F.concat(F.lit("K"), (F.col("id") % 7).cast("string")).alias("nrlg_county"),
    )
    posts.createOrReplaceTempView("dense_posts")
    for numeric, order in ((False, "nrlg_milepoint"), (True, "cast(replace(nrlg_milepoint, '+0.', '.') as double)")):
        expected = spark.sql(
            f"""select nrlg_dept_route, nrlg_milepoint, nrlg_county, n from (
            select *, lead(nrlg_county) over (partition by nrlg_dept_route order by {order}, nrlg_county) n from dense_posts)
            where nrlg_county <> n"""
        )
        assert rows(countylines.county_crossings(posts, numeric)) == rows(expected)
    keys = [F.col("nrlg_dept_route").asc_nulls_first(), F.col("nrlg_milepoint").asc_nulls_last()]
    dealt = posts.repartitionByRange(16, *keys).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in dealt.collect()) < 3 * 40_000 / 16


def test_hot_point_key_is_split_by_bins(spark, hot):
    points = hot.select("nrlg_dept_route", (F.col("id") % 5000 / 10).alias("km"), "id")
    spans = spark.range(500).select(
        F.when(F.col("id") % 2 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("R"), (F.col("id") % 97).cast("string"))).alias("r"),
        (F.col("id") * 1.0).alias("lo"), (F.col("id") + 1.5).alias("hi"),
    )
    on = ("nrlg_dept_route", "r")
    binned = ops.interval_join(points, spans, on, "km", "lo", "hi", bin=2.0)
    plain = ops.interval_join(points, spans, on, "km", "lo", "hi")
    total = lambda df: df.agg(F.count("*"), F.sum("id"), F.sum("lo")).first()
    assert total(binned) == total(plain) == total(ops.interval_join(points, spans, on, "km", "lo", "hi", bin=2.0, salt=4))


def test_hot_node_is_combined_before_the_shuffle(spark):
    """One node with 40,000 rows, alike or not."""
    rows_of = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") < 40_000, F.lit(1)).otherwise(F.col("id")).alias("gn_id"), F.lit("A").alias("dc_id"),
        F.lit(1.0).alias("gn_dcmi"), F.lit(0.0).alias("x"),
    )
    assert ops.keep_unambiguous(rows_of, ["gn_id", "dc_id"]).count() == 20_001
    spoiled = rows_of.withColumn("x", F.when((F.col("gn_id") == 1) & (F.rand(3) < 0.001), 1.0).otherwise(F.col("x")))
    assert ops.keep_unambiguous(spoiled, ["gn_id", "dc_id"]).count() == 20_000


def test_quartiles_of_a_hot_value(spark):
    df = spark.range(60_000, numPartitions=8).select(F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.col("id") / 100).alias("v"))
    ordered = [r.v for r in df.orderBy("v").collect()]
    got = {r.fraction: r.v for r in ops.rank_quantiles(df, "v", (0.25, 0.5, 0.75)).collect()}
    assert got == {q: ordered[int(60_000 * q) - 1] for q in (0.25, 0.5, 0.75)}


def test_skewed_join_is_split_at_run_time(spark):
    """The session settings let AQE split the hot partition of a left join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    segs = spark.range(200_000, numPartitions=8).select(
        F.lit("A").alias("c"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("b"), F.md5(F.col("id").cast("string")).alias("w")
    )
    points = spark.range(50_000).select(F.lit("A").alias("c"), F.col("id").alias("n"), F.rand(1).alias("mi"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = ops.lookup_ends(segs, points, "c", "n", {"b": {"mi": "bm"}})
        assert joined.count() == 200_000
        summed = joined.agg(F.max("w"), F.count("bm"))
        summed._jdf.queryExecution().toRdd().count()
        assert "isFinalPlan=true" in plan(summed) and "skew=true" in plan(summed)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_unknown_ends_may_fill_a_corridor(spark):
    """Two thirds of the segments have an unknown end."""
    segs = spark.range(30_000, numPartitions=8).select(
        F.lit("A").alias("corridor_code_rb"), F.col("id").alias("beg_gn"),
        F.when(F.col("id") % 3 < 2, F.lit(nodes.UNKNOWN_NODE)).otherwise(F.col("id") + 1).alias("end_gn"),
    )
    gn = spark.range(0, 30_000, 2).select(F.col("id").alias("gn_id"), F.lit("A").alias("dc_id"), (F.col("id") / 8).alias("gn_dcmi"),
                                         F.lit(0.0).alias("tis_xcoord"), F.lit(0.0).alias("tis_ycoord"))
    got = nodes.segment_nodes(segs, gn)
    assert got.count() == 15_002 and got.where("tis_mi is null").count() == 2


def test_posts_are_rounded_once_and_not_in_each_comparison(spark, no_broadcast):
    """A sort by an expression works it out whenever it compares two rows."""
    sorts = [line for line in plan(QUERIES["survey_match_unambiguous"](spark, SMALL)).splitlines() if re.search(r"\bSort \[", line)]
    assert sorts and not any("decimal" in line for line in sorts)


def test_the_rows_of_a_survey_match_are_not_compared(spark, no_broadcast):
    """Only those of corridor records with several lengths in a mile, which are matched apart."""
    for name in ("survey_match_by_corridor", "survey_match_north"):
        text = plan(QUERIES[name](spark, SMALL))
        whole = text[text.index(":- Project"):text.index("\n   +- HashAggregate" if "\n   +- HashAggregate" in text else "\n+- HashAggregate")]
        joins = [m.start() for m in re.finditer("SortMergeJoin", whole)]
        assert len(joins) == 2 and "Aggregate" not in whole[:joins[1]]


def test_posts_of_a_written_match_are_worked_out_once(spark, no_broadcast):
    """A filter on the keys' nulls works out each key of a record or description a second time."""
    filters = [line for line in plan(QUERIES["survey_match_south"](spark, SMALL)).splitlines() if re.search(r"\bFilter ", line)]
    given = [line for line in filters if "l_linestatus" not in line]
    assert len(given) == 2 and not any("l_extendedprice" in line for line in given)
