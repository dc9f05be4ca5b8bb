"""Every query of the library over whole test tables. Each takes the derived inputs and returns a frame.

Frames are lazy but for tables that a query writes to the shared folder first, as the published scripts do: located
nodes and reference points where they are used more than once, and results that a query then reads back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave import operators as ops
from roadweave.functions import (
    concat_present,
    exact_sum,
    milepost_to_double,
    reference_point_to_number,
    round_half_up,
)
from roadweave.plans import corridors, county, countylines, lab, nodes, pavement
from roadweave.sources.derived import Inputs
from roadweave.sources.schemas import SEC_SEGMENTS
from roadweave.sources.tables import define_view, materialize, read_table, replace_table, shared_folder, snapshot

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return fn(Inputs(spark, directory))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        return run

    return {name: bind(fn) for name, fn in QUERIES.items()}


# --- nodes on corridors -------------------------------------------------------------------------------------


@query
def gn_locate(t: Inputs) -> DataFrame:
    """C1, J1, J2, J4, E1, E12, E13, E16, E17, F3, A9"""
    return nodes.locate_nodes(t["gn_locate"], t["tcr_lookup"], t["gn_coords"])


@query
def gn_locate_unique(t: Inputs) -> DataFrame:
    """C2, Q1, F9, J10, S2"""
    return nodes.unique_nodes(t["gn_locate"], t["tcr_lookup"], t["gn_coords"])


@query
def gn_table_keys(t: Inputs) -> DataFrame:
    """C2 in its keyed form, A6, A10, F2"""
    return nodes.unique_node_keys(nodes.locate_nodes(t["gn_locate"], t["tcr_lookup"], t["gn_coords"]))


@query
def segment_nodes(t: Inputs) -> DataFrame:
    """C3, J5, U1, U6, S9, P4, P5"""
    return nodes.segment_nodes(t["sec_segments"], gn_locate_unique(t))


@query
def segment_nodes_strict(t: Inputs) -> DataFrame:
    """C3 without unknown ends, J16"""
    return nodes.segment_nodes(t["sec_segments"], gn_locate_unique(t), strict=True)


@query
def reference_points(t: Inputs) -> DataFrame:
    """C4, J4, A1, A8, E4, E10, U1"""
    return nodes.reference_points(segment_nodes(t), t["ref_marker"])


@query
def reference_point_numbers(t: Inputs) -> DataFrame:
    """Both readings of a reference point"""
    point = F.col("ref_point")
    return reference_points(t).where(point.isNotNull()).select(
        "corridor_code_rb", "gn_id",
        reference_point_to_number(point).alias("by_position"), reference_point_to_number(point, exact=True).alias("exact"),
    )


def _located(t: Inputs) -> DataFrame:
    """C2 as a written table."""
    return materialize(gn_locate_unique(t))


def _points(t: Inputs, located: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """C4 as a written table (S5): each end of a segment looks it up."""
    located = gn_locate_unique(t) if located is None else located
    ends = nodes.segment_nodes(t["sec_segments"], located, strict=strict)
    return materialize(nodes.reference_points(ends, t["ref_marker"]))


@query
def segment_enriched(t: Inputs) -> DataFrame:
    """C5, J6, E2, E3, E8, E11, A9"""
    return nodes.enrich_segments(t["sec_segments"], _points(t))


@query
def segment_enriched_exact(t: Inputs) -> DataFrame:
    """C5 with whole miles of offset counted"""
    return nodes.enrich_segments(t["sec_segments"], _points(t), exact=True)


@query
def begin_node_snap(t: Inputs) -> DataFrame:
    """C6, J6, J7, E13"""
    return _snapped(t, t["sec_segments"])


def _snapped(t: Inputs, segments: DataFrame) -> DataFrame:
    located = _located(t)
    return nodes.snap_begin_nodes(segments, _points(t, located, strict=True), located)


# --- corridor inventories -----------------------------------------------------------------------------------


@query
def missing_corridors(t: Inputs) -> DataFrame:
    """C7, J8, J9, U2, U4, E2"""
    return corridors.missing_corridors(t["roadlog"], t["surveyed_corridors"])


@query
def corridor_candidates(t: Inputs) -> DataFrame:
    """C8 (nodes of the missing corridors), J1, U6"""
    return corridors.corridor_nodes(missing_corridors(t), gn_locate_unique(t))


@query
def corridor_candidates_literal(t: Inputs) -> DataFrame:
    """C8 (restricted candidates), F11, J13, U1"""
    return corridors.candidate_extremes_literal(materialize(corridor_candidates(t)))


@query
def corridor_extremes_literal(t: Inputs) -> DataFrame:
    """C8 as published, W2, W3, O5"""
    return corridors.corridor_extremes(materialize(corridor_candidates(t)), literal=True)


@query
def corridor_extremes(t: Inputs) -> DataFrame:
    """C8, W2, W3, O5"""
    return corridors.extremes_of(missing_corridors(t), gn_locate_unique(t))


@query
def new_corridor_records(t: Inputs) -> DataFrame:
    """C9, J15, F5, P1, P5, P6, E8, U1"""
    return corridors.new_corridor_records(corridor_extremes(t), t["roadlog"])


@query
def final_dataset(t: Inputs) -> DataFrame:
    """C10, F4, F5, J11, U2"""
    return corridors.final_dataset(segment_enriched(t), t["forest"], (12174,))


@query
def final_dataset_south(t: Inputs) -> DataFrame:
    """C10 for the other van"""
    return corridors.final_dataset(segment_enriched(t), t["forest"], (12175,))


@query
def final_dataset_padded(t: Inputs) -> DataFrame:
    """C10 with forest codes of six digits (K9)"""
    return corridors.final_dataset(segment_enriched(t), t["forest"], (12174,), pad=6)


@query
def final_dataset_addback(t: Inputs) -> DataFrame:
    """C10 with missing corridors added back, F12, U3, U5"""
    return _added_back(t, 12174)


@query
def final_dataset_addback_south(t: Inputs) -> DataFrame:
    """C10 with missing corridors of the other van added back"""
    return _added_back(t, 12175)


def _added_back(t: Inputs, van: int) -> DataFrame:
    # The rows of the dataset are chosen by columns that snapping leaves alone, so they are chosen before it too.
    collected = corridors.final_dataset(t["sec_segments_new_col"], t["forest"], (van,))
    return corridors.final_dataset_with_missing(
        _snapped(t, collected), t["sec_segments"], t["sec_segments_new_col"], t["forest"], van
    )


@query
def forest_keys(t: Inputs) -> DataFrame:
    """C10 (forest key table), A10, E8, K25: equal numbers written differently are one key"""
    return t["forest_raw"].select(F.col("tfh_route").cast("bigint").alias("corridor")).distinct()


def _datasets(t: Inputs, vans: tuple[int, ...], distinct: bool = True) -> DataFrame:
    """The collection dataset without the looked-up columns, which none of its readers below uses.

    Node lookups are unique, so they neither add nor drop rows. Readers that only want distinct corridors leave repeats in.
    """
    segments = t["sec_segments"]
    return corridors.final_dataset(segments.distinct() if distinct else segments, t["forest"], vans)


@query
def delivery_order(t: Inputs) -> DataFrame:
    """O1, O2: the place of each (direction, lane, begin mile) in its corridor: its place of all less the corridor's first"""
    corridor, rows = ["van_no", "secfile_name", "corridor_code_rb"], ["dir", "lane", "begin_mi"]
    placed = materialize(corridors.places_in_delivery(_datasets(t, (12174, 12175)).select(*corridor, *rows)))
    first = placed.groupBy(*corridor).agg(F.min("place").alias("first"))
    return placed.join(first, corridor).select(*corridor, *rows, "n", (F.col("place") - F.col("first") + 1).alias("place"))


@query
def delivered_rows(t: Inputs) -> DataFrame:
    """O1, O2: rows with their places in the order they are handed over"""
    order = ["van_no", "secfile_name", "corridor_code_rb", "dir", "lane", "begin_mi"]
    return corridors.in_delivery_order(_datasets(t, (12174, 12175)).select(*order))


@query
def view_rows(t: Inputs) -> DataFrame:
    """A named view, read by SQL"""
    define_view(gn_locate_unique(t), "gn_dc_unique")
    return t.spark.sql("select dc_id, count(*) as nodes, max(gn_dcmi) as last_mile from gn_dc_unique group by dc_id")


@query
def replaced_table(t: Inputs) -> DataFrame:
    """A table replaced by a part of itself, read by its name"""
    path = f"{shared_folder(t.spark)}/{uuid.uuid4().hex}"
    table = replace_table(county_totals(t), path, keys=["fips"])
    replace_table(table.where("max_deaths > 0"), path, keys=["fips"])
    return read_table(t.spark, path)


@query
def marker_snapshot(t: Inputs) -> DataFrame:
    """Four of the eleven columns of the marker layout"""
    return snapshot(t["ref_marker_source"], ["dc_id", "beg_dcmi", "end_dcmi", "dc_rm"])


@query
def section_totals(t: Inputs) -> DataFrame:
    """C25, A2, A4, A6, E15, F4, F9, J13, P4, U1"""
    return corridors.section_totals(_datasets(t, (12174, 12175)))


@query
def maintained_routes(t: Inputs) -> DataFrame:
    """C22, J8, J9, J13, A1, A2, A10, S3"""
    return corridors.maintained_routes(t["roadlog"])


@query
def maintained_hpms(t: Inputs) -> DataFrame:
    """C23, J8, J9, J15, A11"""
    return corridors.maintained_hpms(t["roadlog"], t["hpms"], _datasets(t, (12174,), distinct=False))


@query
def maintained_or_hpms(t: Inputs) -> DataFrame:
    """C24, J5, F7, A10"""
    return corridors.maintained_or_hpms(_datasets(t, (12174,), distinct=False), t["hpms"], t["roadlog"])


@query
def survey_gap(t: Inputs) -> DataFrame:
    """C21, J13, P5, F3, F4, A9"""
    return corridors.survey_gap(t["sec_segments"], _located(t))


@query
def survey_gap_xy(t: Inputs) -> DataFrame:
    """C21 with latitude and longitude put right"""
    return corridors.survey_gap(t["sec_segments"], _located(t), swap_xy=True)


# --- county lines and survey files --------------------------------------------------------------------------


@query
def county_crossings(t: Inputs) -> DataFrame:
    """C18, W1, F10, S3"""
    return countylines.county_crossings(t["roadlog"])


@query
def county_crossings_numeric(t: Inputs) -> DataFrame:
    """C18 along mileposts as numbers"""
    return countylines.county_crossings(t["roadlog"], numeric=True)


@query
def surveyed_segments(t: Inputs) -> DataFrame:
    """C19 (first step), J3, E8, E12"""
    return countylines.surveyed_segments(t["sec_file"], t["files_combined"])


@query
def county_lines_inside_segments(t: Inputs) -> DataFrame:
    """C19 with lines inside the segment (K2), E5, E6, E7, E9, J2, J4, A9"""
    return countylines.place_county_lines(county_crossings(t), materialize(surveyed_segments(t)))


@query
def ambiguous_posts(t: Inputs) -> DataFrame:
    """Posts, in whole miles, that a match without a corridor expands"""
    return countylines.ambiguous_posts(t["north_corr_rb"], 0)


@query
def survey_match_classes(t: Inputs) -> DataFrame:
    """The match on both posts, as counts for each class of equal posts"""
    return countylines.survey_classes_south(t["sec_file_south"], t["south_corr_rb"], t["south_descr"]).classes


@query
def survey_match_classes_north(t: Inputs) -> DataFrame:
    """The match on begin posts, as counts of distinct rows for each class of equal posts"""
    return countylines.survey_classes_north(t["sec_file_north"], t["north_corr_rb"], t["north_descr"]).classes


@query
def survey_match_members(t: Inputs) -> DataFrame:
    """The survey rows that find a partner, without writing out the match"""
    return countylines.survey_classes_south(t["sec_file_south"], t["south_corr_rb"], t["south_descr"]).members("survey")


@query
def survey_match_unambiguous(t: Inputs) -> DataFrame:
    """The match on begin posts without posts that several corridors have"""
    return countylines.match_survey_north(t["sec_file_north"], t["north_corr_rb"], t["north_descr"], expand=False)


@query
def survey_match_by_corridor(t: Inputs) -> DataFrame:
    """The match on begin posts of a survey that names its corridors"""
    survey = t["sec_file"].withColumnRenamed("svylength2012", "seg_length").withColumn("direction", F.lit("I"))
    return countylines.match_survey_north(survey, t["north_corr_rb"], t["north_descr"], corridor="corridor")


@query
def survey_match_north(t: Inputs) -> DataFrame:
    """C20, J3, A9"""
    return countylines.match_survey_north(t["sec_file_north"], t["north_corr_rb"], t["north_descr"])


@query
def survey_match_south(t: Inputs) -> DataFrame:
    """C20, J3"""
    return countylines.match_survey_south(t["sec_file_south"], t["south_corr_rb"], t["south_descr"])


# --- laboratory ---------------------------------------------------------------------------------------------


def _lab(t: Inputs) -> list[DataFrame]:
    return [t["t_smpl"], t["t_smpl_tst"], t["t_tst_rslt_dtl"], t["t_matl"]]


@query
def lab_rows(t: Inputs) -> DataFrame:
    """C12 (first step), E14, F6, J2, A9"""
    return lab.lab_rows(*_lab(t))


@query
def lab_pivot(t: Inputs) -> DataFrame:
    """C12 with blanks left as they are, A12"""
    return lab.lab_pivot(*_lab(t), blanks_to_null=False)


@query
def lab_pivot_blank_to_null(t: Inputs) -> DataFrame:
    """C12, A12, A13, Q5"""
    return lab.lab_pivot(*_lab(t))


@query
def lab_pivot_numeric(t: Inputs) -> DataFrame:
    """C12 comparing values as numbers"""
    return lab.lab_pivot(*_lab(t), numeric=True)


@query
def lab_conflicts(t: Inputs) -> DataFrame:
    """Q4, F7"""
    return lab.lab_conflicts(lab_rows(t))


@query
def lab_clean(t: Inputs) -> DataFrame:
    """C11, A1, J1, U2"""
    return lab.lab_clean(lab_rows(t))


@query
def lab_clean_by_test(t: Inputs) -> DataFrame:
    """C11 with each test taken as a sample of its own"""
    test = F.concat_ws("/", F.col("smpl_id").cast("string"), "smpl_tst_nbr").alias("smpl_id")
    return lab.lab_clean(lab_rows(t).select(test, "matl_cd", "geog_area_t", *lab.REPORTED))


# --- counties -----------------------------------------------------------------------------------------------


@query
def county_totals(t: Inputs) -> DataFrame:
    """C13, A1, F2"""
    return county.county_totals(t["county_cases"])


@query
def county_dim(t: Inputs) -> DataFrame:
    """C13, A10"""
    return county.county_dimension(t["county_cases"])


@query
def facility_rollup(t: Inputs) -> DataFrame:
    """C14 as published, W6, J10, A3, E8"""
    return county.facility_rollup(t["nursing_homes"])


@query
def facility_rollup_corrected(t: Inputs) -> DataFrame:
    """C14 with plain sums"""
    return county.facility_rollup(t["nursing_homes"], corrected=True)


@query
def county_profile(t: Inputs) -> DataFrame:
    """C15, J1, J5, J14, J16, E4, E18, P3"""
    return county.county_profile(
        county_totals(t), t["county_demo"], t["housing"], t["income_assistance"], t["estimate_disabled"],
        t["median_income"], t["labor_force"], t["labor_industry"],
    )


@query
def county_percents(t: Inputs) -> DataFrame:
    """C15, E8, E18, P1, P7"""
    return county.county_percents(county_profile(t), t["ages_demo"], facility_rollup(t))


@query
def county_preview(t: Inputs) -> DataFrame:
    """C26, P2, P5, P7, O4"""
    return county.county_preview(county_percents(t), t["disability_by_group"])


@query
def county_profile_any_case(t: Inputs) -> DataFrame:
    """Names that differ in case match under a collation"""
    upper = {c: F.upper(c) for c in ("ctyname", "stname")}
    return county.county_profile(
        county_totals(t), t["county_demo"].withColumns(upper), t["housing"], t["income_assistance"], t["estimate_disabled"],
        t["median_income"], t["labor_force"], t["labor_industry"], collation="UTF8_LCASE",
    )


@query
def facility_rollup_lenient(t: Inputs) -> DataFrame:
    """Text that is no number is taken as missing"""
    name = county.FACILITY_COUNTS[0]
    spoiled = F.when(F.col("provider_zip_code") == "7", F.lit("n/a")).otherwise(F.col(name))
    return county.facility_rollup(t["nursing_homes"].withColumn(name, spoiled), corrected=True, lenient=True)


# --- pavement -----------------------------------------------------------------------------------------------


@query
def distress_agg(t: Inputs) -> DataFrame:
    """C16, A1, A2, A5, A8, E3, E19, F8, J13"""
    return pavement.distress_by_corridor(t["distress"])


@query
def distress_agg_as_measured(t: Inputs) -> DataFrame:
    """C16 with each rut average under its own name"""
    return pavement.distress_by_corridor(t["distress"], swapped_ruts=False)


@query
def distress_agg_without_length(t: Inputs) -> DataFrame:
    """Corridors that end at mile 0 have no ratios"""
    ends = F.when(F.col("corridor_r").endswith("0N"), 0.0).otherwise(F.col("to_"))
    return pavement.distress_by_corridor(t["distress"].withColumn("to_", ends), on_zero="null")


@query
def traffic_agg(t: Inputs) -> DataFrame:
    """C16, A1, A2, A8, E12, E16, J13"""
    return pavement.traffic_by_corridor(t["traffic"])


@query
def distress_traffic(t: Inputs) -> DataFrame:
    """C16, J1, F1"""
    return pavement.distress_with_traffic(distress_agg(t), traffic_agg(t))


@query
def iqr_filter(t: Inputs) -> DataFrame:
    """The joined table is written first, as the filter reads it twice"""
    return pavement.without_outliers(materialize(distress_traffic(t)))


@query
def iqr_filter_distress(t: Inputs) -> DataFrame:
    """C17 over distress alone, which keeps more corridors"""
    return pavement.without_outliers(materialize(distress_agg(t)))


@query
def quartile_rows(t: Inputs) -> DataFrame:
    """Exact quartiles by row number of a large column"""
    return ops.rank_quantiles(t["roadlog"].select("nrlg_dept_length_mi"), "nrlg_dept_length_mi", (0.25, 0.5, 0.75))


@query
def length_outliers(t: Inputs) -> DataFrame:
    """C17 on a raw table of many rows"""
    return ops.upper_fence_filter(t["gn_locate"], "gn_km", width=0.2)


# --- single operators ---------------------------------------------------------------------------------------


@query
def key_violations(t: Inputs) -> DataFrame:
    """Q2"""
    return ops.key_violations(gn_locate(t), ["gn_id", "dc_id"])


@query
def unique_index_violations(t: Inputs) -> DataFrame:
    """Q3"""
    return ops.key_violations(t["roadlog"], ["nrlg_dept_route", "nrlg_sys_desc"], allow_null=True)


@query
def blank_values(t: Inputs) -> DataFrame:
    """Q5, E13"""
    cleaned = ops.blank_to_null(t["t_tst_rslt_dtl"], ["tst_strg_fld_val"])
    return cleaned.groupBy("tst_fld_sn").agg(F.count("tst_strg_fld_val").alias("given"), F.count("*").alias("rows"))


@query
def min_scalar_filter(t: Inputs) -> DataFrame:
    """F11, A7"""
    log = t["roadlog"]
    lowest = log.agg(F.min("nrlg_dept_length_mi").alias("v")).scalar()
    return log.where(F.col("nrlg_dept_length_mi") == lowest).groupBy("nrlg_dept_route").agg(F.count("*").alias("n"))


@query
def global_total(t: Inputs) -> DataFrame:
    """Each route's share of all rows"""
    log = t["roadlog"]
    total = log.agg(F.count("*").alias("n")).scalar()
    routes = log.groupBy("nrlg_dept_route").agg(F.count("*").alias("n"))
    return routes.select("nrlg_dept_route", "n", F.lit(total).cast("bigint").alias("total"))


@query
def group_by_expr(t: Inputs) -> DataFrame:
    """A11, A10, J15, E1"""
    corridor = concat_present("nrlg_dept_route", "nrlg_dept_roadbed").alias("corridor")
    return t["roadlog"].groupBy(corridor, "nrlg_smaint").agg(
        F.min("nrlg_dept_length_mi").alias("begmile"), exact_sum(F.col("nrlg_dept_length_mi")).alias("endmile")
    )


@query
def like_forms(t: Inputs) -> DataFrame:
    """F1, F3, F4, F5, F7"""
    name, road = F.col("secfile_name"), F.col("road_van")
    return (
        t["sec_segments"]
        .where(
            (name.startswith("N") | name.contains("ill") | name.endswith("th"))
            & ~name.like("Non%") & (road != "Ant Flat Road") & (F.col("dir") == "I") & (F.col("begin_mi") >= 10)
        )
        .groupBy("secfile_name", "road_van")
        .agg(F.count("*").alias("n"))
    )


@query
def scalar_math(t: Inputs) -> DataFrame:
    """E4, E8, E12, E15, E16"""
    span = F.abs(F.col("begin_mi") - F.col("end_mi"))
    return t["sec_segments"].select(
        "corridor_code_rb", F.ltrim(F.concat(F.lit("  "), "secfile_name")).alias("trimmed"),
        round_half_up(span / F.lit(7.0), 2).alias("seventh"), (F.col("end_mi") / 2).cast("int").alias("half"),
    )


@query
def milepost_numbers(t: Inputs) -> DataFrame:
    """E5, E6, E7, E9"""
    post = F.col("nrlg_milepoint")
    return t["roadlog"].select("nrlg_milepoint").distinct().select(
        "nrlg_milepoint", milepost_to_double(post).alias("mile"),
        milepost_to_double(F.replace(post, F.lit("+0"), F.lit("-"))).alias("behind"),
    )


@query
def star_join(t: Inputs) -> DataFrame:
    """S2, P1, P3, J1"""
    points, coords = t["gn_locate"], t["gn_coords"]
    joined = points.alias("g").join(coords.alias("c"), F.col("g.gn_id") == F.col("c.gn_id"))
    return ops.select_star({"g": points, "c": coords}, joined)


@query
def top_per_group(t: Inputs) -> DataFrame:
    """First and last node per corridor; the order of corridors is given as a rank"""
    order = {"first": F.col("gn_dcmi").asc_nulls_last(), "last": F.col("gn_dcmi").desc_nulls_first()}
    ends = [
        ops.top_per_group(gn_locate_unique(t), ["dc_id"], [by, F.col("gn_id")]).select(
            F.lit(which).alias("which"), "dc_id", "gn_id", "gn_dcmi"
        )
        for which, by in order.items()
    ]
    return ends[0].union(ends[1])


@query
def semi_and_anti(t: Inputs) -> DataFrame:
    """Roadlog rows on listed corridors, without off-system codes"""
    log = t["roadlog"].withColumn("corridor", concat_present("nrlg_dept_route", "nrlg_dept_roadbed"))
    listed = log.join(t["hpms"], F.col("corridor") == F.col("route_id"), "left_semi")
    kept = ops.not_in_present(listed, "nrlg_sys_desc", corridors.OFF_SYSTEM)
    return kept.groupBy("corridor", "nrlg_sys_desc").agg(F.count("*").alias("n"))


@query
def not_in_absent_codes(t: Inputs) -> DataFrame:
    """No listed code occurs, so rows without a code stay"""
    kept = ops.not_in_present(t["roadlog"], "nrlg_sys_desc", ["XXX", "YYY"], check=True)
    return kept.groupBy("nrlg_sys_desc").agg(F.count("*").alias("n"))


@query
def minus_rows(t: Inputs) -> DataFrame:
    """Nulls compare equal"""
    log = t["roadlog"]
    codes = ["nrlg_srf_type", "nrlg_sys_desc", "nrlg_fdist"]
    return ops.minus(log.select(*codes), log.where(F.col("nrlg_smaint") == "Y").where(F.col("nrlg_fdist") > "2").select(*codes))


@query
def minus_then_union(t: Inputs) -> DataFrame:
    """Difference first, then a union that fills in the columns it lacks"""
    left = t["sec_segments"].select("corridor_code_rb", "secfile_name", "lane")
    removed = left.where(F.col("secfile_name") == "North")
    added = t["sec_segments_new_col"].where(F.col("lane") == 2).select("corridor_code_rb", "secfile_name")
    return ops.stack(ops.minus(left, removed), added)


@query
def union_of_twins(t: Inputs) -> DataFrame:
    """A union with itself is a distinct"""
    pairs = t["sec_segments"].select("corridor_code_rb", "secfile_name")
    return ops.stack(pairs, pairs)


@query
def reversed_records(t: Inputs) -> DataFrame:
    """Begin and end swapped"""
    cols = ["corridor_code_rb", "beg_gn", "end_gn", "begin_mi", "end_mi"]
    return ops.reverse_ends(t["sec_segments"].select(*cols), [("beg_gn", "end_gn"), ("begin_mi", "end_mi")])


@query
def conformed(t: Inputs) -> DataFrame:
    """P5: surveyed rows in the segment layout"""
    return ops.conform(t["files_combined"], SEC_SEGMENTS)


@query
def interval_join_inclusive(t: Inputs) -> DataFrame:
    """Segment begins within marker intervals, counted per corridor"""
    segs = t["sec_segments"].select("corridor_code_rb", "begin_mi", "lane")
    hits = ops.interval_join(
        segs, t["ref_marker"].distinct(), ("corridor_code_rb", "dc_id"), "begin_mi", "beg_dcmi", "end_dcmi", bin=10.0, salt=4
    )
    return hits.groupBy("corridor_code_rb").agg(F.count("*").alias("n"), F.max("dc_rm").alias("highest"))


@query
def outer_then_filter(t: Inputs) -> DataFrame:
    """Counties with and without an income figure"""
    joined = county_dim(t).join(t["median_income"], "fips", "left").join(t["income_assistance"], "fips", "left")
    return joined.where(F.col("living_with_income_assistance").isNotNull()).select(
        "fips", "county", "state", "median_income_2_earners", "living_with_income_assistance"
    )


@query
def having_counts(t: Inputs) -> DataFrame:
    """Corridors with at least two located begin nodes"""
    located = t["sec_segments"].select("corridor_code_rb", "beg_gn").join(
        gn_locate_unique(t), (F.col("corridor_code_rb") == F.col("dc_id")) & (F.col("beg_gn") == F.col("gn_id")), "left"
    )
    counted = located.groupBy("corridor_code_rb").agg(F.count("gn_id").alias("located"), F.count("*").alias("rows"))
    return counted.where(F.col("located") > 1)


@query
def preview_segments(t: Inputs) -> DataFrame:
    """A reproducible preview"""
    return ops.preview(t["gn_locate"], 1000, ["gn_id"])
