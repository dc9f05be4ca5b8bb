from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadweave.checks.queries import registered
from roadweave.operators import conform
from roadweave.plans import corridors, county, countylines, lab, nodes, pavement
from roadweave.sources.derived import Inputs
from roadweave.sources.schemas import ROADLOG, SEC_SEGMENTS

UNKNOWN = nodes.UNKNOWN_NODE


# --- nodes ------------------------------------------------------------------------------------------------------

ROUTES = "br_id string, beg_abskm double, end_abskm double, beg_brkm double, end_brkm double, beg_tcrkm double, tcr_rt string, tcr_rb string"


@pytest.fixture
def located(frame):
    def run(points, routes, coords):
        return (
            frame("gn_id bigint, route string, gn_km double", points), frame(ROUTES, routes),
            frame("gn_id bigint, x_coord double, y_coord double", coords),
        )

    return run


def test_node_mile_forward_and_backward(located):
    tables = located(
        [(1, "B1", 12.0), (2, "B2", 12.0), (3, "B3", 12.0), (4, "B1", 99.0)],
        [
            ("B1", 10.0, 20.0, 10.0, 20.0, 5.0, "C1", "N"), ("B2", 10.0, 20.0, 20.0, 10.0, 5.0, "C2", None),
            ("B3", 10.0, 20.0, 10.0, 20.0, 5.0, "U1", "N"),
        ],
        [(i, float(i), -float(i)) for i in range(1, 5)],
    )
    assert rows(nodes.locate_nodes(*tables)) == [(1, "C1N", 4.35, 1.0, -1.0), (2, "C2", 8.078, 2.0, -2.0)]


def test_only_unambiguous_nodes_stay(located):
    span = lambda begin: ("B1", 0.0, 50.0, begin, 60.0, 0.0, "C1", "N")
    points, coords = [(1, "B1", 5.0)], [(1, 0.0, 0.0)]
    same = located(points, [span(0.0), span(0.0)], coords)
    assert nodes.unique_nodes(*same).count() == 1
    differing = located(points, [span(0.0), span(1.0)], coords)
    assert nodes.locate_nodes(*differing).count() == 2
    assert nodes.unique_nodes(*differing).count() == nodes.unique_node_keys(nodes.locate_nodes(*differing)).count() == 0


def _segments(frame, data):
    """Segments from dicts of the columns that matter."""
    names = list(data[0])
    kinds = {f.name: f.dataType.simpleString() for f in SEC_SEGMENTS.fields}
    return conform(frame(", ".join(f"{n} {kinds[n]}" for n in names), [tuple(d[n] for n in names) for d in data]), SEC_SEGMENTS)


def test_segment_nodes_with_and_without_unknown_ends(frame):
    segs = _segments(frame, [
        {"corridor_code_rb": "A", "beg_gn": 1, "end_gn": 2},
        {"corridor_code_rb": "A", "beg_gn": 2, "end_gn": UNKNOWN},
        {"corridor_code_rb": "A", "beg_gn": UNKNOWN, "end_gn": 7},
        {"corridor_code_rb": "B", "beg_gn": 1, "end_gn": None},
    ])
    gn = frame("gn_id bigint, dc_id string, gn_dcmi double, tis_xcoord double, tis_ycoord double",
               [(1, "A", 0.5, 1.0, 2.0), (2, "A", 1.5, 3.0, 4.0)])
    found = [("A", 1, 0.5, 1.0, 2.0), ("A", 2, 1.5, 3.0, 4.0)]
    got = rows(nodes.segment_nodes(segs, gn))
    assert got == [found[0], found[1], ("A", UNKNOWN, None, None, None), ("A", None, None, None, None), ("B", None, None, None, None)]
    assert rows(nodes.segment_nodes(segs, gn, strict=True)) == found


def test_reference_points(frame):
    ends = frame("corridor_code_rb string, gn_id bigint, tis_mi double, tis_x double, tis_y double",
                 [("A", 1, 12.623, 0.0, 0.0), ("A", 2, 50.0, 0.0, 0.0), ("A", UNKNOWN, None, None, None), ("A", None, None, None, None)])
    marks = frame("dc_id string, beg_dcmi double, end_dcmi double, dc_rm int", [("A", 12.1, 13.1, 12), ("A", 11.9, 12.9, 11), ("A", 12.1, 13.1, 12)])
    got = rows(nodes.reference_points(ends, marks).select("gn_id", "ref_point"))
    assert got == [(1, " 012+0.523"), (UNKNOWN, None)]


def test_an_unknown_end_with_a_mile_has_both_rows(frame):
    ends = frame("corridor_code_rb string, gn_id bigint, tis_mi double, tis_x double, tis_y double", [("A", UNKNOWN, 1.0, 0.0, 0.0)])
    marks = frame("dc_id string, beg_dcmi double, end_dcmi double, dc_rm int", [("A", 0.5, 2.0, 1)])
    assert rows(nodes.reference_points(ends, marks).select("ref_point")) == [(" 001+0.500",), (None,)]


def test_enriched_segments_are_distinct(frame):
    segs = _segments(frame, [{"corridor_code_rb": "A", "beg_gn": 1, "end_gn": 2}] * 2)
    points = frame("corridor_code_rb string, gn_id bigint, tis_mi double, tis_x double, tis_y double, ref_point string",
                   [("A", 1, 12.6, 7.0, 8.0, " 012+1.250")])
    shown = ["tis_begmi", "tis_endmi", "tis_startx", "tis_endx", "tis_begrp", "tis_endrp"]
    assert rows(nodes.enrich_segments(segs, points).select(*shown)) == [(12.6, None, 7.0, None, 12.25, None)]
    assert nodes.enrich_segments(segs, points, exact=True).first().tis_begrp == 13.25


def test_snap_to_the_node_at_the_begin_mile(frame):
    segs = _segments(frame, [
        {"corridor_code_rb": "A", "beg_gn": 1, "end_gn": 2, "begin_mi": 3.0},
        {"corridor_code_rb": "A", "beg_gn": 9, "end_gn": 2, "begin_mi": 3.0},
        {"corridor_code_rb": "B", "beg_gn": 1, "end_gn": 2, "begin_mi": 3.0},
    ])
    points = frame("corridor_code_rb string, gn_id bigint, tis_mi double, tis_x double, tis_y double, ref_point string", [])
    gn = frame("gn_id bigint, dc_id string, gn_dcmi double", [(9, "A", 3.0), (5, "A", 4.0)])
    got = nodes.snap_begin_nodes(segs, points, gn).select("corridor_code_rb", "beg_gn")
    assert rows(got) == [("A", 9), ("B", 1)]


# --- corridors --------------------------------------------------------------------------------------------------


def _roadlog(frame, data):
    kinds = {f.name: f.dataType.simpleString() for f in ROADLOG.fields}
    names = list(data[0])
    return conform(frame(", ".join(f"{n} {kinds[n]}" for n in names), [tuple(d[n] for n in names) for d in data]), ROADLOG)


def _log(route, rb="N", srf="PMS", sys="PRI", maint="Y", mi=1.0, **more):
    return {
        "nrlg_dept_route": route, "nrlg_dept_roadbed": rb, "nrlg_srf_type": srf, "nrlg_sys_desc": sys,
        "nrlg_smaint": maint, "nrlg_dept_length_mi": mi, "nrlg_plan_length_mi": mi, "nrlg_rte_name": more.get("name"),
        "nrlg_fdist": more.get("district", "1"), "nrlg_county": None, "nrlg_milepoint": None,
    }


def test_missing_corridors(frame):
    log = _roadlog(frame, [
        _log("C1"), _log("C1"), _log("C2", srf="GRV"), _log("C3", sys="OFF"), _log("C4", sys=None), _log("C5", srf=None), _log("C6"),
    ])
    segs = _segments(frame, [{"corridor_code_rb": "C6N"}, {"corridor_code_rb": None}])
    assert rows(corridors.missing_corridors(log, segs)) == [("C1N",)]


MILES = "corridor_code_rb string, gn_id bigint, tis_mi double, tis_x double, tis_y double"


def test_extremes_literal_and_intended(frame):
    miles = frame(MILES, [(c, i, m, 0.0, 0.0) for i, (c, m) in enumerate([("A", 1.0), ("A", 5.0), ("A", 9.0), ("B", 2.0), ("B", 5.0), ("B", 9.5)])])
    show = lambda df: rows(df.select("corridor_code_rb", "beg_mi", "end_mi"))
    assert show(corridors.corridor_extremes(miles)) == [("A", 1.0, 9.0), ("B", 2.0, 9.5)]
    assert show(corridors.corridor_extremes(miles, literal=True)) == [("A", 1.0, 9.0), ("B", 9.5, 9.5)]


def test_extremes_break_ties_by_node(frame):
    miles = frame(MILES, [("A", 3, 1.0, 0.0, 0.0), ("A", 2, 1.0, 0.0, 0.0)])
    assert rows(corridors.corridor_extremes(miles).select("beg_gn", "end_gn")) == [(2, 2)]


def test_new_corridor_has_a_record_per_direction(frame):
    ends = frame(
        "corridor_code_rb string, beg_gn bigint, end_gn bigint, beg_mi double, end_mi double, start_lat double, start_lon double, end_lat double, end_lon double",
        [("C1N", 1, 2, 0.0, 5.0, 10.0, 20.0, 30.0, 40.0), ("C2N", 7, 7, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0), ("C003102N", 1, 2, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0)],
    )
    log = _roadlog(frame, [_log("C1", district="1"), _log("C1", district="01"), _log("C1", srf="GRV"), _log("C2"), _log("C003102")])
    got = corridors.new_corridor_records(ends, log)
    assert got.columns == SEC_SEGMENTS.fieldNames()
    shown = ["corridor_code_rb", "beg_gn", "end_gn", "begin_mi", "end_mi", "start_lat", "start_lon", "end_lat", "end_lon", "district_no"]
    assert rows(got.select(*shown)) == [
        ("C1N", 1, 2, 0.0, 5.0, 10.0, 20.0, 30.0, 40.0, 1), ("C1N", 2, 1, 5.0, 0.0, 30.0, 40.0, 10.0, 20.0, 1),
        ("C2N", 7, 7, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1),
    ]


def test_final_dataset_drops_forest_and_excluded_roads(frame):
    segs = _segments(frame, [
        {"corridor_code": c, "road_van": r, "van_no": v}
        for c, r, v in [
            ("C0601", "x", 12174), ("C0599", "x", 12174), ("C000601", "x", 12174), ("C901002", "x", 12174),
            ("C1", "an Ant Flat Road", 12174), ("C1", None, 12174), (None, "x", 12174), ("C2", "x", 12175),
        ]
    ])
    forest = frame("corridor bigint", [(601,), (599,)])
    assert rows(corridors.final_dataset(segs, forest).select("corridor_code")) == [("C000601",), ("C0599",)]
    assert rows(corridors.final_dataset(segs, forest, pad=6).select("corridor_code")) == [("C0599",), ("C0601",)]


def test_add_back_missing_corridors(frame):
    row = lambda rb, van=12174: {"corridor_code_rb": rb, "van_no": van, "corridor_code": "C1", "road_van": "x"}
    segs = _segments(frame, [row("A"), row("B"), row("B", 12175), row("B"), row("D", 12175)])
    collected = _segments(frame, [row("A")])
    enriched = collected.withColumn("tis_begmi", F.lit(1.0))
    got = corridors.final_dataset_with_missing(enriched, segs, collected, frame("corridor bigint", []))
    assert rows(got.select("corridor_code_rb", "van_no", "tis_begmi")) == [("A", 12174, 1.0), ("B", 12174, None), ("B", 12175, None)]


def test_delivery_order(frame):
    row = lambda dir, lane, mi: {"van_no": 1, "secfile_name": "X", "corridor_code_rb": "A", "dir": dir, "lane": lane, "begin_mi": mi}
    segs = _segments(frame, [row("D", 1, 5.0), row("I", 1, 2.0), row(None, 1, 1.0), row("I", 1, None), row("I", None, 0.0), row("D", 1, 3.0)])
    placed = corridors.in_delivery_order(segs).orderBy("place").collect()
    got = [(r.dir, r.lane, r.begin_mi) for r in placed]
    assert [r.place for r in placed] == [1, 2, 3, 4, 5, 6]
    assert got == [(None, 1, 1.0), ("I", 1, 2.0), ("I", 1, None), ("I", None, 0.0), ("D", 1, 3.0), ("D", 1, 5.0)]


def test_section_totals(frame):
    row = lambda sec, dir, length, van=12174, lane=1: {
        "secfile_name": sec, "dir": dir, "lane": lane, "begin_mi": 0.0, "end_mi": length, "corridor_code": "C", "van_no": van
    }
    data = [
        row("X", "I", 2.0), row("X", "I", 3.0), row("X", "D", -4.0), row("North", "I", 1.0), row("North", "I", 1.0),
        row("Non-System", "I", 1.0), row("Non-System", "I", 1.0), row("Y", "I", 1.0), row("Y", "I", 1.0, lane=2),
        row("North", "I", 1.0, 12175), row("North", "I", 1.0, 12175),
    ]
    assert rows(corridors.section_totals(_segments(frame, data))) == [("North", 2, 2.0, "South"), ("X", 2, 9.0, "North")]


def test_maintained_routes(frame):
    log = _roadlog(frame, [
        _log("C1", mi=2.0), _log("C1", maint="N", sys="OFF", mi=5.0), _log("C2", maint="N"), _log("C3", sys=None), _log("C4", srf="GRV"),
    ])
    assert rows(corridors.maintained_routes(log)) == [("C1", 2.0, 7.0)]


def test_maintained_corridors(frame):
    log = _roadlog(frame, [
        _log("C1", mi=2.0), _log("C1", mi=3.0), _log("C1", maint="N", mi=9.0), _log("C1", sys="OFF", mi=100.0),
        _log("C1", rb="S", maint="N", mi=4.0), _log("C2", maint="N"),
    ])
    data = _segments(frame, [{"corridor_code_rb": c, "secfile_name": s} for c, s in [("C1N", "X"), ("C1S", "North"), ("C2N", "X"), ("C9N", "X")]])
    hpms = frame("route_id string", [("C1N",), ("C1S",), ("C2N",)])
    assert rows(corridors.maintained_hpms(log, hpms, data)) == [("C1N", 2.0, 5.0), ("C1N", 9.0, 9.0)]
    either = corridors.maintained_or_hpms(data, frame("route_id string", [("C2N",)]), log)
    assert rows(either) == [
        ("C1N", None, "C1N", "Y", "OFF", 100.0, 100.0), ("C1N", None, "C1N", "Y", "PRI", 2.0, 5.0), ("C2N", "C2N", None, None, None, None, None),
    ]


def test_survey_gap(frame):
    row = lambda rb, end, **more: {
        "corridor_code_rb": rb, "beg_gn": 1, "end_mi": end, "secfile_name": "North", "dir": "I", "to_descr": "Jct", **more
    }
    segs = _segments(frame, [row("A", 3.0), row("A", 4.0), row("B", 9.0), row("E", 2.0) | {"to_descr": None}])
    gn = frame("gn_id bigint, dc_id string, gn_dcmi double, tis_xcoord double, tis_ycoord double",
               [(n, c, m, float(n), -float(n)) for n, c, m in [(1, "A", 0.0), (2, "A", 6.0), (1, "B", 0.0), (3, "B", 9.0), (1, "E", 0.0), (4, "E", 7.0)]])
    shown = ["corridor_code_rb", "beg_gn", "end_gn", "begin_mi", "end_mi", "end_lat", "end_lon"]
    assert rows(corridors.survey_gap(segs, gn).select(*shown)) == [("A", None, 2, 4.0, 6.0, 2.0, -2.0)]
    assert rows(corridors.survey_gap(segs, gn, swap_xy=True).select("end_lat", "end_lon")) == [(-2.0, 2.0)]


# --- county lines and surveys -----------------------------------------------------------------------------------

POSTS = "nrlg_dept_route string, nrlg_milepoint string, nrlg_county string"


def test_change_points(frame):
    log = frame(POSTS, [("R", "1", "A"), ("R", "2", "A"), ("R", "3", "B"), ("R", "4", None)])
    assert rows(countylines.county_crossings(log)) == [("R", "2", "A", "B")]


def test_change_points_in_text_or_number_order(frame):
    log = frame(POSTS, [("R", "2+0.0", "A"), ("R", "10+0.0", "B")])
    assert rows(countylines.county_crossings(log)) == [("R", "10+0.0", "B", "A")]
    assert rows(countylines.county_crossings(log, numeric=True)) == [("R", "2+0.0", "A", "B")]


def test_county_line_placement(frame):
    lines = frame("nrlg_dept_route string, nrlg_milepoint string, nrlg_county string, next_county string", [("R", "4+1.0", "A", "B")])
    segs = frame("corridor string, corridor_code_rb string, roadway string, frfpost_short double, trfpost_short double, dir string, lane int",
                 [("R", "RN", "x", 6.0, 8.0, "I", 1), ("R", "RN", "x", 4.0, 6.0, "I", 1), ("Q", "QN", "x", 4.0, 9.0, "I", 1)])
    span = lambda df: rows(df.select("beg_mi", "end_mi", "countyline"))
    assert span(countylines.place_county_lines(lines, segs)) == [(4.0, 6.0, 5.0)]
    assert span(countylines.place_county_lines(lines, segs, contains=False)) == [(6.0, 8.0, 5.0)]


def test_survey_matches(frame):
    survey = frame("frfpost double, trfpost double, seg_length double, coll_set string, lane int, direction string",
                   [(1.00004, 2.00004, 5.0, "a", 1, "I")] * 2)
    files = "corridor_code string, corridor_code_rb string, frfpost_short double, trfpost_short double, svylength double"
    texts = "road_van string, from_descr string, to_descr string, frfpost_short double, trfpost_short double, svylength double"
    corr = frame(files, [("C1", "C1N", 1.0, 2.0, 5.3), ("C2", "C2N", 1.0, 7.0, 5.3)])
    descr = frame(texts, [("v", "f", "t", 1.0, 2.0, 5.3)])
    north = countylines.match_survey_north(survey, corr, descr)
    assert rows(north.select("corridor_code", "frfpost_short")) == [("C1", 1.0), ("C2", 1.0)]
    south = countylines.match_survey_south(survey, corr, descr)
    assert rows(south.select("corridor_code", "svylength")) == [("C1", 5.0), ("C1", 5.0)]


def test_survey_match_south_without_posts(frame):
    """Rows without a begin or end post match nothing, not each other either; values with noise count as rounded."""
    survey = frame("frfpost double, trfpost double, seg_length double, coll_set string, lane int, direction string",
                   [(b, e, 5.0, "a", 1, "I") for b, e in ((1.0004, 2.0004), (None, 2.0), (1.0, None), (None, None), (-0.0001, 2.0))])
    files = "corridor_code string, corridor_code_rb string, frfpost_short double, trfpost_short double, svylength double"
    texts = "road_van string, from_descr string, to_descr string, frfpost_short double, trfpost_short double, svylength double"
    posts = [(1.0 + 2e-13, 2.0, 5.3), (None, 2.0, 5.3), (1.0, None, 5.3), (None, None, 5.3), (1.0, 2.0, None), (0.0, 2.0, 5.3), (-0.0, 2.0, 5.3)]
    corr = frame(files, [("C1", "C1N", *p) for p in posts])
    descr = frame(texts, [("v", "f", "t", *p) for p in posts])
    south = countylines.match_survey_south(survey, corr, descr)
    shown = south.select("corridor_code", "road_van", "svylength", "frfpost_short", "trfpost_short")
    assert [repr(r) for r in rows(shown)] == [repr(("C1", "v", 5.0, b, 2.0)) for b in (0.0, 0.0, 0.0, 0.0, 1.0)]


# --- laboratory -------------------------------------------------------------------------------------------------


def _lab(frame, results):
    detail = frame("smpl_id bigint, smpl_tst_nbr string, tst_fld_sn string, tst_strg_fld_val string, tst_meth string",
                   [(s, "1", code, value, lab.METHOD) for s, code, value in results])
    ids = sorted({s for s, _, _ in results})
    return (
        frame("smpl_id bigint, smpl_dt date, matl_cd string, geog_area_t string", [(i, None, "M", "G") for i in ids] * 2),
        frame("smpl_id bigint, smpl_tst_nbr string, tst_meth string", [(i, "1", lab.METHOD) for i in ids] * 2),
        detail, frame("matl_cd string", [("M",), ("M",)]),
    )


def test_lab_pivot(frame):
    tables = _lab(frame, [(1, "44", "9"), (1, "44", "10"), (1, "98", "5"), (1, "98", "3"), (2, "89", "x"), (3, "44", " "), (4, "999", "1")])
    show = lambda **kw: rows(lab.lab_pivot(*tables, **kw).select("smpl_id", "ph", "mg"))
    assert show() == show(most_values=0) and show(blanks_to_null=False) == show(blanks_to_null=False, most_values=0)
    text = lab.lab_pivot(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text
    assert "SortAggregate" in lab.lab_pivot(*tables, most_values=0)._jdf.queryExecution().executedPlan().toString()
    assert show() == [(1, "9", "3"), (2, None, None), (3, None, None)]
    assert show(numeric=True) == [(1, 10.0, 3.0), (2, None, None), (3, None, None)]
    assert show(blanks_to_null=False) == [(1, "9", "3"), (2, None, None), (3, " ", None)]


def test_lab_clean_drops_conflicting_samples(frame):
    wide = frame("smpl_id bigint, matl_cd string, geog_area_t string, ph string, ba string, mg string, assay string",
                 [(1, "M", "G", "7", None, "2", "x"), (1, "N", "G", "8", None, "2", "x"), (2, "M", "G", "7", "1", "3", "x"),
                  (2, "M", "G", None, "1", "3", "y"), (None, "M", "G", "7", None, None, None), (None, "M", "G", "8", None, None, None)])
    names = {"ph": "ph", "ba": "ba", "mg": "mg", "assay": "assay"}
    got = lab.lab_clean(wide, compared=["ph", "ba"], reported=names)
    assert rows(got) == [(2, "M", "G", "7", "1", "3", "y"), (None, "M", "G", "8", None, None, None)]
    assert rows(lab.lab_conflicts(wide, ["ph", "ba"])) == [(1,)]


# --- counties ---------------------------------------------------------------------------------------------------


def test_county_totals(frame):
    cases = frame("fips bigint, county string, state string, cases bigint, deaths bigint",
                  [(1, "A", "S", 5, 1), (1, "A", "S", 9, 0), (None, "B", "S", 7, 7)])
    assert rows(county.county_totals(cases)) == [(1, "A", "S", 9, 1)]
    assert rows(county.county_dimension(cases)) == [(1, "A", "S")]


def test_facility_rollup_literal_and_corrected(frame):
    homes = frame("county_fips int, provider_zip_code string, beds string", [(1, "Z1", "10"), (1, "Z1", "20"), (3, "Z1", "5"), (3, "Z2", "7")])
    for c in county.FACILITY_COUNTS + county.FACILITY_RATES:
        homes = homes.withColumn(c, F.col("beds"))
    shown = ["County_Fips", "Total_Facilities", "Number_of_All_Beds", county.FACILITY_RATES[0]]
    assert rows(county.facility_rollup(homes).select(*shown)) == [(1, 2, 60, 60.0), (3, 3, 24, 24.0)]
    assert rows(county.facility_rollup(homes, corrected=True).select(*shown)) == [(1, 2, 30, 30.0), (3, 2, 12, 12.0)]


def test_facility_text_that_is_no_number(frame):
    homes = frame("county_fips int, provider_zip_code string, beds string", [(1, "Z1", "10"), (1, "Z1", "n/a")])
    for c in county.FACILITY_COUNTS + county.FACILITY_RATES:
        homes = homes.withColumn(c, F.col("beds"))
    assert county.facility_rollup(homes, corrected=True, lenient=True).first().Number_of_All_Beds == 10
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        county.facility_rollup(homes).collect()


def test_county_names_may_differ_in_case(frame):
    totals = frame("fips bigint, county string, state string, max_cases bigint, max_deaths bigint", [(1, "Lake", "MT", 5, 1)])
    demo = frame("ctyname string, stname string, tot_pop bigint, tot_male bigint, tot_female bigint", [("LAKE", "Mt", 10, 1, 2)])
    housing = frame("county string, state string, housingunits bigint", [("lake", " mt", 3)])
    income = frame("fips bigint, living_with_income_assistance bigint", [(1, 7)])
    none = [frame(f"fips bigint, {c} double", []) for c in ("d", "median_income_2_earners", "in_labor_force", "s")]
    run = lambda **kw: county.county_profile(totals, demo, housing, income, *none, **kw)
    assert run().count() == 0
    assert rows(run(collation="UTF8_LCASE").select("county", "state", "housingunits")) == [("Lake", "MT", 3)]


def test_county_profile_needs_an_income_figure(frame):
    totals = frame("fips bigint, county string, state string, max_cases bigint, max_deaths bigint", [(i, c, "S", 5, 1) for i, c in [(1, "A"), (2, "B"), (3, "C")]])
    demo = frame("ctyname string, stname string, tot_pop bigint, tot_male bigint, tot_female bigint", [(c, "S", 3000, 1, 2) for c in "ABC"])
    housing = frame("county string, state string, housingunits bigint", [(c, "  S", 10) for c in "AB"] + [("C", "T", 10)])
    income = frame("fips bigint, living_with_income_assistance bigint", [(1, 7), (2, None), (3, 7)])
    disabled, industry = frame("fips bigint, d bigint", [(1, 4)]), frame("fips bigint, s double", [])
    median = frame("fips bigint, median_income_2_earners double", [])
    labor = frame("fips bigint, in_labor_force double", [(1, 50.0)])
    got = county.county_profile(totals, demo, housing, income, disabled, median, labor, industry)
    assert rows(got.select("fips", "positives_per_100_000", "median_income_2_earners", "in_labor_force", "s", "d")) == [
        (1, 166.67, None, 50.0, None, 4)
    ]


def test_preview_layout(frame):
    percents = frame("Fips bigint, `Construction (Percent)` double, `Deaths_Per_100,000` double", [(2, 1.5, 2.5), (1, 0.5, 3.5)])
    groups = ", ".join(f"{county.disability_column(g)} double" for g in county.DISABLED_GROUPS)
    disability = frame(f"fips bigint, {groups}", [(2, *[9.0] * 8), (1, *[k / 2 for k in range(8)]), (3, *[1.0] * 8)])
    got = county.county_preview(percents, disability, n=1)
    assert rows(got.select(*map(county.disability_column, county.DISABLED_GROUPS))) == [tuple(k / 2 for k in range(8))]
    assert county.county_preview(percents, disability.where("fips = 3")).select("With_a_disability_Asian_Percent").distinct().count() == 1
    assert len(got.columns) == 129 and got.columns == county.PREVIEW_COLUMNS
    assert rows(got.select("Fips", "Construction_Percent", "Deaths_Per_100_000", "NCHS_Code")) == [(1, 0.5, 3.5, None)]


# --- pavement ---------------------------------------------------------------------------------------------------


def test_distress(frame):
    distress = frame(
        "corridor_r string, from_ double, to_ double, lane int, rut_l_avg double, rut_r_avg double, alligb_med double, alligb_hig double",
        [("C000015N", 1.0, 4.0, 1, 0.1, 0.5, 500.0, 0.0), ("C000015N", 4.0, 10.0, 1, 0.3, 0.7, 28.0, 528.0),
         ("C000015N", 0.0, 99.0, 2, 9.0, 9.0, 9.0, 9.0), ("C000600N", 1.0, 4.0, 1, 0.1, 0.5, 500.0, 0.0)],
    )
    assert rows(pavement.distress_by_corridor(distress)) == [("C000015N", 1.0, 10.0, 528.0, 528.0, 1.0, 1.0, 0.2, 0.6)]
    named = pavement.distress_by_corridor(distress, swapped_ruts=False).first()
    assert (named.left_rut_avg, named.right_rut_avg) == (0.2, 0.6)


def test_traffic_without_a_sum_is_dropped(frame):
    traffic = frame("corridorrb string, begmi double, endmi double, tyc_aadt bigint, tyc_commercial bigint, tyc_large_truck bigint",
                    [("C000001N", 0.0, 4.0, 10, 2, 1), ("C000001N", 4.0, 8.0, 30, None, 1), ("C000002N", 0.0, 4.0, 10, None, 1), ("C000700N", 0.0, 4.0, 1, 1, 1)])
    assert rows(pavement.traffic_by_corridor(traffic)) == [("C000001N", 5.0, 40, 2.0, 2.0, 0.25, 0.25)]


def test_distress_with_traffic_conditions(frame):
    left = frame("corridor_r string, endmi double, allig_b_high_ratio double", [("C000015N", 9.0, 1.0), ("A", 4.0, 1.0), ("B", 9.0, 0.0), ("D", 9.0, 1.0), ("E", 9.0, 1.0)])
    right = frame("corridorrb string, aadt_per_mile double, sum_aadt bigint, sum_commercial double, sum_large_truck double, large_truck_ratio double, commercial_ratio double",
                  [(c, 1.0, 1, 1.0, 1.0, 1.0, 1.0) for c in ("C000015N", "A", "B", "D")])
    assert rows(pavement.distress_with_traffic(left, right).select("corridor_r")) == [("D",)]


def test_long_forest_numbers_keep_their_digits(frame):
    forest = frame("corridor bigint", [(1234567,), (700,), (600,)])
    assert rows(corridors.forest_codes(forest, pad=6)) == [("C000700",), ("C1234567",)]


def test_published_column_orders(frame, spark):
    t = Inputs(spark, "/root/testdata/sf0.001")
    south = countylines.match_survey_south(t["sec_file_south"], t["south_corr_rb"], t["south_descr"])
    north = countylines.match_survey_north(t["sec_file_north"], t["north_corr_rb"], t["north_descr"])
    assert south.columns[5:8] == ["coll_set", "direction", "lane"] and north.columns[5:8] == ["coll_set", "lane", "direction"]
    assert county.facility_rollup(t["nursing_homes"]).columns[-5:] == [*county.FACILITY_RATES, *county.FACILITY_COUNTS[18:]]


def test_survey_match_by_corridor_and_ambiguous_posts(frame):
    survey = frame("frfpost double, trfpost double, seg_length double, coll_set string, lane int, direction string, c string",
                   [(1.0, 2.0, 5.0, "a", 1, "I", "C2"), (3.0, 4.0, 6.0, "a", 1, "I", "C1")])
    files = "corridor_code string, corridor_code_rb string, frfpost_short double, trfpost_short double, svylength double"
    texts = "road_van string, from_descr string, to_descr string, frfpost_short double, trfpost_short double, svylength double"
    corr = frame(files, [("C1", "C1N", 1.0, 2.0, 5.3), ("C2", "C2N", 1.0, 2.0, 5.3), ("C1", "C1N", 3.0, 4.0, 6.3)])
    descr = frame(texts, [("v", "f", "t", 1.0, 2.0, 5.3), ("v", "f", "t", 3.0, 4.0, 6.3)])
    for match, digits, ends in ((countylines.match_survey_north, 4, False), (countylines.match_survey_south, 3, True)):
        codes = lambda **k: sorted(r.corridor_code for r in match(survey, corr, descr, **k).collect())
        assert codes() == ["C1", "C1", "C2"] and codes(corridor="c") == ["C1", "C2"] and codes(expand=False) == ["C1"]
        assert [r.corridors for r in countylines.ambiguous_posts(corr, digits, ends).collect()] == [2]


def test_inputs_that_can_show_a_fault(spark):
    """Facilities meet their counties, some samples conflict and some don't, some offsets are over ten miles."""
    t = Inputs(spark, "/root/testdata/sf0.01")
    preview = registered()["county_preview"](spark, "/root/testdata/sf0.01")
    filled = preview.agg(*(F.count(f"`{c}`").alias(c) for c in preview.columns)).first()
    assert all(filled), [c for c in preview.columns if not filled[c]]
    assert preview.where("County_Fips is not null and Number_of_All_Beds is not null").count() > 50
    samples = registered()["lab_rows"](spark, "/root/testdata/sf0.01").select("smpl_id").distinct().count()
    assert 0 < registered()["lab_conflicts"](spark, "/root/testdata/sf0.01").count() < samples
    points = registered()["reference_points"](spark, "/root/testdata/sf0.01")
    assert points.where("cast(substring_index(ref_point, '+', -1) as double) >= 10").count() > 0
    assert t["roadlog"].where("nrlg_dept_length_mi <> floor(nrlg_dept_length_mi)").count() > 0


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_sums_do_not_depend_on_partitions(spark, parts):
    log = Inputs(spark, "/root/testdata/sf0.001")["roadlog"].withColumn("nrlg_dept_length_mi", F.col("nrlg_dept_length_mi") / 7)
    log = log.withColumn("nrlg_dept_route", F.lit("C1"))
    spread = corridors.maintained_routes(log.repartition(parts, "nrlg_milepoint"))
    assert rows(spread) == rows(corridors.maintained_routes(log))


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_nodes_and_points_are_computed_once(spark):
    """Scans in the plan, after the tables that the query writes first: at most half of those without."""
    for name, most in (("segment_enriched", 6), ("survey_gap", 6), ("final_dataset", 7), ("final_dataset_addback", 12), ("corridor_extremes_literal", 12)):
        assert scans(registered()[name](spark, "/root/testdata/sf0.001")) <= most, name
