"""Nodes on corridors: located, made unambiguous, attached to segment ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions import concat_present, km_to_mi, reference_point, reference_point_to_number
from roadweave.operators import interval_join, interval_sides, keep_unambiguous, keep_unique, lookup_ends
from roadweave.sources.tables import materialize

# Fixed value: the node id that marks an unknown segment end.
UNKNOWN_NODE = 999_999_999_999

_NODE = ["gn_id", "dc_id", "gn_dcmi", "tis_xcoord", "tis_ycoord"]


def _placed(points: DataFrame, routes: DataFrame, coords: DataFrame, system: str, bin_km: float) -> DataFrame:
    """One row per node and covering route interval; repeats are left in for the aggregation that follows.

    Coordinates are joined first, on the node id. When the route table is small enough to be broadcast, all
    later grouping by node then reuses that one shuffle. Equal route intervals can only repeat a result, so
    they are removed before they multiply the points.
    """
    lookup = (
        routes.where(F.col("tcr_rt").startswith(system))
        .select(
            "br_id", "beg_abskm", "end_abskm", "beg_brkm", "end_brkm", "beg_tcrkm",
            concat_present("tcr_rt", "tcr_rb").alias("dc_id"),
        )
        .distinct()
    )
    located = points.select("gn_id", "route", "gn_km").join(coords.select("gn_id", "x_coord", "y_coord"), "gn_id")
    hits = interval_join(
        located, lookup, key=("route", "br_id"), at="gn_km", lo="beg_abskm", hi="end_abskm", bin=bin_km
    )
    ahead = F.col("beg_brkm") < F.col("end_brkm")
    along = F.when(ahead, F.col("gn_km") - F.col("beg_brkm")).otherwise(F.col("beg_brkm") - F.col("gn_km"))
    return hits.select(
        "gn_id", "dc_id", km_to_mi(along + F.col("beg_tcrkm")).alias("gn_dcmi"),
        F.col("x_coord").alias("tis_xcoord"), F.col("y_coord").alias("tis_ycoord"),
    )


def locate_nodes(
    points: DataFrame, routes: DataFrame, coords: DataFrame, system: str = "C", bin_km: float = 25.0
) -> DataFrame:
    """Corridor, mile and coordinates of every node, from its kilometre on a base route.

    A route interval whose end lies before its begin is measured backwards. Only corridors of the given
    ``system`` letter count. ``bin_km`` should be near the usual interval length.
    """
    return _placed(points, routes, coords, system, bin_km).distinct()


def unique_nodes(
    points: DataFrame, routes: DataFrame, coords: DataFrame, system: str = "C", bin_km: float = 25.0
) -> DataFrame:
    """Nodes with exactly one place on their corridor (C2): ``locate_nodes`` and the check in one aggregation."""
    return keep_unambiguous(_placed(points, routes, coords, system, bin_km), ["gn_id", "dc_id"])


def unique_node_keys(nodes: DataFrame) -> DataFrame:
    """Node and corridor of nodes that occur once, as a key table (C2, keyed form)."""
    return keep_unique(nodes.select("gn_id", "dc_id"), ["gn_id", "dc_id"])


def segment_nodes(
    segments: DataFrame, nodes: DataFrame, unknown: int = UNKNOWN_NODE, strict: bool = False
) -> DataFrame:
    """Distinct begin and end nodes per corridor, with their mile and coordinates.

    An end without a located node gives one row of nulls for its corridor; a corridor with an ``unknown`` end
    also gets a row for it. ``strict`` keeps located nodes only. ``nodes`` must be unique on (gn_id, dc_id).

    Both ends are stacked and made distinct first, so segments are read once and shuffled as (corridor, node).
    """
    ends = segments.select("corridor_code_rb", F.explode(F.array("beg_gn", "end_gn")).alias("end")).distinct()
    on = (F.col("corridor_code_rb") == F.col("dc_id")) & (F.col("end") == F.col("gn_id"))
    joined = ends.join(nodes.select(*_NODE), on, "inner" if strict else "left")
    found = F.struct(
        F.col("gn_id"), F.col("gn_dcmi").alias("tis_mi"),
        F.col("tis_xcoord").alias("tis_x"), F.col("tis_ycoord").alias("tis_y"),
    )
    if strict:
        return joined.select("corridor_code_rb", found.alias("n")).select("corridor_code_rb", "n.*")
    nothing = F.lit(None).cast("double")
    marker = F.struct(
        F.lit(unknown).cast("bigint").alias("gn_id"),
        nothing.alias("tis_mi"), nothing.alias("tis_x"), nothing.alias("tis_y"),
    )
    rows = F.when(F.col("end") == unknown, F.array(found, marker)).otherwise(F.array(found))
    return joined.select("corridor_code_rb", F.explode(rows).alias("n")).select("corridor_code_rb", "n.*").distinct()


def reference_points(
    end_nodes: DataFrame, markers: DataFrame, unknown: int = UNKNOWN_NODE, bin_mi: float = 10.0
) -> DataFrame:
    """Reference point of every segment end that some marker interval covers (C4).

    The marker is the highest of those covering the mile, the offset the smallest; each is taken on its own
    (K8). Unknown ends are kept, without a reference point. ``end_nodes`` must be distinct.
    """
    lookup = markers.select("dc_id", "beg_dcmi", "end_dcmi", "dc_rm").distinct()
    key = ["corridor_code_rb", "gn_id", "tis_mi", "tis_x", "tis_y"]
    sides = interval_sides(
        end_nodes.where((F.col("gn_id") == unknown) | F.col("tis_mi").isNotNull()),
        lookup, key=("corridor_code_rb", "dc_id"), at="tis_mi", lo="beg_dcmi", hi="end_dcmi", bin=bin_mi,
    )
    # An end without a marker comes once per level of buckets; the aggregation counts it once.
    covered = sides.points.join(sides.intervals, sides.on, "left")
    points = covered.groupBy(*key).agg(
        F.count("dc_id").alias("n"),
        F.max("dc_rm").alias("marker"),
        F.min(F.col("tis_mi") - F.col("beg_dcmi")).alias("offset"),
    )
    none = F.lit(None).cast("string")
    text = F.when(F.col("n") > 0, reference_point(F.col("marker"), F.col("offset")))
    # An unknown end keeps its row without a reference point, besides any it was given.
    texts = F.when(F.col("gn_id") == unknown, F.array_distinct(F.array(text, none))).otherwise(F.array(text))
    kept = points.where((F.col("n") > 0) | (F.col("gn_id") == unknown))
    return kept.select(*key, F.explode(texts).alias("ref_point"))


def enrich_segments(segments: DataFrame, points: DataFrame, exact: bool = False) -> DataFrame:
    """Distinct segments with mile, coordinates and numeric reference point of both ends.

    ``points`` is the result of ``reference_points``. Segments become distinct before the lookups, while they
    are narrow; as the lookup rows are distinct, the result is distinct too.
    """
    numbered = points.withColumn("rp", reference_point_to_number(F.col("ref_point"), exact)).drop("ref_point")
    looked_up = lookup_ends(
        segments.distinct(), numbered, "corridor_code_rb", "gn_id",
        {
            "beg_gn": {"tis_mi": "tis_begmi", "tis_x": "tis_startx", "tis_y": "tis_starty", "rp": "tis_begrp"},
            "end_gn": {"tis_mi": "tis_endmi", "tis_x": "tis_endx", "tis_y": "tis_endy", "rp": "tis_endrp"},
        },
    )
    return looked_up.select(*segments.columns, *END_COLUMNS)


# The columns both enrichments add, in order.
END_COLUMNS = [
    "tis_begmi", "tis_endmi", "tis_startx", "tis_starty", "tis_endx", "tis_endy", "tis_begrp", "tis_endrp",
]


def snap_begin_nodes(segments: DataFrame, points: DataFrame, nodes: DataFrame) -> DataFrame:
    """Enriched segments whose begin node is replaced by another node lying exactly at the begin mile.

    Several such nodes give several rows (K30). The looked-up columns still belong to the original begin
    node, and the reference points stay text. ``nodes`` must be unique on (gn_id, dc_id).

    Segments become distinct first, and are written once their ends are looked up. Only those at a node's mile can become
    equal to each other, so no other segment is shuffled for the snapping or compared again.
    """
    points = points.select("corridor_code_rb", "gn_id", "tis_mi", "tis_x", "tis_y", "ref_point").distinct()
    looked_up = lookup_ends(
        segments.distinct(), points, "corridor_code_rb", "gn_id",
        {
            "beg_gn": {"tis_mi": "tis_begmi", "tis_x": "tis_startx", "tis_y": "tis_starty", "ref_point": "tis_begrp"},
            "end_gn": {"tis_mi": "tis_endmi", "tis_x": "tis_endx", "tis_y": "tis_endy", "ref_point": "tis_endrp"},
        },
    )
    columns = [*segments.columns, *END_COLUMNS]
    looked_up = materialize(looked_up.select(*columns))
    mile = ["corridor_code_rb", "begin_mi"]
    here = nodes.select(F.col("dc_id").alias("corridor_code_rb"), F.col("gn_dcmi").alias("begin_mi"), F.col("gn_id").alias("snap_gn"))
    here = materialize(here.join(looked_up.select(*mile).distinct(), mile, "left_semi"))
    others = here.select(F.col("snap_gn"), F.col("corridor_code_rb").alias("snap_dc"), F.col("begin_mi").alias("snap_mi"))
    on = (
        (F.col("corridor_code_rb") == F.col("snap_dc"))
        & (F.col("begin_mi") == F.col("snap_mi"))
        & (F.col("snap_gn") != F.col("beg_gn"))
    )
    at_node = looked_up.join(here, mile, "left_semi").select(*columns)
    snapped = at_node.join(others, on, "left").withColumn("beg_gn", F.coalesce("snap_gn", "beg_gn"))
    elsewhere = looked_up.join(here, mile, "left_anti").select(*columns)
    return elsewhere.union(snapped.select(*columns).distinct())
