"""Corridor inventories: missing corridors, new records, the collection dataset, maintenance and totals
(C7-C10, C21-C25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadweave.functions import concat_present, exact_sum, from_limbs, limbs
from roadweave.operators import conform, minus, not_in_present, numbered, place_of_groups
from roadweave.sources.schemas import SEC_SEGMENTS
from roadweave.sources.tables import materialize

# Code lists and constants of the collection rules.
PAVED = ["PMS", "PCC", "BST", "RMS"]
OFF_SYSTEM = ["OFF", "OUT", "CLO"]
GRAVEL = "GRV"
NOT_RECORDED = ["C003102N", "C000422N", "C000409N"]
VANS = {12174: "North", 12175: "South"}
EXCLUDED_CORRIDOR = "C901002"
EXCLUDED_ROAD = "Ant Flat Road"
FOREST_ABOVE = 600


def missing_corridors(roadlog: DataFrame, segments: DataFrame) -> DataFrame:
    """Paved, on-system corridors of the roadlog that no segment covers."""
    paved = roadlog.where(F.col("nrlg_srf_type").isin(*PAVED))
    listed = not_in_present(paved, "nrlg_sys_desc", OFF_SYSTEM)
    corridors = listed.select(concat_present("nrlg_dept_route", "nrlg_dept_roadbed").alias("corridor_code_rb"))
    return minus(corridors, segments.select("corridor_code_rb"))


def corridor_nodes(corridors: DataFrame, nodes: DataFrame) -> DataFrame:
    """Located nodes of the given corridors (C8, first step). Distinct, as both inputs are."""
    return corridors.join(nodes, F.col("corridor_code_rb") == F.col("dc_id")).select(
        "corridor_code_rb", "gn_id", F.col("gn_dcmi").alias("tis_mi"),
        F.col("tis_xcoord").alias("tis_x"), F.col("tis_ycoord").alias("tis_y"),
    )


def candidate_extremes_literal(candidates: DataFrame) -> DataFrame:
    """Nodes at the lowest mile of all corridors, or at a mile that is some corridor's highest (K5, K6)."""
    lowest = candidates.agg(F.min("tis_mi").alias("mile"))
    highest = candidates.groupBy("corridor_code_rb").agg(F.max("tis_mi").alias("mile")).select("mile")
    miles = lowest.union(highest).distinct()
    return candidates.join(miles, F.col("tis_mi") == F.col("mile"), "left_semi").distinct()


def corridor_ends(nodes: DataFrame, corridor: str, node: str, mile: str, carried: Sequence[str]) -> DataFrame:
    """First and last node of each corridor with the columns in ``carried`` of both (C8, C21), as ``first_*`` and ``last_*``.

    Of several nodes at one mile the lowest id; rows without a mile don't count. ``nodes`` must be unique on
    (corridor, node). Nodes are combined by mile first, then by corridor, and both ends come out of the same pass; every
    buffer is of numbers, so that Spark hashes them.
    """
    lowest = [F.min(node).alias("__node"), *(F.min_by(c, node).alias(f"__{c}") for c in carried)]
    at_mile = nodes.where(F.col(mile).isNotNull()).groupBy(corridor, mile).agg(*lowest)
    ends = []
    for end, bound, by in (("first", F.min, F.min_by), ("last", F.max, F.max_by)):
        ends += [bound(mile).alias(f"{end}_mile"), by("__node", mile).alias(f"{end}_node")]
        ends += [by(f"__{c}", mile).alias(f"{end}_{c}") for c in carried]
    return at_mile.groupBy(corridor).agg(*ends)


def _extremes(ends: DataFrame, x: str, y: str) -> DataFrame:
    return ends.select(
        "corridor_code_rb", F.col("first_node").alias("beg_gn"), F.col("last_node").alias("end_gn"),
        F.col("first_mile").alias("beg_mi"), F.col("last_mile").alias("end_mi"),
        F.col(f"first_{y}").alias("start_lat"), F.col(f"first_{x}").alias("start_lon"),
        F.col(f"last_{y}").alias("end_lat"), F.col(f"last_{x}").alias("end_lon"),
    )


def corridor_extremes(candidates: DataFrame, literal: bool = False) -> DataFrame:
    """First and last node of each corridor (C8); of several nodes at one mile, the lowest id.

    ``literal`` first restricts the candidates as ``candidate_extremes_literal`` does.
    """
    if literal:
        candidates = candidate_extremes_literal(candidates)
    return _extremes(corridor_ends(candidates, "corridor_code_rb", "gn_id", "tis_mi", ["tis_x", "tis_y"]), "tis_x", "tis_y")


def extremes_of(corridors: DataFrame, nodes: DataFrame) -> DataFrame:
    """``corridor_extremes`` of the nodes of some corridors, each named once (C8): the nodes are combined by corridor before
    the corridors are looked up, so that no node is shuffled for that."""
    ends = corridor_ends(nodes, "dc_id", "gn_id", "gn_dcmi", ["tis_xcoord", "tis_ycoord"])
    return _extremes(corridors.join(ends, F.col("corridor_code_rb") == F.col("dc_id")), "tis_xcoord", "tis_ycoord")


def new_corridor_records(
    extremes: DataFrame, roadlog: DataFrame, excluded: Sequence[str] = tuple(NOT_RECORDED)
) -> DataFrame:
    """Segment records of new corridors, one per direction, in the segment layout.

    The roadlog shrinks to its distinct corridor attributes before the join. A corridor whose two directions
    are the same row gives it once.
    """
    attributes = (
        roadlog.where(F.col("nrlg_srf_type") != GRAVEL)
        .select(
            concat_present("nrlg_dept_route", "nrlg_dept_roadbed").alias("roadlog_rb"),
            F.col("nrlg_dept_route").alias("corridor_code"),
            F.col("nrlg_rte_name").alias("road_van"),
            F.col("nrlg_county").alias("county_name"),
            F.col("nrlg_dept_roadbed").alias("rb"),
            F.col("nrlg_srf_type").alias("p"),
            F.col("nrlg_fdist").cast("int").alias("district_no"),
        )
        .where(~F.col("roadlog_rb").isin(*excluded))
        .distinct()
    )
    corridors = extremes.join(attributes, F.col("corridor_code_rb") == F.col("roadlog_rb"))

    def ends(b: str, e: str) -> Column:
        lat, lon = {"beg": "start_lat", "end": "end_lat"}, {"beg": "start_lon", "end": "end_lon"}
        return F.struct(
            F.col(f"{b}_gn").alias("beg_gn"), F.col(f"{e}_gn").alias("end_gn"),
            F.col(f"{b}_mi").alias("frfpost"), F.col(f"{e}_mi").alias("trfpost"),
            F.col(f"{b}_mi").alias("begin_mi"), F.col(f"{e}_mi").alias("end_mi"),
            F.col(lat[b]).alias("start_lat"), F.col(lon[b]).alias("start_lon"),
            F.col(lat[e]).alias("end_lat"), F.col(lon[e]).alias("end_lon"),
        )

    both = F.array_distinct(F.array(ends("beg", "end"), ends("end", "beg")))
    attrs = ["corridor_code_rb", "corridor_code", "road_van", "county_name", "rb", "p", "district_no"]
    records = corridors.select(*attrs, F.explode(both).alias("d")).select(*attrs, "d.*")
    return conform(records, SEC_SEGMENTS)


def forest_codes(forest: DataFrame, above: int = FOREST_ABOVE, pad: int | None = None) -> DataFrame:
    """Corridor codes of forest highways numbered over ``above``; ``pad`` gives the number that many digits at least (K9)."""
    number = F.col("corridor").cast("string")
    if pad is None:
        code = F.concat(F.lit("C0"), number)
    else:  # lpad alone would cut longer numbers down to another corridor's
        code = F.concat(F.lit("C"), F.when(F.length(number) < pad, F.lpad(number, pad, "0")).otherwise(number))
    return forest.where(F.col("corridor") > above).select(code.alias("forest_code")).distinct()


def final_dataset(
    enriched: DataFrame, forest: DataFrame, vans: Sequence[int] = (12174,), pad: int | None = None
) -> DataFrame:
    """Collection dataset of the given vans, without forest and excluded roads.

    Subtracting the rows of forest corridors from the rows of the same view is the same as dropping rows by
    their corridor code, so whole rows are never compared: this is one anti-join against a list of codes. The list is
    written first: where it is small, Catalyst knows so, moves the anti-join below lookups and shuffles no segment for it.
    ``enriched`` must be distinct, as ``enrich_segments`` and ``snap_begin_nodes`` return it.
    """
    collected = enriched.where(
        F.col("van_no").isin(*vans)
        & (F.col("corridor_code") != EXCLUDED_CORRIDOR)
        & ~F.col("road_van").contains(EXCLUDED_ROAD)
    )
    return collected.join(materialize(forest_codes(forest, pad=pad)), F.col("corridor_code") == F.col("forest_code"), "left_anti")


def _delivery() -> list[Column]:
    """By van, section file, corridor, direction downwards, lane and begin mile; nulls last, and first in the descending column."""
    ascending = lambda c: F.col(c).asc_nulls_last()
    return [
        ascending("van_no"), ascending("secfile_name"), ascending("corridor_code_rb"),
        F.col("dir").desc_nulls_first(), ascending("lane"), ascending("begin_mi"),
    ]


def places_in_delivery(dataset: DataFrame) -> DataFrame:
    """Distinct rows, their number ``n`` and the ``place`` of the first of them in the delivery (O1, O2)."""
    return place_of_groups(dataset, _delivery())


def in_delivery_order(dataset: DataFrame) -> DataFrame:
    """Rows with their ``place`` in the order they are handed over (O1, O2): a column, as the order of rows is lost by
    whatever reads them next. For the last step before writing; pipelines never sort on the way (O3)."""
    return numbered(dataset, _delivery())


def final_dataset_with_missing(
    enriched: DataFrame, segments: DataFrame, collected: DataFrame, forest: DataFrame, van: int = 12174
) -> DataFrame:
    """``final_dataset`` plus all segments of corridors the van has in ``segments`` but not in ``collected``.

    ``enriched`` is built from ``collected``. The two parts can't share a row, as their corridors differ.
    """
    of_van = lambda df: df.where(F.col("van_no") == van).select("corridor_code_rb")
    absent = materialize(minus(of_van(segments), of_van(collected)))
    added = segments.join(absent, "corridor_code_rb", "left_semi").select(*segments.columns).distinct()
    return final_dataset(enriched, forest, (van,)).unionByName(added, allowMissingColumns=True)


def section_totals(dataset: DataFrame, vans: Mapping[int, str] = VANS) -> DataFrame:
    """Per section file of each van: increasing lane-1 rows and miles of all rows.

    The section named like the van's own part, and those starting with ``Non``, are left out, as are sections
    with a single such row. One aggregation serves all vans.
    """
    part = F.coalesce(*(F.when(F.col("van_no") == van, F.lit(name)) for van, name in vans.items()))
    counted = F.when((F.col("dir") == "I") & (F.col("lane") == 1), F.col("corridor_code"))
    return (
        dataset.where(F.col("van_no").isin(*vans))
        .withColumn("part", part)
        .where((F.col("secfile_name") != F.col("part")) & ~F.col("secfile_name").startswith("Non"))
        .groupBy("secfile_name", "part")
        .agg(F.count(counted).alias("total"), exact_sum(F.abs(F.col("end_mi") - F.col("begin_mi"))).alias("total_miles"))
        .where(F.col("total") > 1)
        .select("secfile_name", "total", "total_miles", "part")
    )


def maintained_routes(roadlog: DataFrame) -> DataFrame:
    """State-maintained routes with a paved on-system row, and their mile extents.

    Extents cover all rows of the route; the conditions only select routes. So one aggregation answers all.
    """
    kept = (
        F.col("nrlg_sys_desc").isNotNull()
        & ~F.col("nrlg_sys_desc").isin(*OFF_SYSTEM)
        & F.col("nrlg_srf_type").isin(*PAVED)
    )
    return (
        roadlog.where(F.col("nrlg_dept_route").isNotNull())
        .groupBy("nrlg_dept_route")
        .agg(
            F.min("nrlg_dept_length_mi").alias("begmile"),
            exact_sum(F.col("nrlg_dept_length_mi")).alias("endmile"),
            F.max(F.col("nrlg_smaint") == "Y").alias("maintained"),
            F.max(kept).alias("kept"),
        )
        .where(F.col("maintained") & F.col("kept"))
        .select("nrlg_dept_route", "begmile", "endmile")
    )


def maintained_hpms(roadlog: DataFrame, hpms: DataFrame, dataset: DataFrame) -> DataFrame:
    """Mile extents per corridor and maintenance code, for HPMS corridors of the dataset.

    Only paved, on-system rows of routes with state maintenance count; corridors appear in the dataset outside
    the ``North`` section file. The roadlog is read once, into (route, roadbed, maintenance code) groups.
    """
    # Rows without a system code don't count, as some of the listed codes always exist.
    counts = F.col("nrlg_srf_type").isin(*PAVED) & F.coalesce(~F.col("nrlg_sys_desc").isin(*OFF_SYSTEM), F.lit(False))
    length = F.when(F.col("counts"), F.col("nrlg_dept_length_mi"))
    groups = roadlog.withColumn("counts", counts).groupBy("nrlg_dept_route", "nrlg_dept_roadbed", "nrlg_smaint").agg(
        F.min(length).alias("begmile"),
        *(F.sum(limb).alias(f"limb{i}") for i, limb in enumerate(limbs(length))),
        F.max(F.col("counts")).alias("counts"),
    )
    # A route has a handful of such groups, however many rows it has.
    route = Window.partitionBy("nrlg_dept_route")
    groups = groups.withColumn("maintained", F.max(F.col("nrlg_smaint") == "Y").over(route))
    extents = (
        groups.where(
            F.col("maintained") & F.col("counts") & F.col("nrlg_smaint").isNotNull() & F.col("nrlg_dept_route").isNotNull()
        )
        .groupBy(concat_present("nrlg_dept_route", "nrlg_dept_roadbed").alias("corridor_code_rb"), "nrlg_smaint")
        .agg(F.min("begmile").alias("begmile"), from_limbs([F.sum(f"limb{i}") for i in range(len(limbs(F.lit(0.0))))], 9).alias("endmile"))
        .drop("nrlg_smaint")
        .distinct()
    )
    named = dataset.where(F.col("secfile_name") != "North").select("corridor_code_rb").distinct()
    wanted = hpms.select(F.col("route_id").alias("corridor_code_rb")).distinct().join(named, "corridor_code_rb", "left_semi")
    return extents.join(wanted, "corridor_code_rb", "left_semi")


def maintained_or_hpms(dataset: DataFrame, hpms: DataFrame, roadlog: DataFrame) -> DataFrame:
    """Dataset corridors that are state-maintained or on the HPMS list, with their extents."""
    corridors = dataset.where(F.col("secfile_name") != "North").select("corridor_code_rb").distinct()
    listed = hpms.select(F.col("route_id").alias("hpms")).distinct()
    extents = (
        roadlog.where(F.col("nrlg_smaint") == "Y")
        .groupBy(
            concat_present("nrlg_dept_route", "nrlg_dept_roadbed").alias("roadlog"),
            F.col("nrlg_smaint").alias("maintained"), F.col("nrlg_sys_desc").alias("descr"),
        )
        .agg(F.min("nrlg_plan_length_mi").alias("begin_mi"), exact_sum(F.col("nrlg_plan_length_mi")).alias("end_mi"))
    )
    return (
        corridors.join(listed, F.col("corridor_code_rb") == F.col("hpms"), "left")
        .join(extents, F.col("corridor_code_rb") == F.col("roadlog"), "left")
        .where(F.col("hpms").isNotNull() | F.col("maintained").isNotNull())
        .select("corridor_code_rb", "hpms", "roadlog", "maintained", "descr", "begin_mi", "end_mi")
    )


def survey_gap(
    segments: DataFrame, nodes: DataFrame, section: str = "North", surface: str = "Gravel", swap_xy: bool = False
) -> DataFrame:
    """A record from the last surveyed mile to the last node, for corridors where the two differ.

    As in the source data, ``end_lat`` holds the x and ``end_lon`` the y coordinate (K27); ``swap_xy`` puts
    them right. Corridor-level maxima are aggregated before anything is joined.
    """
    surveyed = segments.groupBy("corridor_code_rb").agg(F.max("end_mi").alias("max_end"))
    # Nodes gather per (corridor, mile), so one pass keeps all nodes that share a corridor's last mile.
    at_mile = nodes.where(F.col("gn_dcmi").isNotNull()).groupBy("dc_id", "gn_dcmi").agg(
        F.collect_set(F.struct(F.col("gn_id").alias("node"), "tis_xcoord", "tis_ycoord")).alias("there")
    )
    last = at_mile.groupBy("dc_id").agg(F.max("gn_dcmi").alias("max_mile"), F.max_by("there", "gn_dcmi").alias("there"))
    gaps = (
        surveyed.join(last, F.col("corridor_code_rb") == F.col("dc_id"))
        .where(F.col("max_end") != F.col("max_mile"))
        .select(F.col("dc_id").alias("gap_dc"), "max_end", "max_mile", F.explode("there").alias("n"))
        .select("gap_dc", "max_end", "max_mile", "n.*")
    )
    carried = ["corridor_code_rb", "road_pathweb", "van_no", "corridor_code", "secfile_name", "road_van"]
    chosen = (
        segments.where(
            F.col("secfile_name").contains(section) & (F.col("dir") == "I") & ~F.col("to_descr").contains(surface)
        )
        .select(*carried, "beg_gn")
        .distinct()
    )
    begins = (F.col("corridor_code_rb") == F.col("dc_id")) & (F.col("beg_gn") == F.col("gn_id"))
    located = chosen.join(nodes.select("dc_id", "gn_id"), begins, "left_semi").select(*carried).distinct()
    lat, lon = ("tis_ycoord", "tis_xcoord") if swap_xy else ("tis_xcoord", "tis_ycoord")
    records = located.join(gaps, F.col("corridor_code_rb") == F.col("gap_dc")).select(
        *carried, F.col("node").alias("end_gn"), F.col("max_end").alias("begin_mi"), F.col("max_mile").alias("end_mi"),
        F.col(lat).alias("end_lat"), F.col(lon).alias("end_lon"),
    )
    return conform(records, SEC_SEGMENTS)
