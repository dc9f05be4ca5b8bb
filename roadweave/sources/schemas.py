"""Declared layouts of the input tables. Types are never inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "decimal(18,2)": DecimalType(18, 2),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
}


def layout(columns: str) -> StructType:
    """A schema from ``"name type, name type"``; unlike ``StructType.fromDDL`` this needs no running session."""
    fields = (column.split() for column in columns.split(", "))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


ROADLOG = layout(
    "nrlg_dept_route string, nrlg_dept_roadbed string, nrlg_milepoint string, nrlg_county string, "
    "nrlg_srf_type string, nrlg_sys_desc string, nrlg_smaint string, nrlg_rte_name string, "
    "nrlg_fdist string, nrlg_dept_length_mi double, nrlg_plan_length_mi double"
)
GN_LOCATE = layout("gn_id bigint, route string, gn_km double")
TCR_LOOKUP = layout(
    "br_id string, beg_abskm double, end_abskm double, beg_brkm double, end_brkm double, "
    "beg_tcrkm double, tcr_rt string, tcr_rb string"
)
GN_COORDS = layout("gn_id bigint, x_coord double, y_coord double")
REF_MARKER = layout(
    "dc_id string, beg_dcmi double, end_dcmi double, dc_rm int, beg_dckm double, end_dckm double, "
    "updt timestamp, dc_rt string, dc_rb string, rm_virtual string, alias_rmdc string"
)
SEC_SEGMENTS = layout(
    "corridor_code_rb string, road_pathweb string, van_no int, beg_gn bigint, end_gn bigint, "
    "corridor_code string, secfile_name string, county_name string, district_no int, road_van string, "
    "from_descr string, to_descr string, frfpost double, trfpost double, begin_mi double, end_mi double, "
    "dir string, svyleng2012 double, lane int, rb string, start_lat double, start_lon double, "
    "end_lat double, end_lon double, p string"
)
FOREST_RAW = layout("tfh_route string")
FOREST = layout("corridor bigint")
HPMS = layout("route_id string")
SEC_FILE = layout(
    "corridor string, roadway string, frfpost double, trfpost double, svylength2012 double, lane int, "
    "coll_set string, county_name string"
)
FILES_COMBINED = layout(
    "corridor_code string, corridor_code_rb string, svyleng2012 double, frfpost double, dir string"
)
COUNTYLINE_MILAGE = layout("nrlg_dept_route string, nrlg_milepoint string, nrlg_county string, next_county string")
SEC_FILE_PART = layout(
    "frfpost double, trfpost double, seg_length double, coll_set string, lane int, direction string"
)
FILES_CORR_RB = layout(
    "corridor_code string, corridor_code_rb string, frfpost_short double, trfpost_short double, svylength double"
)
FILES_ROADWAY_DESCR = layout(
    "road_van string, from_descr string, to_descr string, frfpost_short double, trfpost_short double, "
    "svylength double"
)
T_SMPL = layout("smpl_id bigint, smpl_dt date, matl_cd string, geog_area_t string")
T_SMPL_TST = layout("smpl_id bigint, tst_meth string, smpl_tst_nbr string")
T_TST_RSLT_DTL = layout(
    "smpl_id bigint, smpl_tst_nbr string, tst_meth string, tst_fld_sn string, tst_strg_fld_val string"
)
T_MATL = layout("matl_cd string")
COUNTY_CASES = layout("fips bigint, county string, state string, cases bigint, deaths bigint")
HOUSING = layout("county string, state string, housingunits bigint")
INCOME_ASSISTANCE = layout("fips bigint, living_with_income_assistance bigint")
DISTRESS = layout(
    "corridor_r string, from_ double, to_ double, lane int, rut_l_avg double, rut_r_avg double, "
    "alligb_med decimal(18,2), alligb_hig decimal(18,2)"
)
TRAFFIC = layout(
    "corridorrb string, begmi double, endmi double, tyc_aadt bigint, tyc_commercial bigint, tyc_large_truck bigint"
)
