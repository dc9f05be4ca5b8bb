"""The input tables, derived from the generic test tables.

The statements run unchanged in Spark SQL and in other engines, so a check elsewhere starts from the same
rows. Names in braces are the tables a statement reads. Fact tables are whole. A few lookups lack keys, so that
outer joins and anti-joins have something to miss: three county figures lack the counties named in their statements,
and ``surveyed_corridors`` lacks the corridors whose number ends in 7.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from roadweave.plans.county import (
    AGE_BANDS,
    DISABLED_AGES,
    DISABLED_GROUPS,
    FACILITY_COUNTS,
    FACILITY_RATES,
    INDUSTRY,
    POPULATION_GROUPS,
    disability_column,
    disabled_column,
)
from roadweave.sources.schemas import layout
from roadweave.sources.tables import load

# The columns used of each test table; a scan reads no others.
BASE = {
    "lineitem": layout(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    ),
    "orders": layout("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"),
    "part": layout("p_partkey bigint, p_size int"),
    "customer": layout("c_custkey bigint, c_nationkey int, c_acctbal double"),
    "nation": layout("n_nationkey int, n_name string"),
    "events": layout("event_id bigint, user_id bigint, event_type string, value double"),
}



def _code(number: str, letter: str = "'C'") -> str:
    """A letter and a number of six digits or more; padding alone would cut longer numbers."""
    text = f"cast({number} as string)"
    return f"{letter}||case when length({text})<6 then lpad({text},6,'0') else {text} end"


_CORRIDOR = _code("l_suppkey")
_FIPS = "c_nationkey*100+c_custkey%5"


def _short(expr: str, digits: int) -> str:
    return f"cast(round(cast({expr} as decimal(28,{digits + 6})),{digits}) as double)"


def _list(columns: Iterable[tuple[str, str]]) -> str:
    return ", ".join(f"{expr} as {name}" for expr, name in columns)


def _survey(status: str) -> str:
    return (
        "select l_extendedprice/997 as frfpost, l_extendedprice/997+l_quantity/10 as trfpost, l_quantity as seg_length, "
        "l_returnflag as coll_set, l_linenumber as lane, case l_linenumber%2 when 0 then 'D' else 'I' end as direction "
        f"from {{lineitem}} where l_linestatus='{status}'"
    )


def _corridor_files(digits: int) -> str:
    return (
        f"select distinct {_CORRIDOR} as corridor_code, {_CORRIDOR}||'N' as corridor_code_rb, "
        f"{_short('l_extendedprice/997', digits)} as frfpost_short, "
        f"{_short('l_extendedprice/997+l_quantity/10', digits)} as trfpost_short, l_quantity+0.3e0 as svylength "
        "from {lineitem}"
    )


def _descriptions(digits: int) -> str:
    return (
        "select 'RT '||l_returnflag as road_van, 'Jct '||cast(l_partkey%50 as string) as from_descr, "
        "'Jct '||cast(l_partkey%50+1 as string) as to_descr, "
        f"{_short('l_extendedprice/997', digits)} as frfpost_short, "
        f"{_short('l_extendedprice/997+l_quantity/10', digits)} as trfpost_short, l_quantity+0.3e0 as svylength "
        "from {lineitem}"
    )


# Values of a laboratory's users that disagree, and those that don't.
_DISAGREES = "user_id%3=0"

DERIVED: dict[str, str] = {
    "roadlog": f"""
select {_CORRIDOR} as nrlg_dept_route,
  case l_linestatus when 'O' then 'N' else 'S' end as nrlg_dept_roadbed,
  cast(l_partkey%100+1 as string)||case when l_linenumber%3=0 then '-0.' else '+0.' end
    ||lpad(cast(cast(l_quantity as int)*10+l_linenumber as string),4,'0') as nrlg_milepoint,
  'COUNTY_'||cast(cast(floor((l_partkey%100)/10.0) as int) as string) as nrlg_county,
  case l_linenumber when 1 then 'PMS' when 2 then 'PCC' when 3 then 'BST' when 4 then 'RMS' when 5 then 'GRV'
    when 6 then 'PMS' else 'UNP' end as nrlg_srf_type,
  case l_partkey%6 when 0 then 'OFF' when 1 then 'OUT' when 2 then 'CLO' when 3 then cast(null as string)
    when 4 then 'PRI' else 'SEC' end as nrlg_sys_desc,
  case l_returnflag when 'R' then 'Y' else 'N' end as nrlg_smaint,
  'RT '||l_returnflag as nrlg_rte_name, cast(l_suppkey%5+1 as string) as nrlg_fdist,
  l_quantity+(l_partkey%1000)/1000e0 as nrlg_dept_length_mi, l_quantity+(l_partkey%7)/10e0 as nrlg_plan_length_mi
from {{lineitem}}""",
    "gn_locate": """
select o_orderkey as gn_id, 'B'||cast(o_custkey%100 as string) as route,
  cast(floor(o_totalprice) as double)/1000 as gn_km
from {orders}""",
    "tcr_lookup": """
select 'B'||cast(p_partkey%100 as string) as br_id, p_size*10e0 as beg_abskm, p_size*10e0+25 as end_abskm,
  p_size*10e0 as beg_brkm, case when p_partkey%2=0 then p_size*10e0+25 else p_size*10e0-25 end as end_brkm,
  cast(p_size as double) as beg_tcrkm,
  """ + _code("p_partkey%100", "case when p_size%5=0 then 'U' else 'C' end") + """ as tcr_rt, 'N' as tcr_rb
from {part}""",
    "gn_coords": """
select o_orderkey as gn_id, -115+(o_custkey%100)/10e0 as x_coord, 44+(o_orderkey%50)/10e0 as y_coord
from {orders}""",
    "ref_marker": f"""
select {_code('p_partkey%100')}||'N' as dc_id,
  case when p_partkey%100<30 then floor(p_size/25e0)*25e0 else cast(p_size as double) end as beg_dcmi,
  case when p_partkey%100<30 then floor(p_size/25e0)*25e0+25 else p_size+9e0 end as end_dcmi,
  case when p_partkey%100<30 then cast(floor(p_size/25e0)*25 as int) else p_size end as dc_rm
from {{part}}""",
    "ref_marker_source": f"""
select dc_id, beg_dcmi, end_dcmi, dc_rm, beg_dcmi*1.609344e0 as beg_dckm, end_dcmi*1.609344e0 as end_dckm,
  cast('2015-05-15 00:00:00' as timestamp) as updt, substr(dc_id,1,7) as dc_rt, substr(dc_id,8) as dc_rb,
  case when dc_rm%2=0 then 'Y' else 'N' end as rm_virtual, cast(null as string) as alias_rmdc
from {{ref_marker}}""",
    "sec_segments": f"""
select {_code('o_custkey%100')}||'N' as corridor_code_rb, cast(null as string) as road_pathweb,
  case when l_linestatus='O' then 12174 else 12175 end as van_no, l_orderkey as beg_gn,
  case when l_linenumber=7 then 999999999999 else l_orderkey+1 end as end_gn,
  'C0'||cast(600+o_custkey%100 as string) as corridor_code,
  case l_suppkey%4 when 0 then 'North' when 1 then 'South' when 2 then 'Non-System' else 'Billings' end as secfile_name,
  cast(null as string) as county_name, cast(null as int) as district_no,
  case when l_partkey%97=0 then 'Ant Flat Road' else 'RT '||l_returnflag end as road_van,
  cast(null as string) as from_descr,
  case when l_partkey%13=0 then 'Gravel end' else 'Jct RT '||l_returnflag end as to_descr,
  cast(null as double) as frfpost, cast(null as double) as trfpost,
  l_quantity as begin_mi, l_quantity+l_linenumber+(l_partkey%100)/1000e0 as end_mi,
  case l_linenumber%2 when 0 then 'D' else 'I' end as dir, cast(null as double) as svyleng2012,
  l_linenumber%3+1 as lane, cast(null as string) as rb, cast(null as double) as start_lat,
  cast(null as double) as start_lon, cast(null as double) as end_lat, cast(null as double) as end_lon,
  cast(null as string) as p
from {{lineitem}} join {{orders}} on l_orderkey=o_orderkey""",
    "surveyed_corridors": """
select corridor_code_rb from {sec_segments} where corridor_code_rb not like '%7N'""",
    "sec_segments_new_col": """
select * from {sec_segments}
where not (van_no=12174 and corridor_code_rb='C000003N') and not (van_no=12175 and corridor_code_rb='C000004N')""",
    "forest": "select distinct p_partkey%100+600 as corridor from {part} where p_partkey%100%7=0",
    "forest_raw": """
select case when p_partkey%2=0 then '0' else '' end||cast(p_partkey%100+600 as string) as tfh_route
from {part}""",
    "hpms": f"select distinct {_CORRIDOR}||'N' as route_id from {{lineitem}} where l_suppkey%2=0",
    "sec_file": f"""
select {_CORRIDOR} as corridor, 'RT '||l_returnflag as roadway, l_extendedprice/997 as frfpost,
  l_extendedprice/997+l_quantity/10 as trfpost, l_quantity as svylength2012, l_linenumber as lane,
  l_linestatus as coll_set, 'COUNTY_'||cast(l_partkey%10 as string) as county_name
from {{lineitem}}""",
    "files_combined": f"""
select distinct {_CORRIDOR} as corridor_code, {_CORRIDOR}||'N' as corridor_code_rb, l_quantity+0.3e0 as svyleng2012,
  {_short('l_extendedprice/997', 3)} as frfpost, case l_linenumber%2 when 0 then 'D' else 'I' end as dir
from {{lineitem}}""",
    "sec_file_north": _survey("O"),
    "sec_file_south": _survey("F"),
    "north_corr_rb": _corridor_files(4),
    "south_corr_rb": _corridor_files(3),
    "north_descr": _descriptions(4),
    "south_descr": _descriptions(3),
    "t_smpl": """
select distinct user_id as smpl_id, cast('2024-01-01' as date) as smpl_dt, 'M'||cast(user_id%5 as string) as matl_cd,
  'G'||cast(user_id%7 as string) as geog_area_t
from {events}""",
    "t_tst_rslt_dtl": f"""
select user_id as smpl_id, cast(event_id%3 as string) as smpl_tst_nbr, cast(23+3*(event_id%29) as string) as tst_fld_sn,
  case when not ({_DISAGREES}) then cast(user_id%50+event_id%29 as string) when event_id%17=0 then ' '
    else cast(cast(floor(value) as int) as string) end as tst_strg_fld_val,
  case when event_type='error' then 'OTHER' else '000MCIG000' end as tst_meth
from {{events}}""",
    "t_smpl_tst": """
select distinct user_id as smpl_id, cast(event_id%3 as string) as smpl_tst_nbr,
  case when event_type='error' then 'OTHER' else '000MCIG000' end as tst_meth
from {events}""",
    "t_matl": "select distinct 'M'||cast(user_id%5 as string) as matl_cd from {events}",
    "county_cases": f"""
select {_FIPS} as fips, 'CTY_'||cast(c_custkey%5 as string) as county, n_name as state,
  cast(floor(o_totalprice) as bigint) as cases, cast(floor(o_totalprice/50) as bigint) as deaths
from {{orders}} join {{customer}} on o_custkey=c_custkey join {{nation}} on n_nationkey=c_nationkey""",
    "county_demo": f"""
select 'CTY_'||cast(c_custkey%5 as string) as ctyname, n_name as stname, count(*)*1000 as tot_pop,
  count(*)*490 as tot_male, count(*)*510 as tot_female, {_list(
      (f"count(*)*{20 + 7 * i + 3 * j}+c_custkey%5", f"{code}_{sex}")
      for i, code in enumerate(POPULATION_GROUPS) for j, sex in enumerate(("male", "female"))
  )}
from {{customer}} join {{nation}} on c_nationkey=n_nationkey group by n_name, c_custkey%5""",
    "housing": """
select 'CTY_'||cast(c_custkey%5 as string) as county, '  '||n_name as state, count(*)*300 as housingunits
from {customer} join {nation} on c_nationkey=n_nationkey group by n_name, c_custkey%5""",
    "income_assistance": f"""
select {_FIPS} as fips,
  case when c_nationkey%4=0 then cast(null as bigint) else count(*)*25 end as living_with_income_assistance
from {{customer}} group by c_nationkey, c_custkey%5""",
    "estimate_disabled": f"""
select {_FIPS} as fips, {_list(
      (f"count(*)*{5 + i}+c_nationkey", disabled_column(sex, age))
      for i, (sex, age) in enumerate((s, a) for s in ("Male", "Female") for a in DISABLED_AGES)
  )}
from {{customer}} group by c_nationkey, c_custkey%5""",
    "disability_by_group": f"""
select {_FIPS} as fips, {_list(
      (f"cast((count(*)*{3 + i}+c_nationkey)%200 as double)/10e0", disability_column(group)) for i, group in enumerate(DISABLED_GROUPS)
  )}
from {{customer}} group by c_nationkey, c_custkey%5 having {_FIPS} not in (101, 1403)""",
    "median_income": f"""
select {_FIPS} as fips, cast(count(*)*1000 as double) as median_income_2_earners
from {{customer}} group by c_nationkey, c_custkey%5 having {_FIPS} not in (3, 104, 1702)""",
    "labor_force": f"""
select {_FIPS} as fips, cast(count(*)%100 as double) as in_labor_force
from {{customer}} group by c_nationkey, c_custkey%5 having {_FIPS} not in (4, 200, 1203, 2401)""",
    "labor_industry": f"""
select {_FIPS} as fips, {_list(
      (f"cast((count(*)*{i + 1})%100 as double)", name) for i, name in enumerate(INDUSTRY)
  )}
from {{customer}} group by c_nationkey, c_custkey%5""",
    "ages_demo": f"""
select {_FIPS} as fips, cast(c_nationkey%6+1 as bigint) as NCHS_Code, {_list(
      (f"cast((count(*)*{i + 1})%100 as double)/10e0", name) for i, name in enumerate(AGE_BANDS)
  )}
from {{customer}} group by c_nationkey, c_custkey%5""",
    "nursing_homes": f"""
select {_FIPS} as county_fips, cast(c_custkey%37 as string) as provider_zip_code, {_list(
      [(f"cast(cast(floor(c_acctbal) as int)+{i} as string)", name) for i, name in enumerate(FACILITY_COUNTS)]
      + [(f"cast(cast(floor(c_acctbal) as int)+{i} as string)||'.5'", name) for i, name in enumerate(FACILITY_RATES)]
  )}
from {{customer}}""",
    "distress": f"""
select {_code('l_suppkey*15')}||'N' as corridor_r, l_quantity as from_, l_quantity+1 as to_,
  l_linenumber%2+1 as lane, l_discount as rut_l_avg, l_tax as rut_r_avg,
  cast(l_extendedprice as decimal(18,2)) as alligb_med,
  cast(cast(l_extendedprice as decimal(18,2))*cast(round(l_discount*100) as int)
    *(case when l_suppkey%20=3 then 10 else 1 end) as decimal(18,2)) as alligb_hig
from {{lineitem}}""",
    "traffic": f"""
select {_code('o_custkey%100*15')}||'N' as corridorrb, o_custkey%50 as begmi,
  o_custkey%50+5 as endmi, cast(floor(o_totalprice) as bigint) as tyc_aadt,
  case when o_orderstatus='F' then cast(null as bigint) else cast(floor(o_totalprice/10) as bigint) end as tyc_commercial,
  cast(floor(o_totalprice/20) as bigint) as tyc_large_truck
from {{orders}}""",
}


# The key of a fact table that a statement joins by, and how many of its rows go to one task of the join, about.
DEALT = {"sec_segments": ("lineitem", "l_orderkey")}
TASK_ROWS = 1 << 18


def reads(name: str) -> list[str]:
    """The tables a derived table is made from."""
    return sorted({field for _, field, _, _ in string.Formatter().parse(DERIVED[name]) if field})


class Inputs:
    """Input tables over one directory of test data, as lazy frames: ``inputs["roadlog"]``."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE:
            return load(self.spark, self.directory, name, BASE[name])
        tables = {t: self[t] for t in reads(name)}
        if name in DEALT:
            table, key = DEALT[name]
            tables[table] = self._dealt(tables[table], key)
        return self.spark.sql(DERIVED[name], **tables)

    def _dealt(self, table: DataFrame, key: str) -> DataFrame:
        """The table by its join key in partitions of ``TASK_ROWS``, where the session's number of partitions gives larger ones.

        What follows in the same tasks (sorting, making wide rows distinct) then needs no more memory for a larger table.
        The rows are counted from the file footers.
        """
        parts = math.ceil(table.count() / TASK_ROWS)
        return table.repartition(parts, key) if parts > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else table


def as_ctes(names: Iterable[str]) -> list[str]:
    """The named derived tables, and those they read, as ``WITH`` entries in order of dependency."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in BASE or name in done:
            return
        for table in reads(name):
            add(table)
        done[name] = f"{name} as ({DERIVED[name].format(**{t: t for t in reads(name)}).strip()})"

    for name in names:
        add(name)
    return list(done.values())
