"""Times the headline queries over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Each figure is the median of ``$BENCH_RUNS`` runs after a warm one, the whole result written to a sink that
discards it. ``--compare`` times the plain forms of some queries next to the ones the library uses.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadweave import build_session  # noqa: E402
from roadweave.checks import queries as q  # noqa: E402
from roadweave.operators import minus  # noqa: E402
from roadweave.plans import corridors, lab, nodes  # noqa: E402
from roadweave.sources.derived import Inputs  # noqa: E402

HEADLINE = [
    "gn_locate_unique", "reference_points", "segment_enriched", "final_dataset", "missing_corridors",
    "corridor_extremes", "section_totals", "maintained_routes", "maintained_hpms", "survey_gap",
    "county_crossings", "county_lines_inside_segments", "survey_match_north", "lab_pivot", "lab_conflicts",
    "lab_clean", "facility_rollup", "county_profile", "distress_traffic", "iqr_filter", "quartile_rows",
]


def seconds(make: Callable[[], DataFrame], runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(runs)), 3)


def plain_forms(t: Inputs) -> dict[str, Callable[[], DataFrame]]:
    """The same results without the library's shortcuts."""

    def unique_by_self_join() -> DataFrame:
        a = q.gn_locate(t)
        b = a.select(F.col("gn_id").alias("g"), F.col("dc_id").alias("d"))
        joined = a.join(b, (F.col("gn_id") == F.col("g")) & (F.col("dc_id") == F.col("d")))
        return joined.groupBy(*a.columns).agg(F.count("*").alias("n")).where("n = 1").drop("n")

    def located_without_bins() -> DataFrame:
        return nodes.unique_nodes(t["gn_locate"], t["tcr_lookup"], t["gn_coords"], bin_km=1e9)

    def dataset_by_difference() -> DataFrame:
        rows = q.segment_enriched(t).where("van_no = 12174")
        kept = rows.where("corridor_code <> 'C901002' and road_van not like '%Ant Flat Road%'")
        forest = t["forest"].where("corridor > 600")
        like = F.expr("corridor_code like concat('C0', cast(corridor as string))")
        return minus(kept, rows.join(forest, like).select(*rows.columns))

    def conflicts_by_self_join() -> DataFrame:
        rows = q.lab_rows(t).select("smpl_id", *lab.COMPARED)
        other = rows.toDF(*(f"o_{c}" for c in rows.columns))
        differs = " or ".join(f"{c} <> o_{c}" for c in lab.COMPARED)
        return rows.join(other, F.expr(f"smpl_id = o_smpl_id and ({differs})")).select("smpl_id").distinct()

    def pivot_by_pivot() -> DataFrame:
        method = F.col("tst_meth") == lab.METHOD
        wide = (
            t["t_tst_rslt_dtl"].where(method & F.col("tst_fld_sn").isin(*lab.CODES))
            .groupBy("smpl_id", "smpl_tst_nbr").pivot("tst_fld_sn", list(lab.MEASURES)).agg(F.max("tst_strg_fld_val"))
        )
        known = t["t_smpl"].join(t["t_matl"], "matl_cd", "left_semi").distinct()
        return wide.join(t["t_smpl_tst"].where(method), ["smpl_id", "smpl_tst_nbr"], "left_semi").join(known, "smpl_id")

    def rollup_by_self_join() -> DataFrame:
        homes = t["nursing_homes"]
        ranked = homes.select(
            F.col("county_fips").alias("fips"),
            F.row_number().over(Window.partitionBy("provider_zip_code").orderBy("county_fips")).alias("i"),
        )
        measures = [c for c in homes.columns if c not in ("county_fips", "provider_zip_code")]
        sums = (F.sum(F.col(c).cast("double")).alias(c) for c in measures)
        return ranked.join(homes, F.col("fips") == F.col("county_fips")).groupBy("county_fips").agg(F.max("i"), *sums)

    def crossings_by_one_window() -> DataFrame:
        route = Window.partitionBy("nrlg_dept_route").orderBy("nrlg_milepoint", "nrlg_county")
        return t["roadlog"].withColumn("n", F.lead("nrlg_county").over(route)).where("nrlg_county <> n")

    def quartiles_by_row_number() -> DataFrame:
        col = F.col("nrlg_dept_length_mi")
        every = Window.partitionBy(F.lit(1))
        ranked = t["roadlog"].select(
            col, F.row_number().over(every.orderBy(col)).alias("i"), F.count("*").over(every).alias("n")
        )
        return ranked.where("i in (floor(n * 0.25), floor(n * 0.5), floor(n * 0.75))")

    return {
        "gn_locate_unique": unique_by_self_join,
        "gn_locate_unique (no bins)": located_without_bins,
        "final_dataset": dataset_by_difference,
        "lab_conflicts": conflicts_by_self_join,
        "lab_pivot": pivot_by_pivot,
        "facility_rollup": rollup_by_self_join,
        "county_crossings": crossings_by_one_window,
        "quartile_rows": quartiles_by_row_number,
    }


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark: SparkSession = build_session(cpus, "roadweave-bench")
    registered, inputs = q.registered(), Inputs(spark, directory)
    names = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE
    if "--compare" in sys.argv:
        for name, make in plain_forms(inputs).items():
            base = name.split(" (")[0]
            if base in names:
                ours = seconds(lambda: registered[base](spark, directory), runs)
                print(f"{name:32s} library {ours:7.3f} s   plain {seconds(make, runs):7.3f} s", flush=True)
        return
    times = {name: seconds(lambda: registered[name](spark, directory), runs) for name in names}
    scale = re.search(r"sf([0-9.]+)", directory)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "spark": spark.version,
                "cpus": int(cpus),
                "driver_memory": spark.conf.get("spark.driver.memory"),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
