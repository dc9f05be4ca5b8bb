"""Pavement distress and traffic per corridor, joined, without outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.functions import corridor_number, divide, length_ratio_pct, round_half_up
from roadweave.operators import upper_fence_filter

# Which corridors and rows the comparison covers.
NUMBERED_BELOW = 600
DISTRESS_LANE = 1
LEFT_OUT = "C000015N"
LONGER_THAN = 4


def distress_by_corridor(distress: DataFrame, swapped_ruts: bool = True, on_zero: str = "error") -> DataFrame:
    """Extent, cracking and rutting per corridor numbered below 600.

    Only lane 1 counts. Ratios divide by the last mile, not the length (K21). As in the source data, the left
    rut average is named right and the right one left (K20); ``swapped_ruts=False`` names them as measured.
    """
    left, right = ("right_rut_avg", "left_rut_avg") if swapped_ruts else ("left_rut_avg", "right_rut_avg")
    feet = lambda c: F.sum(c).cast("double")
    return (
        distress.where((F.col("lane") == DISTRESS_LANE) & (corridor_number(F.col("corridor_r")) < NUMBERED_BELOW))
        .groupBy("corridor_r")
        .agg(
            F.min("from_").alias("beginmi"), F.max("to_").alias("endmi"),
            feet("alligb_med").alias("med"), feet("alligb_hig").alias("high"),
            F.avg("rut_l_avg").alias("rut_l"), F.avg("rut_r_avg").alias("rut_r"),
        )
        .where(F.col("beginmi").isNotNull())
        .select(
            "corridor_r", "beginmi", "endmi",
            round_half_up(F.col("med"), 3).alias("alligb_med_ft"),
            round_half_up(F.col("high"), 3).alias("alligb_high_ft"),
            length_ratio_pct(F.col("med"), F.col("endmi"), on_zero).alias("allig_b_med_ratio"),
            length_ratio_pct(F.col("high"), F.col("endmi"), on_zero).alias("allig_b_high_ratio"),
            round_half_up(F.col("rut_l"), 3).alias(left),
            round_half_up(F.col("rut_r"), 3).alias(right),
        )
    )


def traffic_by_corridor(traffic: DataFrame, on_zero: str = "error") -> DataFrame:
    """Traffic sums per corridor numbered below 600, and per mile of its last mile."""
    per_mile = lambda c, digits: round_half_up(divide(F.col(c), F.col("last"), on_zero), digits)
    return (
        traffic.where(corridor_number(F.col("corridorrb")) < NUMBERED_BELOW)
        .groupBy("corridorrb")
        .agg(
            F.sum("tyc_aadt").alias("sum_aadt"), F.max("endmi").alias("last"),
            F.sum("tyc_commercial").alias("commercial"), F.sum("tyc_large_truck").alias("large_truck"),
        )
        .where(F.col("commercial").isNotNull() & F.col("large_truck").isNotNull())
        .select(
            "corridorrb", per_mile("sum_aadt", 3).alias("aadt_per_mile"), "sum_aadt",
            round_half_up(F.col("commercial"), 3).alias("sum_commercial"),
            round_half_up(F.col("large_truck"), 3).alias("sum_large_truck"),
            per_mile("large_truck", 5).alias("large_truck_ratio"),
            per_mile("commercial", 5).alias("commercial_ratio"),
        )
    )


def distress_with_traffic(distress: DataFrame, traffic: DataFrame) -> DataFrame:
    """Both aggregates side by side, for corridors with high-severity cracking that end beyond mile 4."""
    chosen = distress.where(
        (F.col("corridor_r") != LEFT_OUT) & (F.col("endmi") > LONGER_THAN) & (F.col("allig_b_high_ratio") > 0)
    )
    return chosen.join(traffic, F.col("corridor_r") == F.col("corridorrb")).select(
        *distress.columns, "sum_aadt", "aadt_per_mile", "sum_commercial", "sum_large_truck",
        "commercial_ratio", "large_truck_ratio",
    )


def without_outliers(joined: DataFrame, col: str = "allig_b_high_ratio") -> DataFrame:
    """Rows below the upper quartile fence (C17). ``joined`` is read twice: pass a written table."""
    return upper_fence_filter(joined, col)
