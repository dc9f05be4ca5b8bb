"""Laboratory results: rows of (sample, code, value) to one row per sample, and conflicting samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadweave.functions import blank_as_null
from roadweave.operators import conflicting_keys, value_codes

# Test method, and the field code of each measure. Code 89 is accepted but names no measure.
METHOD = "000MCIG000"
MEASURES = {
    "23": "assay",
    "26": "effectiveness_pns_score",
    "29": "pns_blank",
    "32": "pns_nacl",
    "35": "settable_solids",
    "38": "settable_solids_temp",
    "41": "percent_pass_10m",
    "44": "ph",
    "47": "as_",
    "50": "ba",
    "53": "cd",
    "56": "cr",
    "59": "cu",
    "62": "pb",
    "65": "hg",
    "68": "se",
    "71": "zn",
    "74": "cn",
    "77": "p",
    "80": "s",
    "83": "sulfate",
    "86": "phosphate",
    "92": "k",
    "95": "ca",
    "98": "mg",
    "101": "nitrite",
    "104": "nitrate",
    "107": "chloride",
}
UNNAMED_CODE = "89"
CODES = [*MEASURES, UNNAMED_CODE]
# Reported per sample; the temperature is not.
REPORTED = [m for m in MEASURES.values() if m != "settable_solids_temp"]
# The one measure reported by its lowest value (K11), and those never compared for conflicts.
BY_LOWEST = "mg"
NOT_COMPARED = ["assay", "s"]
COMPARED = [m for m in REPORTED if m not in NOT_COMPARED]
MOST_VALUES = 65_536  # distinct values that are compared by their rank


def _accepted(results: DataFrame, tests: DataFrame) -> DataFrame:
    """Results of the method and codes that belong to a registered test of the same method."""
    registered = tests.where(F.col("tst_meth") == METHOD).select("smpl_id", "smpl_tst_nbr")
    chosen = results.where((F.col("tst_meth") == METHOD) & F.col("tst_fld_sn").isin(*CODES))
    return chosen.join(registered, ["smpl_id", "smpl_tst_nbr"], "left_semi")


def _value() -> Column:
    return F.nullif(F.col("tst_strg_fld_val"), F.lit(""))


def _of_code(code: str) -> Column:
    return F.when(F.col("tst_fld_sn") == code, _value())


def lab_rows(samples: DataFrame, tests: DataFrame, results: DataFrame, materials: DataFrame) -> DataFrame:
    """One distinct row per result, its value in the column of its measure (C12, first step; E14, F6, J2)."""
    spread = _accepted(results, tests).select(
        "smpl_id", "smpl_tst_nbr", *(_of_code(code).alias(name) for code, name in MEASURES.items())
    )
    known = samples.join(materials, "matl_cd", "left_semi")
    return (
        spread.join(known, "smpl_id")
        .select("smpl_dt", "matl_cd", "geog_area_t", "smpl_id", "smpl_tst_nbr", *MEASURES.values())
        .distinct()
    )


def lab_pivot(
    samples: DataFrame,
    tests: DataFrame,
    results: DataFrame,
    materials: DataFrame,
    blanks_to_null: bool = True,
    numeric: bool = False,
    most_values: int = MOST_VALUES,
) -> DataFrame:
    """One row per sample and test, one column per measure.

    Values are text: of several, the last in text order is reported, so ``'9'`` beats ``'10'`` (K15);
    ``numeric`` compares numbers instead. A test with only the unnamed code still gives a row, of nulls (K13).
    Results are aggregated to their wide rows in one shuffle, before anything else is joined.

    Text buffers can't be hashed, so texts are compared by their rank among the distinct values, as numbers, and read back
    at the end. The distinct values are written and counted first; where there are more than ``most_values`` (or they
    are longer than a broadcast should be) the texts are aggregated as they are, by sorting.
    """

    chosen = results.where((F.col("tst_meth") == METHOD) & F.col("tst_fld_sn").isin(*CODES))
    names = {code: name for code, name in MEASURES.items() if name in REPORTED}
    bound = lambda name, value: (F.min if name == BY_LOWEST else F.max)(value).alias(name)
    dictionary = None if numeric else value_codes(chosen.select(_value().alias("value")), "value", most_values)
    if numeric:
        number = F.nullif(F.trim(_value()), F.lit("")).cast("double")
        aggregates = [bound(name, F.when(F.col("tst_fld_sn") == code, number)) for code, name in names.items()]
    elif dictionary is None:
        aggregates = [bound(name, _of_code(code)) for code, name in names.items()]
    else:
        chosen = chosen.join(F.broadcast(dictionary.codes), _value() == F.col("value"), "left")
        aggregates = [bound(name, F.when(F.col("tst_fld_sn") == code, F.col("code"))) for code, name in names.items()]
    wide = chosen.groupBy("smpl_id", "smpl_tst_nbr").agg(*aggregates)
    if dictionary is not None:
        wide = dictionary.values(wide, list(names.values()))
    if blanks_to_null and not numeric:
        wide = wide.withColumns({name: blank_as_null(F.col(name)) for name in names.values()})
    registered = tests.where(F.col("tst_meth") == METHOD).select("smpl_id", "smpl_tst_nbr")
    # A sample listed with several dates is one group; several materials or areas are several.
    known = samples.join(materials, "matl_cd", "left_semi").select("smpl_id", "matl_cd", "geog_area_t").distinct()
    return (
        wide.join(registered, ["smpl_id", "smpl_tst_nbr"], "left_semi")
        .join(known, "smpl_id")
        .select("smpl_id", "smpl_tst_nbr", "matl_cd", "geog_area_t", *REPORTED)
    )


def lab_conflicts(rows: DataFrame, compared: Sequence[str] = tuple(COMPARED)) -> DataFrame:
    """Samples with two different values in a compared measure."""
    return conflicting_keys(rows, "smpl_id", compared)


def lab_clean(
    rows: DataFrame,
    compared: Sequence[str] = tuple(COMPARED),
    reported: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per sample, material and area, without the samples in conflict (C11).

    ``reported`` maps measure columns to their output names. Rows are collapsed first, keeping the lowest and
    highest value per measure; a sample conflicts when the lowest of all differs from the highest of all. So
    the full rows are shuffled once, and the conflict check only sees collapsed rows. Subtracting the rows of
    conflicting samples equals dropping them by sample; rows without a sample id can't conflict and stay.
    """
    names = dict(reported) if reported else {m: m for m in REPORTED}
    bounds = [f(c).alias(f"__{n}_{c}") for c in {**names, **dict.fromkeys(compared)} for n, f in (("lo", F.min), ("hi", F.max))]
    collapsed = rows.groupBy("smpl_id", "matl_cd", "geog_area_t").agg(*bounds)
    spans = collapsed.where(F.col("smpl_id").isNotNull()).groupBy(F.col("smpl_id").alias("bad_id")).agg(
        *(F.min(f"__lo_{c}").alias(f"__l_{c}") for c in compared), *(F.max(f"__hi_{c}").alias(f"__h_{c}") for c in compared)
    )
    differs = F.lit(False)
    for c in compared:
        differs = differs | F.coalesce(F.col(f"__l_{c}") != F.col(f"__h_{c}"), F.lit(False))
    bad = spans.where(differs).select("bad_id")
    values = [F.col(f"__{'lo' if c == BY_LOWEST else 'hi'}_{c}").alias(name) for c, name in names.items()]
    return collapsed.join(bad, F.col("smpl_id") == F.col("bad_id"), "left_anti").select(
        "smpl_id", "matl_cd", "geog_area_t", *values
    )
