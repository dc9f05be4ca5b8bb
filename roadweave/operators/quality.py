"""Uniqueness, key and conflict checks.

Each is one aggregation: partial results are combined before the shuffle, so a key that holds a large
share of all rows reaches its task as a handful of partial rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def keep_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs exactly once; rows with a null in the key are dropped (Q1)."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.where(_all([F.col(k).isNotNull() for k in keys])).groupBy(*keys)
    counted = grouped.agg(F.count(F.lit(1)).alias("__n"), *(F.first(c).alias(c) for c in rest))
    return counted.where(F.col("__n") == 1).select(*df.columns)


def keep_unambiguous(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key whose rows are all alike; keys with two different rows, or a null, are dropped.

    The same as ``keep_unique(df.distinct(), keys)``, without the extra shuffle of whole rows.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.where(_all([F.col(k).isNotNull() for k in keys])).groupBy(*keys)
    aggs = [F.count(F.lit(1)).alias("__n")]
    alike = [F.lit(True)]
    for i, c in enumerate(rest):
        aggs += [F.min(c).alias(c), F.max(c).alias(f"__hi{i}"), F.count(c).alias(f"__n{i}")]
        alike.append(
            F.col(c).eqNullSafe(F.col(f"__hi{i}")) & F.col(f"__n{i}").isin(F.lit(0), F.col("__n"))
        )
    return grouped.agg(*aggs).where(_all(alike)).select(*df.columns)


def key_violations(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Keys that break a primary key: repeated, or holding a null (Q2).

    With ``allow_null`` a null counts as a value like any other, as in a unique index (Q3).
    """
    repeated = F.col("row_count") > 1
    null_key = F.lit(False) if allow_null else _any([F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(repeated | null_key)


def assert_key(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> None:
    """Raise ``ValueError`` naming a few offending keys. This runs the query."""
    bad = key_violations(df, keys, allow_null).limit(5).collect()
    if bad:
        raise ValueError(f"key {tuple(keys)} violated, for example {[tuple(r) for r in bad]}")


def conflicting_keys(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Keys with two different non-null values in any of ``cols`` (Q4)."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"__lo{i}"), F.max(c).alias(f"__hi{i}")]
    differs = _any([F.col(f"__lo{i}") != F.col(f"__hi{i}") for i in range(len(cols))])
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs).where(differs).select(key)


def blank_to_null(df: DataFrame, cols: Sequence[str], blank: str = " ") -> DataFrame:
    """Replace blank text by null in the given columns (Q5)."""
    return df.withColumns({c: F.when(~F.col(c).isin(blank, ""), F.col(c)) for c in cols})
