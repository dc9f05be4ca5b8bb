"""Projections and set operations over whole rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Bring ``df`` to a layout: its columns in order and cast, absent ones as typed nulls (P5)."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def select_star(parts: dict[str, DataFrame], joined: DataFrame) -> DataFrame:
    """All columns of several aliased frames, a repeated name prefixed by its alias.

    ``parts`` maps the alias used in ``joined`` to the frame it stands for.
    """
    seen: set[str] = set()
    out = []
    for alias, frame in parts.items():
        for name in frame.columns:
            target = name if name not in seen else f"{alias}_{name}"
            seen.add(target)
            out.append(F.col(f"{alias}.`{name}`").alias(target))
    return joined.select(*out)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to letters, digits and single underscores."""
    names = [re.sub(r"_+", "_", re.sub(r"\W", "_", c)).strip("_") for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after cleaning: {names}")
    return df.toDF(*names)


def reverse_ends(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Swap each pair of columns, e.g. begin and end of a segment."""
    swap = {**dict(pairs), **{b: a for a, b in pairs}}
    return df.select(*(F.col(swap.get(c, c)).alias(c) for c in df.columns))


def minus(df: DataFrame, other: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``other``, nulls comparing equal (U2); columns are taken by position.

    One aggregation over both sides: a row stays if it never comes from ``other``. Repeats are combined before the one
    shuffle, on either side.
    """
    sides = df.withColumn("__other", F.lit(0)).union(other.withColumn("__other", F.lit(1)))
    return sides.groupBy(*df.columns).agg(F.max("__other").alias("__other")).where(F.col("__other") == 0).select(*df.columns)


def stack(df: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct union by name; columns an input lacks become null."""
    for other in others:
        df = df.unionByName(other, allowMissingColumns=True)
    return df.distinct()
