"""Every registered query against its SQL statement, run by DuckDB over the same files."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import rows

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from roadweave.checks import oracle  # noqa: E402
from roadweave.checks.queries import registered  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="test tables are not here")

QUERIES, STATEMENTS = registered(), oracle.sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def test_names_agree():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(driver.queries()) and set(STATEMENTS) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 107


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SMALL))
    statement = duck.sql(STATEMENTS[name])
    kinds = dict(zip(statement.columns, map(str, statement.types)))
    assert {c: TYPES.get(t, t.upper()) for c, t in df.dtypes} == kinds
    order = sorted(df.columns)
    at = [statement.columns.index(c) for c in order]
    expected = sorted(repr(tuple(r[i] for i in at)) for r in statement.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*(f"`{c}`" for c in order)).collect()) == expected
    if name != "key_violations":
        assert expected, "a query without rows shows nothing"


def test_same_rows_with_every_side_shuffled(spark):
    """Broadcasting is a choice of the optimiser; results may not depend on it."""
    names = ["gn_locate_unique", "reference_points", "missing_corridors", "county_lines_inside_segments", "maintained_hpms"]
    broadcast = {n: rows(QUERIES[n](spark, str(SMALL))) for n in names}
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        assert {n: rows(QUERIES[n](spark, str(SMALL))) for n in names} == broadcast
    finally:
        for key in keys:
            spark.conf.unset(key)
