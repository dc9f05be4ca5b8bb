"""Every registered query over the small tables: with its SQL statement where there is one."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as driver  # noqa: E402
from roadweave.llm.oracle import SQL  # noqa: E402
from roadweave.llm.queries import QUERIES  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="test tables are not here")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
FIRST = {
    2: "doc_id keep_id group_size kept text_sha256", 3: "page_id url text n_chars", 4: "doc_id size source_size target taken",
    5: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    6: "doc_id size text_crc32 law shard slot grown_shard", 7: "doc_id n_tokens ids_sha256 decoded_sha256",
    8: "doc_id start n_tokens ids_crc32", 9: "doc_id held_out lang_pred score", 10: "doc_id n_shingles component_id kept",
    11: "word form root n n_near form_n", 12: "query_id rank vec_id score",
    13: "anchor_id positive_id rank negative_id positive_score negative_score",
}


def test_all_are_registered():
    assert {**QUERIES, "pipeline": None}.keys() <= driver.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_whole_table_in_contract_columns(spark, name):
    df = QUERIES[name](spark, str(SMALL))
    n = int(name[2:].split("_")[0])
    assert df.columns[: len(FIRST.get(n, "doc_id").split())] == FIRST.get(n, "doc_id").split()
    if n > 10:  # not a row for each row; compared as wholes elsewhere
        assert df.count()
        return
    table = "pages" if n == 3 else "documents"
    key = df.columns[0]
    want = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in df.select(key).collect()) == want


@pytest.mark.parametrize("name", SQL)
def test_statement(spark, name):
    duck = duckdb.connect()
    for file in SMALL.glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from '{file}'")
    df = QUERIES[name](spark, str(SMALL))
    statement = duck.sql(SQL[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(statement.columns, map(str, statement.types)))
    order = sorted(df.columns)
    at = [statement.columns.index(c) for c in order]
    expected = sorted(repr(tuple(r[i] for i in at)) for r in statement.fetchall())
    assert sorted(repr(tuple(r)) for r in df.select(*order).collect()) == expected and expected
