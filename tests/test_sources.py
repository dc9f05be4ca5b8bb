from __future__ import annotations

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadweave.sources import (
    current_version,
    define_view,
    expire_materialized,
    expire_versions,
    load,
    materialize,
    read_table,
    replace_table,
    schemas,
    snapshot,
    tables,
)
from roadweave.sources.derived import DERIVED, Inputs, as_ctes, reads
from roadweave.sources.tables import shared_folder


def test_load_reads_only_the_declared_columns(spark, tmp_path):
    spark.range(5).withColumn("x", F.lit("a")).withColumn("y", F.lit(1.5)).write.parquet(f"{tmp_path}/t.parquet")
    df = load(spark, str(tmp_path), "t", schemas.layout("id bigint, y double"))
    assert df.columns == ["id", "y"] and df.count() == 5
    plan = df.where("id > 2")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint,y:double>" in plan and "GreaterThan(id,2)" in plan


def test_materialize_checks_its_key(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    table = materialize(df, f"{tmp_path}/good", keys=["id"])
    assert table.schema == df.schema and rows(table) == rows(df)
    with pytest.raises(ValueError, match="violated"):
        materialize(df.union(df), f"{tmp_path}/bad", keys=["id"])


def test_materialize_uses_the_folder_of_the_session(spark, shared):
    table = materialize(spark.range(3))
    assert table.count() == 3 and shared in table.inputFiles()[0]


def test_the_shared_folder_is_the_setting_or_in_the_warehouse():
    session = lambda **conf: SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))
    warehouse = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}
    assert shared_folder(session(**warehouse)) == "hdfs://store/warehouse/roadweave"
    assert shared_folder(session(**warehouse, **{"spark.checkpoint.dir": "hdfs://store/shared/"})) == "hdfs://store/shared"


def test_partitioned_table_keeps_column_order(spark, tmp_path):
    df = spark.createDataFrame([(12174, 1), (12175, 2)], "van_no int, v int")
    table = materialize(df, f"{tmp_path}/p", partition_by=["van_no"])
    assert table.columns == ["van_no", "v"] and rows(table.where("van_no = 12175")) == [(12175, 2)]


def test_a_view_is_lazy_and_usable_from_sql(spark):
    define_view(spark.range(10).where("id > 3"), "large_ids")
    assert spark.sql("select sum(id) as s from large_ids where id < 6").first().s == 9


def test_replace_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        current_version(spark, path)
    assert replace_table(spark.range(7), path).count() == 7
    assert replace_table(read_table(spark, path).where("id > 1"), path, keys=["id"]).count() == 5
    twice = read_table(spark, path).union(read_table(spark, path))
    with pytest.raises(ValueError, match="violated"):
        replace_table(twice, path, keys=["id"])
    assert read_table(spark, path).count() == 5
    assert len(list((tmp_path / "t").glob("v*"))) == 2 == len(list((tmp_path / "t" / "pointers").glob("[0-9]*")))


def test_a_reader_finds_a_whole_table_at_every_step(spark, tmp_path, monkeypatch):
    """Looked at before the write, after the data, after the check, and after the pointer."""
    path, seen = f"{tmp_path}/t", []
    replace_table(spark.range(3), path)
    open_frame = read_table(spark, path)

    def watched(step):
        return lambda *args, **kwargs: (seen.append(read_table(spark, path).count()), step(*args, **kwargs), seen.append(read_table(spark, path).count()))[1]

    for name in ("materialize", "assert_key"):
        monkeypatch.setattr(tables, name, watched(getattr(tables, name)))
    replace_table(spark.range(10), path, keys=["id"])
    assert seen and set(seen) == {3} and read_table(spark, path).count() == 10
    assert open_frame.count() == 3  # made before the replacement


def test_expiry_leaves_what_is_still_read(spark, tmp_path):
    path, hour = f"{tmp_path}/t", 3600
    replace_table(spark.range(3), path)
    first = read_table(spark, path)
    replace_table(spark.range(4), path)
    replace_table(spark.range(5), path)
    assert expire_versions(spark, path, older_than=hour) == []
    assert first.count() == 3  # replaced a moment ago
    lost = tmp_path / "t" / f"v{'0' * 32}"
    lost.mkdir()
    later = time.time() + 2 * hour
    assert len(expire_versions(spark, path, older_than=hour, now=later)) == 3 and not lost.exists()
    assert read_table(spark, path).count() == 5  # the present version is older still, and stays
    assert expire_versions(spark, path, older_than=0, now=later) == []
    assert replace_table(spark.range(6), path).count() == 6  # numbers go on


def test_expiry_of_materialized_tables(spark, shared):
    table, other = materialize(spark.range(3)), materialize(spark.range(4), f"{shared}/named")
    assert expire_materialized(spark, older_than=3600) == [] and table.count() == 3
    folder = table.inputFiles()[0].rsplit("/", 2)[1]
    real = tables._listed
    try:  # only this test's table has grown old
        tables._listed = lambda s, p: [(n, 0.0 if n == folder else t) for n, t in real(s, p)]
        assert [f.rsplit("/", 1)[1] for f in expire_materialized(spark, older_than=3600)] == [folder]
    finally:
        tables._listed = real
    assert not list(Path(shared).glob(folder)) and other.count() == 4


def test_snapshot_prunes_columns(spark, tmp_path):
    source = spark.createDataFrame([(1, "a", 2.0)], "id int, v string, w double")
    assert rows(snapshot(source, ["id", "w"], f"{tmp_path}/s", keys=["id"])) == [(1, 2.0)]


def test_layouts_match_the_derived_tables(spark):
    t = Inputs(spark, "/root/testdata/sf0.001")
    pairs = {
        "roadlog": schemas.ROADLOG, "gn_locate": schemas.GN_LOCATE, "tcr_lookup": schemas.TCR_LOOKUP,
        "gn_coords": schemas.GN_COORDS, "sec_segments": schemas.SEC_SEGMENTS, "hpms": schemas.HPMS,
        "forest": schemas.FOREST, "forest_raw": schemas.FOREST_RAW, "sec_file": schemas.SEC_FILE,
        "files_combined": schemas.FILES_COMBINED, "sec_file_north": schemas.SEC_FILE_PART,
        "north_corr_rb": schemas.FILES_CORR_RB, "north_descr": schemas.FILES_ROADWAY_DESCR, "t_matl": schemas.T_MATL,
        "county_cases": schemas.COUNTY_CASES, "housing": schemas.HOUSING, "income_assistance": schemas.INCOME_ASSISTANCE,
        "t_smpl": schemas.T_SMPL, "distress": schemas.DISTRESS,
    }
    for name, layout in pairs.items():
        assert t[name].dtypes == [(f.name, f.dataType.simpleString()) for f in layout.fields], name


def test_derived_tables_come_after_those_they_read():
    entries = [e.split(" as (", 1)[0] for e in as_ctes(["sec_segments_new_col", "roadlog"])]
    assert entries == ["sec_segments", "sec_segments_new_col", "roadlog"]
    assert all(set(reads(n)) for n in DERIVED)
