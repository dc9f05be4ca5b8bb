"""Parquet tables: scan with a declared schema, write, replace, expire, snapshot, named views."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from roadweave.operators.quality import assert_key


def load(spark: SparkSession, directory: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Scan ``directory/name.parquet``. With a schema, only its columns are read and no footer decides types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{directory}/{name}.parquet")


def define_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL users (S4). The view is lazy: reading it runs the plan behind it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a folder in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/roadweave"


def materialize(
    df: DataFrame,
    path: str | None = None,
    keys: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write ``df`` and return the written table (S5, S6). With ``keys``, check them as a primary key (Q2).

    Cuts the lineage: a lost executor costs a re-read of the table, not of everything above it. Without a
    path, a new folder below ``spark.checkpoint.dir`` is used.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if keys:
        assert_key(table, keys)
    return table.select(*df.columns)


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its class for paths: the same for local disks, HDFS and object stores."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _listed(spark: SparkSession, path: str) -> Iterator[tuple[str, float]]:
    """(name, seconds since 1970 of the last change) of what lies in a folder."""
    files, place = _files(spark, path)
    if files.exists(place(path)):
        for status in files.listStatus(place(path)):
            yield status.getPath().getName(), status.getModificationTime() / 1000


_POINTER = re.compile(r"([0-9]{20})-(v[0-9a-f]{32})")


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str, float]]:
    """(number, folder, since when) of a table's pointers, oldest first. A pointer is an empty file; its name says it all."""
    found = ((_POINTER.fullmatch(name), since) for name, since in _listed(spark, f"{path.rstrip('/')}/pointers"))
    return sorted((int(m[1]), m[2], since) for m, since in found if m)


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that holds the present contents of a replaceable table."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"{path} has no version yet")
    return f"{path.rstrip('/')}/{versions[-1][1]}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The present contents of a table that ``replace_table`` writes (S7). Later replacements don't change the frame."""
    return spark.read.parquet(current_version(spark, path))


def replace_table(
    df: DataFrame, path: str, keys: Sequence[str] | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace the table at ``path`` (S7), which ``df`` may read from, and return its new contents.

    Each replacement is a folder of its own below ``path``, and a pointer to it is the last thing written, once the data
    are whole and checked. ``read_table`` follows the newest pointer, so a reader finds the old table or the new one, at
    every moment; a job or check that fails leaves the old one. Nothing is renamed or overwritten, which object stores
    can't do in one step. Of two writers at once the one whose pointer comes later in name order wins. Versions stay until
    ``expire_versions``.
    """
    spark, target, version = df.sparkSession, path.rstrip("/"), f"v{uuid.uuid4().hex}"
    files, place = _files(spark, target)
    try:
        table = materialize(df, f"{target}/{version}", keys, partition_by)
    except Exception:
        files.delete(place(f"{target}/{version}"), True)
        raise
    number = max((n for n, _, _ in _versions(spark, target)), default=0) + 1
    files.create(place(f"{target}/pointers/{number:020d}-{version}"), False).close()
    return table


def expire_versions(spark: SparkSession, path: str, older_than: float, now: float | None = None) -> list[str]:
    """Delete the versions of a table that were replaced more than ``older_than`` seconds ago, and return their folders.

    The present version stays, whatever its age. Choose an age beyond the longest job that reads the table: a frame made
    before a replacement goes on reading its version. Folders without a pointer, left by writers that were lost, go by
    their own age.
    """
    files, place = _files(spark, path)
    target, limit = path.rstrip("/"), (time.time() if now is None else now) - older_than
    versions, gone = _versions(spark, target), []
    for (number, folder, _), (_, _, replaced) in zip(versions, versions[1:]):
        if replaced < limit:
            files.delete(place(f"{target}/pointers/{number:020d}-{folder}"), False)
            gone.append(folder)
    known = {folder for _, folder, _ in versions}
    gone += [n for n, since in _listed(spark, target) if re.fullmatch("v[0-9a-f]{32}", n) and n not in known and since < limit]
    for folder in gone:
        files.delete(place(f"{target}/{folder}"), True)
    return [f"{target}/{folder}" for folder in gone]


def expire_materialized(spark: SparkSession, older_than: float, now: float | None = None) -> list[str]:
    """Delete what ``materialize`` wrote to the shared folder more than ``older_than`` seconds ago; return the folders.

    A table counts from when it was last written to, and a replaceable one from its last replacement. Nothing else in the
    shared folder is touched. Choose an age beyond the longest job.
    """
    files, place = _files(spark, shared_folder(spark))
    limit, gone = (time.time() if now is None else now) - older_than, []
    for name, since in list(_listed(spark, shared_folder(spark))):
        folder = f"{shared_folder(spark)}/{name}"
        newest = max([since, *(t for _, _, t in _versions(spark, folder))])
        if re.fullmatch("[0-9a-f]{32}", name) and newest < limit:
            files.delete(place(folder), True)
            gone.append(folder)
    return gone


def snapshot(df: DataFrame, columns: Sequence[str], path: str | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """Write a subset of the columns of a source (S8); the scan below reads no other column."""
    return materialize(df.select(*columns), path, keys)
