"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins are left to AQE: it broadcasts a side only after measuring it, and splits
# hot partitions even when the split costs one more shuffle further up the plan.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the runtime (SQL) settings; safe to call on a session someone else built."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def build_session(cpus: int | str = 8, app: str = "roadweave", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the session you are given and ``tune`` it."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**ADAPTIVE, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
