"""Session settings and the shared staging folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library is written for.  Shuffle partition numbers are left to
# the cluster: adaptive execution coalesces a generous initial number.
SESSION_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot order or plan on the row side of an enrichment join is split at
    # run time, even where the split costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JVM never compiles methods above 8000 bytes of bytecode.  Stages with
    # many case expressions exceed that and would be interpreted; below this
    # limit Spark splits them into smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "claimtide", master: str | None = None,
                  confs: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONFS, **(confs or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_dir(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset.

    Never a machine-local one: an executor that is lost takes its local files with it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back, so that many outputs share one run."""
    spark = df.sparkSession
    path = f"{folder or staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.parquet(path)
