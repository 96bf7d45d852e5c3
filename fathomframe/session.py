"""Session settings the library is designed for.

Every setting here is a runtime SQL setting or a builder default; nothing in
the library depends on them for correct results, only for good plans.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot sample or taxon is split at the join even when the join feeds an
    # aggregation on the same key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "fathomframe", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by the driver and all executors."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    return shared.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the scratch folder: its lineage ends there and it is computed once."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
