"""Helpers shared by the corpus operators: words, scratch tables, size-checked semi joins."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a table of narrow keys that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: Spark's setting by which the files of a query's shuffles go when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """A-Z to lower case, all else unchanged."""
    return F.translate(col, UPPER, LOWER)


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a local master may go without."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.split("[")[0] == "local":
        import tempfile

        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="corpus-"))
        named = context.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, it is computed once, and its shuffles leave no files."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    held = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, held)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Whole texts go to Python some megabytes at a time: what waits for a worker is bounded by bytes, not rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def few(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether df, which should be written already, has at most limit rows."""
    return df.count() <= limit


def only_keys(df: DataFrame, keys: DataFrame, on: list[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of df whose key is in keys; keys is broadcast only if counted to be small."""
    return df.join(F.broadcast(keys) if few(keys, limit) else keys, on, "left_semi")


def text_batches(batches: Iterable, text: str, size: int = 4_000_000) -> Iterator:
    """The pandas batches again, cut where their text passes about size characters."""
    for batch in batches:
        start = held = 0
        for i, x in enumerate(batch[text]):
            held += len(x) if x is not None else 0
            if held >= size:
                yield batch.iloc[start : i + 1].reset_index(drop=True)
                start, held = i + 1, 0
        if start < len(batch):
            yield batch.iloc[start:].reset_index(drop=True)
