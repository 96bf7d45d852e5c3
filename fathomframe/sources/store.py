"""A study's tables clustered by sample, of which single campaigns can be replaced."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType
from pyspark.sql.utils import AnalysisException

from fathomframe.functions.columns import SAMPLE
from fathomframe.session import stored
from fathomframe.sources import files
from fathomframe.sources.manifest import _reader, file_manifest

#: Column that holds the campaign once more, as a folder: a table cannot be cut into folders by what it is clustered by.
FOLDER = "campaign"
STATE = "campaign.states"
#: Bytes of rows, as they lie in memory, that one task sorts to write or to join a bucket.
TASK_BYTES = 128 << 20


def _row_bytes(rows: DataFrame) -> Column:
    """About what a row takes in memory: 16 bytes a column, and its text."""
    out = F.lit(16 * len(rows.columns)).cast("long")
    for field in rows.schema:
        if not isinstance(field.dataType, (NumericType, BooleanType, DatetimeType)):
            out = out + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))
    return out


class StudyStore:
    """Parquet tables below ``root``, one folder for each campaign, clustered by campaign and sample within.

    A campaign is replaced as a whole: Spark writes its new files aside and puts them into place when all are
    written, the files of others are not touched.  A new table has ``buckets`` buckets, or as many more as keep a
    bucket's rows below TASK_BYTES, and no fewer than the study's other tables have: tables with the same number
    join by sample without a shuffle, so store the largest first.  A campaign has a file for each bucket; rows that
    outgrow the buckets of a table that is there are written as several.
    """

    def __init__(self, spark: SparkSession, root: str, study: str, buckets: int = 8) -> None:
        self.spark, self.root, self.study, self.buckets = spark, root.rstrip("/"), study, buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{self.study}.{name}"

    def _known_as(self, name: str) -> str:
        """A name of its own in the session's catalog, whatever other stores there are."""
        mark = hashlib.sha256(self.path(name).encode()).hexdigest()[:16]
        return re.sub(r"[^a-z0-9_]", "_", f"{self.study}_{name}".lower()) + "_" + mark

    def _exists(self, path: str) -> bool:
        fs, p = files._file_system(self.spark, path)
        return fs.exists(p)

    def _open(self, name: str) -> str | None:
        """The table's name in the catalog; made known to this session from the description beside the table."""
        known = self._known_as(name)
        if self.spark.catalog.tableExists(known):
            return known
        if not self._exists(self.path(name) + ".about"):
            return None
        about = self.spark.read.json(self.path(name) + ".about", schema="ddl string, buckets int").first()
        keys = ", ".join(SAMPLE)
        self.spark.sql(f"CREATE TABLE {known} ({about.ddl}) USING parquet PARTITIONED BY ({FOLDER}) "
                       f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {about.buckets} BUCKETS LOCATION '{self.path(name)}'")
        try:
            self.spark.sql(f"ALTER TABLE {known} RECOVER PARTITIONS")
        except AnalysisException:
            pass  # a catalog that lists folders by itself
        return known

    def _buckets(self, name: str | None = None) -> int:
        """Buckets of a table that is there, or the most that any table of the study has."""
        if name is None:
            fs, root = files._file_system(self.spark, self.root)
            there = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
            about = [f"{self.root}/{n}" for n in there if n.startswith(self.study + ".") and n.endswith(".about")]
        else:
            about = [self.path(name) + ".about"]
        if not about:
            return 0
        found = self.spark.read.schema("ddl string, buckets int").json(about).agg(F.max("buckets")).first()[0]
        return found or 0

    def table(self, name: str) -> DataFrame:
        known = self._open(name)
        if known is None:
            raise FileNotFoundError(f"no table {name!r} of study {self.study!r} below {self.root!r}")
        return self.spark.table(known).drop(FOLDER)

    def replace(self, name: str, rows: DataFrame, campaigns: Sequence[str] | None = None) -> None:
        """Put ``rows`` in place of what the table holds of ``campaigns`` (without a list: of the campaigns in ``rows``).

        A campaign of the list that has no rows is emptied.  Rows of a campaign that is not listed are an error.
        """
        # written aside first: they may come from the very table, and are read for their campaigns and then once more
        rows = stored(rows.withColumn(FOLDER, F.col("campaignid")), "to-store")
        sizes = rows.groupBy("campaignid").agg(F.sum(_row_bytes(rows)).alias("size")).collect()
        found, size = {r["campaignid"] for r in sizes}, sum(r["size"] for r in sizes)
        listed = found if campaigns is None else set(campaigns)
        if not found <= listed:
            raise ValueError(f"rows of campaigns that are not to be replaced: {', '.join(sorted(map(str, found - listed))[:20])}")
        known = self._open(name)
        needed = -(-size // TASK_BYTES)
        buckets = max(self.buckets, needed, self._buckets()) if known is None else self._buckets(name)
        # Spark finds buckets as it deals rows: a task of a multiple of them has rows of one bucket only
        dealt = rows.repartition(buckets * max(1, -(-needed // buckets)), *SAMPLE)
        if known is None:
            known = self._known_as(name)
            (dealt.write.format("parquet").partitionBy(FOLDER).bucketBy(buckets, *SAMPLE).sortBy(*SAMPLE)
             .option("path", self.path(name)).saveAsTable(known))
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.table(known).schema)
            self.spark.createDataFrame([(ddl, buckets)], "ddl string, buckets int").coalesce(1).write.mode("overwrite").json(self.path(name) + ".about")
            return
        there = self.spark.table(known)
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            dealt.select(*there.columns).write.mode("overwrite").insertInto(known)
        finally:
            self.spark.conf.set(mode, before)
        if listed - found:
            self._empty(name, sorted(listed - found))
        self.spark.catalog.refreshTable(known)

    def _empty(self, name: str, campaigns: Sequence[str]) -> None:
        """Delete the files of campaigns without rows; Spark tells which those are, however it spells the folder."""
        known = self._open(name)
        held = self.spark.table(known).where(F.col(FOLDER).isin(*campaigns)).select("_metadata.file_path").distinct()
        for row in held.collect():
            fs, path = files._file_system(self.spark, files.unquoted(row["file_path"]))
            fs.delete(path, False)

    def states(self) -> DataFrame:
        """campaignid, digest of the campaigns as they were when the store was last brought up to date."""
        if not self._exists(self.path(STATE)):
            return self.spark.createDataFrame([], "campaignid string, digest string")
        return self.spark.read.schema("campaignid string, digest string").parquet(self.path(STATE))

    def save_states(self, states: DataFrame) -> None:
        states.select("campaignid", "digest").write.mode("overwrite").parquet(self.path(STATE))


def campaign_states(spark: SparkSession, root: str, suffixes: Sequence[str], layout: str = "project/campaign") -> DataFrame:
    """campaignid, digest: what the files of each campaign hold, whenever and wherever they were copied.

    Tasks read the files, a file at a time; the digest is of the names and contents of those with one of the suffixes.
    """
    every = files.list_files(spark, root, "")
    kinds = [[f for f in every if f[0].endswith(s)] for s in dict.fromkeys(suffixes)]
    tables = [file_manifest(spark, found, suffix, layout) for found, suffix in zip(kinds, dict.fromkeys(suffixes), strict=True) if found]
    if not tables:
        return spark.createDataFrame([], "campaignid string, digest string")
    listed = tables[0].select("file", "campaignid")
    for more in tables[1:]:
        listed = listed.unionByName(more.select("file", "campaignid"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for file in batch.column("file").to_pylist():
                whole, raw = hashlib.sha256(), _reader(file)
                while block := raw.read(1 << 22):
                    whole.update(block)
                digests.append(f"{file.rsplit('/', 1)[1]}:{whole.hexdigest()}")
            yield pa.RecordBatch.from_arrays([batch.column("campaignid"), pa.array(digests, pa.string())], ["campaignid", "digest"])

    found = listed.distinct().repartition(spark.sparkContext.defaultParallelism).mapInArrow(read, "campaignid string, digest string")
    # a campaign has a handful of files
    return found.groupBy("campaignid").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("digest")), "\n"), 256).alias("digest"))


def changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """campaignid, change: campaigns that are ``new``, ``changed`` or ``removed`` since."""
    both = now.select("campaignid", F.col("digest").alias("now")).join(before.select("campaignid", F.col("digest").alias("before")), "campaignid", "full")
    kind = F.when(F.col("before").isNull(), "new").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("before"), "changed")
    return both.select("campaignid", kind.alias("change")).where(F.col("change").isNotNull())
