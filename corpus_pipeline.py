"""From documents to token ids: language, exact and near duplicates, source weights, SentencePiece.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns a DataFrame; all but the
last return the columns of their input. Null and repeated ids, null and empty texts and extra columns pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomframe.llm import exact, langid, mixing, near
from fathomframe.llm.common import BROADCAST_ROWS, few, small_batches, table, written
from fathomframe.llm.queries import encoded

#: A document is rejected when it has no letter or its best language has less than this calibrated probability.
LEAST_SCORE = 0.4


def _without(docs: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of docs whose keys (nulls being equal) are not in gone, which is broadcast only if counted small."""
    gone = gone.select(*[F.col(k).alias(f"_gone{i}") for i, k in enumerate(keys)])
    if few(gone, BROADCAST_ROWS):
        gone = F.broadcast(gone)
    on = [F.col(k).eqNullSafe(F.col(f"_gone{i}")) for i, k in enumerate(keys)]
    return docs.join(gone, on, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the corpus has labels for; where nothing is labelled, all with a letter."""
    small_batches(spark)
    model = langid.train(docs)
    judged = langid.identify(docs.select(F.struct("*").alias("_doc")), model, "_doc.text")
    if not model.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; of rows equal in id and text one."""
    small_batches(spark)
    decided = exact.exact_duplicates(docs).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n"))
    decided = written(decided, "exact-decided")
    gone = decided.where(~F.col("kept")).select("doc_id", F.col("text_sha256").alias("_sha"))
    twice = decided.where("kept AND n > 1").select("doc_id", F.col("text_sha256").alias("_sha"))
    columns = docs.columns
    marked = docs.withColumn("_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    kept = _without(marked, gone, ["doc_id", "_sha"])
    if twice.isEmpty():
        return kept.select(*columns)
    again = twice.select(F.col("doc_id").alias("_id"), F.col("_sha").alias("_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest"))
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "_sha"])
    return _without(kept, twice, ["doc_id", "_sha"]).unionByName(once).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, the one with the smallest id, a null id being the largest.

    Where ids are null or repeated each row is a vertex of its own; of rows with one id the smaller digest stays.
    """
    small_batches(spark)
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        decided = near.near_duplicates(docs)
        gone = written(decided.where(~F.col("kept")).select("doc_id").distinct(), "near-gone")
        return _without(docs, gone, ["doc_id"])
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "near-rows")
    decided = near.near_duplicates(rows, "_row").select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256), "_row")
    placed = written(rows.select("_row", order.alias("_order")).join(decided, "_row"), "near-placed")
    stay = placed.groupBy("component_id").agg(F.min("_order")["_row"].alias("_row"))
    gone = written(placed.select("_row").join(stay, "_row", "left_anti"), "near-gone")
    return _without(rows, gone, ["_row"]).drop("_row")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to three times."""
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip of every row."""
    return encoded(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]
#: Training, minhash components and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
