"""Exact duplicates by composable polynomial fingerprints and a chunkwise comparison."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few, written

CHUNK = 1 << 16
#: Documents above this many bytes have their chunks dealt to many tasks.
SPREAD = 1 << 24
#: Two primes under 2^31 and a base for each.
PRIMES, BASES = (2_147_483_647, 2_147_483_629), (1_000_003, 998_244_353)
PAIR = T.StructType([T.StructField(x, T.LongType()) for x in "ab"])
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(prime: int, base: int) -> np.ndarray:
    """base^0 .. base^CHUNK modulo prime."""
    if (prime, base) not in _POWERS:
        out = np.empty(CHUNK + 1, np.uint64)
        out[0], held = 1, 1
        while held <= CHUNK:
            more = min(held, CHUNK + 1 - held)
            step = np.uint64(pow(base, held, prime))
            out[held : held + more] = out[:more] * step % np.uint64(prime)
            held += more
        _POWERS[prime, base] = out
    return _POWERS[prime, base]


def chunk_hash(chunk: bytes, after: int, prime: int, base: int) -> int:
    """What a chunk adds to its document's fingerprint: its own polynomial, shifted by the bytes after it."""
    values = np.frombuffer(chunk, np.uint8).astype(np.uint64) + np.uint64(1)
    own = int((values * _powers(prime, base)[: len(values)][::-1]).sum() % np.uint64(prime))
    return own * pow(base, after, prime) % prime


def _chunk_hashes(chunk: pd.Series, after: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        name: [chunk_hash(c, int(n), p, b) for c, n in zip(chunk, after)]
        for name, p, b in zip("ab", PRIMES, BASES)})


def chunked(docs: DataFrame, body: str) -> DataFrame:
    """docs without body, with _at (chunk number) and _chunk (bytes), one row for an empty body."""
    n = F.octet_length(body)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((n - 1) / CHUNK)).cast("int"))
    out = docs.withColumn("_at", F.explode(starts))
    return out.withColumn("_chunk", F.substring(body, F.col("_at") * CHUNK + 1, CHUNK)).drop(body)


def _bytes(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """_row, doc_id, n_bytes, fp_a, fp_b, text_sha256: one row per row of docs; written, so _row is fixed."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"), _bytes(text).alias("_body"))
    rows = rows.withColumns({"n_bytes": F.octet_length("_body"), "text_sha256": F.sha2("_body", 256)})
    chunks = chunked(rows, "_body")
    spread = chunks.where(F.col("n_bytes") > SPREAD).repartition("_row", "_at")
    chunks = chunks.where(F.col("n_bytes") <= SPREAD).unionByName(spread)
    hashed = chunks.withColumn("_h", F.pandas_udf(_chunk_hashes, PAIR)(
        "_chunk", F.greatest(F.lit(0), F.col("n_bytes") - (F.col("_at") + 1) * CHUNK))).drop("_chunk")
    whole = hashed.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"),
        F.first("text_sha256").alias("text_sha256"),
        *[(F.sum(f"_h.{x}") % F.lit(p)).alias(f"fp_{x}") for x, p in zip("ab", PRIMES)])
    return written(whole, "exact-fingerprints")


FP = ["n_bytes", "fp_a", "fp_b"]


def unequal(docs: DataFrame, shared: DataFrame, text: str = "text") -> DataFrame:
    """The fingerprints among shared under which texts differ in some chunk.

    Chunks meet by fingerprint and number as smallest and largest bytes; each task first folds its own copies
    into one, so a text with a third of all rows moves once per task.
    """
    rows = docs.select(_bytes(text).alias("_body")).withColumn("n_bytes", F.octet_length("_body"))
    small = few(shared)
    lengths = shared.select("n_bytes").distinct()
    rows = rows.join(F.broadcast(lengths) if small else lengths, "n_bytes", "left_semi")
    # told to be not deterministic, or the join's filter on nulls would hash each text a second time in a worker of its own
    whole_hash = F.pandas_udf(_whole_hash, PAIR).asNondeterministic()
    marked = rows.withColumn("_h", whole_hash("_body")).select("n_bytes", F.col("_h.a").alias("fp_a"), F.col("_h.b").alias("fp_b"), "_body")
    marked = marked.join(F.broadcast(shared.select(*FP)) if small else shared.select(*FP), FP, "left_semi")
    ends = chunked(marked, "_body").groupBy(*FP, "_at").agg(F.min("_chunk").alias("_lo"), F.max("_chunk").alias("_hi"))
    return ends.where("_lo <> _hi").select(*FP).distinct()


def _whole_hash(body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        name: [sum(chunk_hash(x[i : i + CHUNK], max(0, len(x) - i - CHUNK), p, b) for i in range(0, len(x), CHUNK)) % p for x in body]
        for name, p, b in zip("ab", PRIMES, BASES)})


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """_row, doc_id, keep_id, group_size, kept, text_sha256: one row per row of docs.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest id stays; a
    null id is smallest, and of rows equal in text and id one stays. Chunks of 64 KiB are hashed on their own
    and add up, shifted by the bytes that follow, so a huge document is hashed by many tasks. Fingerprints
    found more than once are compared chunk by chunk; should texts under one fingerprint differ, they are
    told apart by their digest.
    """
    marks = fingerprints(docs, doc_id, text)
    shared = written(marks.groupBy(*FP).count().where("count > 1").select(*FP), "exact-shared")
    apart = written(unequal(docs, shared, text), "exact-apart")
    if apart.isEmpty():
        marks = marks.withColumn("_class", F.lit(""))
    else:
        marks = marks.join(apart.withColumn("_apart", F.lit(True)), FP, "left").withColumn(
            "_class", F.when(F.col("_apart"), F.col("text_sha256")).otherwise(""))
    key = [*FP, "_class"]
    best = marks.groupBy(*key).agg(F.count("*").alias("_n"), F.max(F.struct("doc_id", "_row")).alias("_best")).where("_n > 1")
    met = marks.join(best, key, "left")
    return met.select(
        "_row", "doc_id", F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("_best.doc_id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_n").isNull() | (F.col("_row") == F.col("_best._row"))).alias("kept"), "text_sha256")
