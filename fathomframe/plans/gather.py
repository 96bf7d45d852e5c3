"""Stage 1: relative abundance, lengths and counts from the annotation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import SAMPLE, TAXON, to_numeric
from fathomframe.operators.filters import positive, successful
from fathomframe.operators.joins import attach_metadata
from fathomframe.operators.reshape import bind_rows, complete_classes


def maxn_from_points(points: DataFrame) -> DataFrame:
    """Largest number of one taxon seen in one frame of a sample, with the
    time of the first frame that reaches it (if points carry ``periodtime``)."""
    frame = [c for c in ("filename", "frame") if c in points.columns]
    timed = "periodtime" in points.columns
    per_frame = points.groupBy(*SAMPLE, *TAXON, *frame).agg(
        F.sum(to_numeric("number")).alias("n"),
        *([F.min(to_numeric("periodtime")).alias("t")] if timed else []))
    best = [F.max("n").alias("maxn")]
    if timed:
        best.append(F.min_by("t", F.struct(-F.col("n"), F.col("t"))).alias("periodtime"))
    return per_frame.filter(F.col("n").isNotNull()).groupBy(*SAMPLE, *TAXON).agg(*best)


def maxn_from_counts(counts: DataFrame) -> DataFrame:
    return counts.select(*SAMPLE, *TAXON, to_numeric("count").alias("maxn"))


def build_maxn(points: DataFrame | None, counts: DataFrame | None,
               metadata: DataFrame) -> DataFrame:
    """MaxN of every successful sample with its factors."""
    parts = []
    if points is not None:
        parts.append(maxn_from_points(points))
    if counts is not None:
        parts.append(maxn_from_counts(counts))
    seen = positive(bind_rows(*parts), "maxn")
    return attach_metadata(seen, successful(metadata, "count"))


def build_length3d(lengths_generic: DataFrame | None, lengths_em: DataFrame | None,
                   points3d: DataFrame | None, metadata: DataFrame) -> DataFrame:
    """Generic lengths, measured lengths and 3D points of successful samples.

    ``time``, ``project`` and ``comment`` of the annotations make way for the
    columns of the metadata.
    """
    parts = [p for p in (lengths_generic, lengths_em, points3d) if p is not None]
    stacked = bind_rows(*parts).drop("time", "project", "comment")
    return attach_metadata(stacked, successful(metadata, "length"))


def complete_count(count: DataFrame, metadata: DataFrame,
                   within: str = "legal_sublegal") -> DataFrame:
    """Zero counts for each class a taxon was not counted in, plus the factors."""
    keys = [c for c in ("project", *SAMPLE, *TAXON) if c in count.columns]
    numeric = count.select(*keys, within, to_numeric("count").alias("count"))
    filled = complete_classes(numeric, keys, within, fill={"count": 0})
    join_keys = [c for c in ("project", *SAMPLE) if c in count.columns and c in metadata.columns]
    return attach_metadata(filled, metadata, "left", join_keys)
