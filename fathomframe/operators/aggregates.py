"""Grouped summaries, all with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import measure_rank
from fathomframe.operators.joins import join_on


def group_sum(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Mean of the known values; groups without any are absent."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias(name))


def group_spread(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias(f"min_{value}"),
                                 F.avg(value).alias(f"mean_{value}"),
                                 F.max(value).alias(f"max_{value}"))


def group_sd(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sample standard deviation; NULL for a single value."""
    return df.groupBy(*keys).agg(F.stddev_samp(value).alias(name))


def geometric_mean(value: str) -> Column:
    """Aggregate expression over the positive values; others have no logarithm."""
    c = F.col(value)
    return F.pow(F.lit(10.0), F.avg(F.when(c > 0, F.log10(c))))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def count_distinct(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Number of distinct values (or value combinations), missing included."""
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias(name))


def best_ranked(df: DataFrame, group: Sequence[str], rank: Column | None = None) -> DataFrame:
    """Rows holding the smallest rank of their group, ties kept.

    A partial minimum per group and a join back, so no group has to pass
    through one task.
    """
    ranked = df.withColumn("rank", measure_rank() if rank is None else rank)
    best = ranked.groupBy(*group).agg(F.min("rank").alias("__best"))
    joined = join_on(ranked, best, group, "inner", null_safe=group)
    return joined.filter(F.col("rank") == F.col("__best")).drop("__best")


def sort_desc(df: DataFrame, column: str, ties: Sequence[str] = ()) -> DataFrame:
    """Largest first; the tie columns keep equal values from crowding one task."""
    return df.orderBy(F.col(column).desc(), *[F.col(c).asc() for c in ties])
