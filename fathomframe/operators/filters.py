"""Row predicates.  Missing values fail a comparison, as in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RANGE_MM = 10000
BIG_FISH_MM = 1000


def successful(df: DataFrame, kind: str = "count") -> DataFrame:
    """Samples whose ``successful_count`` / ``successful_length`` says Yes."""
    return df.filter(F.col(f"successful_{kind}") == "Yes")


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def drop_sync_points(df: DataFrame) -> DataFrame:
    """Points without a number synchronise the cameras; they are no fish."""
    return df.filter(F.col("number").isNotNull())


def three_d_points(df: DataFrame) -> DataFrame:
    return df.filter(F.col("length").isNull() & F.col("number").isNotNull())


def schools(df: DataFrame) -> DataFrame:
    return df.filter(F.col("number") > 1)


def out_of_range(df: DataFrame, max_range_mm: float = MAX_RANGE_MM) -> DataFrame:
    return df.filter(F.col("range") > max_range_mm)


def within_range(df: DataFrame, max_range_mm: float = MAX_RANGE_MM) -> DataFrame:
    """Strictly nearer than the limit.  Exactly the limit and an unknown range
    are neither kept here nor reported by :func:`out_of_range`."""
    return df.filter(F.col("range") < max_range_mm)


def range_gap(df: DataFrame, max_range_mm: float = MAX_RANGE_MM) -> DataFrame:
    """The rows that fall between the two range filters."""
    return df.filter(F.col("range").isNull() | (F.col("range") == max_range_mm))


def in_region(df: DataFrame, country: str = "Australia", region: str = "NW") -> DataFrame:
    """Patterns are searched anywhere in the text, so ``N`` also finds ``NW``."""
    return df.filter(F.col("global_region").rlike(country)
                     & F.col("marine_region").rlike(region))


def exclude_values(df: DataFrame, column: str, values: Sequence, keep_missing: bool = True) -> DataFrame:
    """``keep_missing=True`` is *not in the set*; ``False`` is *differs from*."""
    test = ~F.col(column).isin(*values)
    return df.filter(F.col(column).isNull() | test if keep_missing else test)


def big_fish(df: DataFrame, min_mm: float = BIG_FISH_MM) -> DataFrame:
    return df.filter(F.col("length") > min_mm)
