"""Equi joins with explicit keys, missing-equals-missing matching and a
measured broadcast decision."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import SAMPLE, TAXON

_MARK = "__right_"
_UNITS = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes_setting(text: str) -> int:
    digits = text.strip().lower().removesuffix("ib").removesuffix("b") or "0"
    if digits[-1] in _UNITS:
        return int(digits[:-1]) * _UNITS[digits[-1]]
    return int(digits)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Measure ``df`` and tell whether one executor can hold a copy.

    One distributed count of rows and of bytes of text.  The bound is the
    session's own broadcast threshold, so switching that off switches every
    broadcast of the library off as well.
    """
    if max_bytes is None:
        max_bytes = _bytes_setting(
            df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if max_bytes <= 0:
        return False
    width = reduce(lambda a, b: a + b,
                   [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
                    + F.lit(16) for c in df.columns])
    size = df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("b")).first()["b"]
    return size <= max_bytes


def hinted(df: DataFrame, fits: bool | None = None) -> DataFrame:
    """``df`` marked for broadcast if, and only if, it was measured to fit.

    ``fits`` passes on the verdict over a table that ``df`` is no larger
    than, so that one table is measured once and not at every join.
    """
    return F.broadcast(df) if (fits_broadcast(df) if fits is None else fits) else df


def _condition(keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    tests = []
    for k in keys:
        left, right = F.col(k), F.col(_MARK + k)
        tests.append(left.eqNullSafe(right) if k in null_safe else left == right)
    return reduce(and_, tests)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
            null_safe: Sequence[str] = TAXON) -> DataFrame:
    """Join on named keys.

    Keys listed in ``null_safe`` match missing with missing.  All other keys
    use plain equality, which lets Spark reuse an existing partitioning.
    A shared column that is no key is an error, not a silent extra key.
    """
    keys = list(keys)
    if how not in ("left_semi", "left_anti"):
        clash = (set(left.columns) & set(right.columns)) - set(keys)
        if clash:
            raise ValueError(f"columns on both sides that are no keys: {sorted(clash)}")
    marked = right.withColumnsRenamed({k: _MARK + k for k in keys})
    joined = left.join(marked, _condition(keys, null_safe), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "right":
        key_cols = [F.col(_MARK + k).alias(k) for k in keys]
    elif how in ("full", "outer", "full_outer"):
        key_cols = [F.coalesce(F.col(k), F.col(_MARK + k)).alias(k) for k in keys]
    else:
        key_cols = [F.col(k) for k in keys]
    rest = [F.col(c) for c in left.columns if c not in keys]
    rest += [F.col(c) for c in right.columns if c not in keys]
    return joined.select(*key_cols, *rest)


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                null_safe: Sequence[str] = TAXON, fits: bool | None = None) -> DataFrame:
    """Join a large table with a table meant to be small.

    The right side is measured first.  If it fits it is broadcast and ``left``
    is not shuffled at all; if it does not fit Spark sorts and merges both
    sides and splits hot keys of ``left`` at run time.
    """
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    return join_on(left, hinted(right, fits), keys, how, null_safe)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              null_safe: Sequence[str] = TAXON, fits: bool | None = None) -> DataFrame:
    """Rows of ``left`` without a partner."""
    return lookup_join(left, right, keys, "left_anti", null_safe, fits)


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              null_safe: Sequence[str] = TAXON, fits: bool | None = None) -> DataFrame:
    """Rows of ``left`` with a partner, never multiplied."""
    return lookup_join(left, right, keys, "left_semi", null_safe, fits)


def attach_metadata(df: DataFrame, metadata: DataFrame, how: str = "inner",
                    keys: Sequence[str] = SAMPLE, fits: bool | None = None) -> DataFrame:
    """Add the sample factors.  Columns of ``df`` that clash are dropped first."""
    clash = [c for c in df.columns if c in metadata.columns and c not in keys]
    return lookup_join(df.drop(*clash), metadata, keys, how, null_safe=(), fits=fits)


def keep_all_samples(df: DataFrame, metadata: DataFrame,
                     keys: Sequence[str] = SAMPLE) -> DataFrame:
    """Right join to the samples of ``metadata``.

    Written as matching rows plus samples without any, because a right join
    cannot split a hot sample of ``df`` while an inner join can.
    """
    samples = metadata.select(*keys)
    matched = lookup_join(df, samples, keys, "inner", null_safe=())
    observed = df.select(*keys).distinct()
    empty = join_on(samples, observed, keys, "left_anti", null_safe=())
    return matched.unionByName(empty, allowMissingColumns=True)
