"""Campaign information: one row per campaign from name/value pairs, and pairs that stand in numbered columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import to_numeric
from fathomframe.operators.reshape import pivot_wide


def campaign_info_wide(info: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    keys = [c for c in ("project", "campaignid") if c in info.columns]
    return pivot_wide(info.select(*keys, "name", "value"), keys, "name", "value", names)


def _slots(columns: Sequence[str], prefix: str) -> list[int]:
    """Numbers N of the columns prefixNname that have a prefixNvalue beside them."""
    found = [re.fullmatch(rf"{re.escape(prefix)}(\d+)name", c) for c in columns]
    return sorted(int(m[1]) for m in found if m and f"{prefix}{m[1]}value" in columns)


def _pairs(df: DataFrame, prefix: str) -> Column:
    """The named slots of a row in their order; a blank name is an unused slot, a blank value is missing."""
    def clean(c: str) -> Column:
        return F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))

    slots = [F.struct(F.lit(n).alias("slot"), clean(f"{prefix}{n}name").alias("name"), clean(f"{prefix}{n}value").alias("value"))
             for n in _slots(df.columns, prefix)]
    if not slots:
        return F.array().cast("array<struct<slot: int, name: string, value: string>>")
    return F.filter(F.array(*slots), lambda p: p["name"].isNotNull())


def _others(df: DataFrame, prefix: str) -> list[str]:
    own = {f"{prefix}{n}{part}" for n in _slots(df.columns, prefix) for part in ("name", "value")}
    return [c for c in df.columns if c not in own]


def info_pairs(df: DataFrame, prefix: str = "info") -> DataFrame:
    """Paired columns (info5name, info5value, ...), however many, as rows: the other columns, slot, name, value.

    Names and values are paired by their number.  The rows are read once, whatever the number of pairs; a row without
    any named slot gives none.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in _others(df, prefix)], F.explode(_pairs(df, prefix)).alias("__pair"))
    return rows.select(*[F.col(f"`{c}`") for c in _others(df, prefix)], "__pair.*")


def info_map(df: DataFrame, prefix: str = "info", out: str = "info") -> DataFrame:
    """The other columns with one map from name to value, made in place: names need not be known.

    Of slots with one name the last one holds.
    """
    last = F.filter("__pairs", lambda p, i: ~F.exists(
        F.slice("__pairs", i + 2, F.size("__pairs")), lambda q: q["name"] == p["name"]))
    held = df.withColumn("__pairs", _pairs(df, prefix)).withColumn(
        "__pairs", F.transform(last, lambda p: F.struct(p["name"], p["value"])))
    return held.select(*[F.col(f"`{c}`") for c in _others(df, prefix)], F.map_from_entries("__pairs").alias(out))


# The ways in which dates stand in annotation files.
DATE_FORMATS = ("yyyyMMdd", "yyyy MM dd", "yyyy-MM-dd", "dd/MM/yy", "dd/MM/yyyy")


def info_value(name: str, kind: str = "text", column: str = "info") -> Column:
    """The value of one name in a map, as ``text``, ``number``, ``date`` or ``seconds`` of a day; missing if it is none.

    A time of day is a clock time (9:23:00, 9:23) or a fraction of a day.
    """
    value = F.try_element_at(column, F.lit(name))
    if kind == "text":
        return value
    if kind == "number":
        return to_numeric(value)
    if kind == "date":
        ways = [F.when(value.rlike(_shape(f)), F.try_to_timestamp(value, F.lit(f))) for f in DATE_FORMATS]
        return F.coalesce(*ways).cast("date")
    if kind == "seconds":
        clock = [F.regexp_extract(value, r"^(\d{1,2}):(\d{2})(?::(\d{2}))?$", i) for i in (1, 2, 3)]
        hours, minutes, seconds = (F.try_to_number(F.nullif(c, F.lit("")), F.lit("99")).cast("int") for c in clock)
        of_clock = F.when((hours < 24) & (minutes < 60) & (F.coalesce(seconds, F.lit(0)) < 60),
                          hours * 3600 + minutes * 60 + F.coalesce(seconds, F.lit(0)))
        share = to_numeric(value)
        return F.coalesce(of_clock, F.when((share >= 0) & (share < 1), F.round(share * 86400))).cast("int")
    raise ValueError(f"unknown kind of value: {kind}")


def _shape(pattern: str) -> str:
    """What a date of a format looks like; a reader alone would take 1/2/15 for a year of two digits or of four."""
    return "^" + re.sub("[yMd]+", lambda m: rf"\d{{{len(m[0])}}}", pattern) + "$"
