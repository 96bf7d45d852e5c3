"""Campaign information that stands in numbered columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomframe.plans import info
from registry.book import query

_SHEET = """SELECT o_orderkey AS orderkey, 'Priority' AS info5name, o_orderpriority AS info5value,
      CASE WHEN o_custkey % 3 = 0 THEN 'Total' ELSE ' ' END AS info6name, round(o_totalprice)::INTEGER::VARCHAR AS info6value,
      'Date' AS info12name, CASE o_custkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
          ELSE 'unknown' END AS info12value,
      'Time' AS info7name, CASE WHEN o_custkey % 2 = 0 THEN '9:23:00' ELSE '0.5' END AS info7value FROM orders"""


def _sheet(r):
    k, at = F.col("o_custkey"), F.col("o_orderdate")
    return r.read("orders").select(
        F.col("o_orderkey").alias("orderkey"), F.lit("Priority").alias("info5name"), F.col("o_orderpriority").alias("info5value"),
        F.when(k % 3 == 0, "Total").otherwise(" ").alias("info6name"), F.round("o_totalprice").cast("int").cast("string").alias("info6value"),
        F.lit("Date").alias("info12name"), F.when(k % 3 == 0, F.date_format(at, "yyyyMMdd")).when(
            k % 3 == 1, F.date_format(at, "dd/MM/yyyy")).otherwise("unknown").alias("info12value"),
        F.lit("Time").alias("info7name"), F.when(k % 2 == 0, "9:23:00").otherwise("0.5").alias("info7value"))


@query("info_pairs", """SELECT orderkey, 5 AS slot, 'Priority' AS name, info5value AS value FROM sheet
    UNION ALL SELECT orderkey, 6, info6name, info6value FROM sheet WHERE info6name = 'Total'
    UNION ALL SELECT orderkey, 7, info7name, info7value FROM sheet
    UNION ALL SELECT orderkey, 12, info12name, info12value FROM sheet""", {"sheet": _SHEET})
def _(r):
    """Any number of paired columns as rows, in one pass."""
    return info.info_pairs(_sheet(r))


@query("info_values", """SELECT o_orderkey AS orderkey, o_orderpriority AS priority,
      CASE WHEN o_custkey % 3 = 0 THEN round(o_totalprice)::INTEGER::DOUBLE END AS total,
      CASE WHEN o_custkey % 3 <> 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
      CASE WHEN o_custkey % 2 = 0 THEN 33780 ELSE 43200 END AS seconds, NULL::VARCHAR AS bait FROM orders""")
def _(r):
    """Typed values of names looked up in the map of a row."""
    held = info.info_map(_sheet(r))
    return held.select("orderkey", info.info_value("Priority").alias("priority"), info.info_value("Total", "number").alias("total"),
                       info.info_value("Date", "date").cast("string").alias("day"), info.info_value("Time", "seconds").alias("seconds"),
                       info.info_value("Bait").alias("bait"))
