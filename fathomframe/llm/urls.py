"""URL filter: host-suffix and path-prefix expressions met with a rule list by short hash, then by digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

#: host, path, verdict
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lower-cased, and path up to ``?`` or ``#``; both empty if there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "rule_host string, rule_path string, action string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict.

    A rule fits its host and all subdomains where the path starts with the rule's path. Each distinct host
    and path is expanded into the suffixes and prefixes of the lengths that rules have; the expressions meet
    the rules on four bytes of their digest, the whole digest confirms. The longest rule wins (then the one
    with the longer host, then block). A null url or one without ``://`` has an empty host and path and fits
    no rule; where no rule fits, the verdict is ``default``. Repeated rows stay, in-columns named host, path,
    rule or verdict are replaced. rules: rule_host, rule_path (empty or starting with ``/``), action.
    """
    rules = rules.select(
        "rule_host", "rule_path", "action", _digest(F.col("rule_host"), F.col("rule_path")).alias("_rule_digest"),
        F.concat("rule_host", "rule_path").alias("_rule"))
    sizes = rules.select(
        F.size(F.split("rule_host", r"\.", -1)).alias("labels"), F.length("rule_path").alias("chars")).distinct().collect()
    labels, chars = sorted({r.labels for r in sizes}), sorted({r.chars for r in sizes})
    host, path = host_and_path(F.col(url))
    parsed = pages.withColumns({"host": host, "path": path})
    if not sizes:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = parsed.where(F.col("host") != "").select(F.col("host").alias("_h"), F.col("path").alias("_p")).distinct()
    parts = F.split("_h", r"\.", -1)
    suffixed = keys.select("_h", "_p", F.explode(F.filter(
        F.array(*[F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) for n in labels]),
        lambda x: x.isNotNull())).alias("_suffix"))
    expressions = suffixed.select("_h", "_p", "_suffix", F.explode(F.filter(
        F.array(*[F.when(F.length("_p") >= n, F.substring("_p", 1, n)) for n in chars]),
        lambda x: x.isNotNull())).alias("_prefix"))
    expressions = expressions.withColumn("_digest", _digest(F.col("_suffix"), F.col("_prefix")))
    hits = expressions.join(
        rules, F.substring("_digest", 1, 8) == F.substring("_rule_digest", 1, 8)).where("_digest = _rule_digest")
    best = hits.groupBy("_h", "_p").agg(F.max(F.struct(
        F.length("_rule"), F.length("rule_host"), (F.col("action") == "block"),
        F.col("_rule").alias("rule"), F.col("action").alias("action"))).alias("_best"))
    met = parsed.join(best, (F.expr("nullif(host, '')") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    return met.withColumns({
        "rule": F.col("_best.rule"), "verdict": F.coalesce("_best.action", F.lit(default))}).drop("_h", "_p", "_best")
