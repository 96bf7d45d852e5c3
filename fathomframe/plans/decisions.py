"""A log of what was decided about reported rows: merged in order, applied, and checked for what it no longer fits.

An entry names rows by their keys: campaign, sample and taxon, and a length if only rows of that length are meant.
``action`` is ``drop``, ``keep`` or ``set``; ``set`` gives new values for the parts of a taxon or the length that are not
missing in the entry.  Of several entries with the same keys the one with the largest ``seq`` holds; of an entry for a
length and one for its taxon, the one for the length.  Missing equals missing, but a missing length means any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import SAMPLE, TAXON
from fathomframe.operators.joins import join_on

KEYS = (*SAMPLE, *TAXON)
NEW = tuple(f"new_{c}" for c in (*TAXON, "length"))
ACTIONS = ("drop", "keep", "set")


def as_decisions(report: DataFrame, action: str = "drop", seq: int = 0) -> DataFrame:
    """A report (or an edited copy of one) as entries of a log; without a column ``length`` they are for any length."""
    length = F.col("length") if "length" in report.columns else F.lit(None)
    new = [F.col(n) if n in report.columns else F.lit(None).cast("double" if n == "new_length" else "string") for n in NEW]
    return report.select(F.lit(seq).cast("long").alias("seq"), F.lit(action).alias("action"), *KEYS, length.cast("double").alias("length"),
                         *[c.alias(n) for c, n in zip(new, NEW, strict=True)]).distinct()


def merged(log: DataFrame) -> DataFrame:
    """The entry that holds for each set of keys.  Different entries with one ``seq`` and the same keys are an error, as
    is an unknown action: the job that meets them ends."""
    said = F.struct("action", *NEW)
    groups = log.groupBy(*KEYS, "length").agg(F.max("seq").alias("seq"))
    again = join_on(log.select("seq", *KEYS, "length", said.alias("said")), groups, [*KEYS, "length", "seq"], "inner", null_safe=[*TAXON, "length"])
    held = again.groupBy(*KEYS, "length", "seq").agg(F.collect_set("said").alias("said"))
    wrong = F.when(F.size("said") > 1, F.lit("contradictory decisions for ")).when(
        ~F.get("said", F.lit(0))["action"].isin(*ACTIONS), F.lit("unknown action for "))
    one = F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.concat_ws(" ", *KEYS)))).otherwise(F.get("said", F.lit(0)))
    return held.withColumn("said", one).select("seq", *KEYS, "length", "said.*")


def _matched(rows: DataFrame, log: DataFrame) -> DataFrame:
    """rows with ``__said``, the entry that holds for each: two equi joins, each key of the log once."""
    held = merged(log).withColumn("__said", F.struct("action", *NEW))
    general = held.filter(F.col("length").isNull()).select(*KEYS, F.col("__said").alias("__general"))
    out = join_on(rows, general, KEYS, "left", null_safe=TAXON)
    if "length" not in rows.columns:
        return out.withColumn("__said", F.col("__general")).drop("__general")
    single = held.filter(F.col("length").isNotNull()).select(*KEYS, "length", F.col("__said").alias("__single"))
    out = join_on(out, single, [*KEYS, "length"], "left", null_safe=TAXON)
    return out.withColumn("__said", F.coalesce("__single", "__general")).drop("__single", "__general")


def apply_decisions(rows: DataFrame, log: DataFrame) -> DataFrame:
    """rows without those to drop and with the values set; the columns stay as they were.

    A table without lengths (MaxN) follows the entries for any length only.
    """
    met = _matched(rows, log).filter(~F.coalesce(F.col("__said.action") == "drop", F.lit(False)))
    sets = F.coalesce(F.col("__said.action") == "set", F.lit(False))
    changed = {c: F.when(sets, F.coalesce(f"__said.new_{c}", c)).otherwise(F.col(c)) for c in (*TAXON, "length") if c in rows.columns}
    return met.withColumns(changed).select(*rows.columns)


def stale_decisions(rows: DataFrame, log: DataFrame) -> DataFrame:
    """The entries that hold but fit no row any more, because a file was corrected, say."""
    held = merged(log)
    general = join_on(held.filter(F.col("length").isNull()), rows.select(*KEYS).distinct(), KEYS, "left_anti", null_safe=TAXON)
    if "length" not in rows.columns:
        return general
    single = held.filter(F.col("length").isNotNull())
    return general.unionByName(join_on(single, rows.select(*KEYS, "length").distinct(), [*KEYS, "length"], "left_anti", null_safe=TAXON))
