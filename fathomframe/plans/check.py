"""Stage 2: standardise the observations, report errors, drop bad rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import (
    SAMPLE, TAXON, fill_taxa, lower_species, percent_of, replace_text, with_numeric)
from fathomframe.operators.aggregates import group_mean
from fathomframe.operators.filters import (
    MAX_RANGE_MM, drop_sync_points, exclude_values, in_region, within_range)
from fathomframe.operators.joins import anti_join, join_on, lookup_join

# The life-history columns a study uses.
LIFE_HISTORY_COLUMNS = (
    "family", "genus", "species", "marine_region", "length_measure",
    "a", "b", "all", "bll", "fb_length_max", "fb_ltypemaxm",
)


def standardise_maxn(maxn: DataFrame) -> DataFrame:
    out = lower_species(with_numeric(maxn, ["maxn"]))
    return fill_taxa(out.select(*SAMPLE, *TAXON, "maxn"))


def standardise_length(length: DataFrame) -> DataFrame:
    out = with_numeric(length, ["number", "range", "length"])
    out = drop_sync_points(out.select(*SAMPLE, *TAXON, "length", "number", "range"))
    return fill_taxa(out).withColumn("genus", replace_text("genus", {"NA": "Unknown"}))


def load_life_history(table: DataFrame, country: str = "Australia",
                      region: str = "NW") -> DataFrame:
    """Taxa of one marine region with their length and weight parameters."""
    here = in_region(table, country, region)
    return (with_numeric(here, ["a", "b", "all", "bll", "fb_length_max"])
            .select(*LIFE_HISTORY_COLUMNS).distinct())


def load_synonyms(table: DataFrame) -> DataFrame:
    return table.distinct().drop("comment")


def one_name_each(synonyms: DataFrame) -> DataFrame:
    """One row per old name.  Two different new names for one old name would
    multiply observations; the job that meets them ends with an error."""
    new = [f"new_{t}" for t in TAXON]
    ways = F.collect_set(F.struct(*[F.coalesce(n, F.lit("\u0000")).alias(n) for n in new]))
    clash = F.concat(F.lit("contradictory synonyms for "), F.concat_ws(" ", *TAXON))
    grouped = synonyms.groupBy(*TAXON).agg(ways.alias("ways")).withColumn(
        "way", F.when(F.size("ways") > 1, F.raise_error(clash)).otherwise(F.get("ways", F.lit(0))))
    return grouped.select(*TAXON, *[F.nullif(F.col(f"way.{n}"), F.lit("\u0000")).alias(n) for n in new])


def apply_synonyms(df: DataFrame, synonyms: DataFrame,
                   fits: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Replace outdated taxon names; also return the distinct changes made.

    ``synonyms`` maps family, genus, species to new_family, new_genus,
    new_species; an empty new part keeps the old one.  Rows in are rows out:
    contradictory synonyms are an error (see :func:`one_name_each`).
    """
    new = [f"new_{t}" for t in TAXON]
    mapped = lookup_join(df, one_name_each(synonyms), TAXON, "left", fits=fits)
    renamed = [F.coalesce(n, t) for n, t in zip(new, TAXON, strict=True)]
    changed = F.lit(False)
    for t, n in zip(TAXON, renamed, strict=True):
        changed = changed | ~F.col(t).eqNullSafe(n)
    report = mapped.filter(changed).select(
        *TAXON, *[n.alias(f"new_{t}") for t, n in zip(TAXON, renamed, strict=True)]).distinct()
    result = mapped.withColumns(dict(zip(TAXON, renamed, strict=True))).select(*df.columns)
    return result, report


def taxa_not_observed(obs: DataFrame, life_history: DataFrame,
                      ignore: Sequence[str] = ("spp",), fits: bool | None = None) -> DataFrame:
    """Taxa per sample that the life-history table does not know."""
    wanted = exclude_values(obs.select(*SAMPLE, *TAXON), "species", list(ignore))
    return anti_join(wanted.distinct(), life_history, TAXON, fits=fits)


def max_length_bounds(life_history: DataFrame, low: float = 0.15,
                      high: float = 0.85) -> DataFrame:
    """Accepted length range per taxon: shares of the species maximum, else of
    the mean maximum of the genus, else of the family."""
    genus = group_mean(life_history, ["genus"], "fb_length_max", "genus_max")
    family = group_mean(life_history, ["family"], "fb_length_max", "family_max")
    out = join_on(life_history, family, ["family"], "left")
    out = join_on(out, genus, ["genus"], "left")
    top = F.coalesce("fb_length_max", "genus_max", "family_max")
    return (out.withColumn("fb_length_max", top).drop("genus_max", "family_max")
            .withColumn("min_length", F.lit(low) * F.col("fb_length_max"))
            .withColumn("max_length", F.lit(high) * F.col("fb_length_max"))
            .select(*life_history.columns, "min_length", "max_length"))


def wrong_length_taxa(length: DataFrame, bounds: DataFrame,
                      fits: bool | None = None) -> DataFrame:
    """Lengths outside the accepted range.  A taxon listed twice in the bounds
    is tested against both."""
    limits = bounds.select(*TAXON, "min_length", "max_length", "fb_length_max")
    measured = length.select(*SAMPLE, *TAXON, "length").filter(F.col("length").isNotNull())
    small = F.col("length") < F.col("min_length")
    big = F.col("length") > F.col("max_length")
    return (lookup_join(measured, limits, TAXON, "inner", fits=fits).filter(small | big)
            .select(*SAMPLE, *TAXON, "length", "min_length", "max_length", "fb_length_max",
                    F.when(small, "too small").otherwise("too big").alias("reason"),
                    F.when(small, F.col("min_length") - F.col("length"))
                    .otherwise(F.col("length") - F.col("max_length")).alias("difference"),
                    percent_of("length", "fb_length_max").alias("percent_of_fb_max")))


def wrong_length_legacy(length: DataFrame, life_history: DataFrame) -> DataFrame:
    """Older rule: at or above the maximum, where a family mean that counts
    unknown maxima as zero stands in for a missing species maximum."""
    family = (life_history.groupBy("family")
              .agg(F.avg(F.coalesce("fb_length_max", F.lit(0.0))).alias("family_max"))
              .filter(F.col("family_max") != 0))
    limits = join_on(life_history, family, ["family"], "left").select(
        *TAXON, F.coalesce("fb_length_max", "family_max").alias("fb_length_max"), "fb_ltypemaxm")
    measured = length.select(*SAMPLE, *TAXON, "length").filter(F.col("length").isNotNull())
    over = lookup_join(measured, limits, TAXON, "inner").filter(
        F.col("length") >= F.col("fb_length_max"))
    return (over.select(*SAMPLE, *TAXON, "length", "fb_length_max", "fb_ltypemaxm",
                        percent_of(F.col("length") - F.col("fb_length_max"),
                                   "fb_length_max").alias("percent_error"))
            .orderBy(F.col("percent_error").desc(), *SAMPLE, *TAXON, "length"))


def stereo_maxn(length: DataFrame) -> DataFrame:
    """Individuals measured or located per sample and taxon."""
    return length.groupBy(*SAMPLE, *TAXON).agg(F.sum("number").alias("stereo_maxn"))


def maxn_vs_stereo(length: DataFrame, maxn: DataFrame,
                   include_unmeasured: bool = False) -> DataFrame:
    """Taxa whose MaxN differs from the number measured, largest gap first.

    Both inputs are standardised, so taxa are never missing and the join can
    reuse the partitioning of the aggregation.  A taxon without any
    measurement is left out unless ``include_unmeasured``; it is then listed,
    with zero measured, for samples where some length was taken.
    """
    stereo = stereo_maxn(fill_taxa(length))
    counted = fill_taxa(maxn).select(*SAMPLE, *TAXON, "maxn")
    keys = [*SAMPLE, *TAXON]
    if include_unmeasured:
        both = join_on(stereo, counted, keys, "full", null_safe=())
        samples = length.select(*SAMPLE).distinct()
        both = join_on(both, samples, SAMPLE, "left_semi", null_safe=())
        both = both.fillna({"stereo_maxn": 0})
    else:
        both = join_on(stereo, counted, keys, "left", null_safe=())
    gap = F.col("maxn") - F.col("stereo_maxn")
    return (both.fillna({"maxn": 0}).filter(F.col("maxn") != F.col("stereo_maxn"))
            .select(*keys, "maxn", "stereo_maxn", F.abs(gap).alias("difference"),
                    F.abs(percent_of(gap, "maxn")).alias("percent_difference"))
            .orderBy(F.col("difference").desc(), *keys))


def drop_listed_taxa(df: DataFrame, bad_taxa: DataFrame) -> DataFrame:
    """Remove the sample-taxon pairs of a report."""
    keys = [*SAMPLE, *TAXON]
    return join_on(df, bad_taxa.select(*keys).distinct(), keys, "left_anti")


def drop_wrong_lengths(length: DataFrame, wrong: DataFrame,
                       per_sample: bool = False) -> DataFrame:
    """Remove reported lengths.  A reported (taxon, length) goes in every
    sample unless ``per_sample``."""
    keys = [*(SAMPLE if per_sample else ()), *TAXON, "length"]
    return join_on(length, wrong.select(*keys).distinct(), keys, "left_anti",
                   null_safe=[*TAXON, "length"])


def drop_unknown_taxa(obs: DataFrame, life_history: DataFrame,
                      ignore: Sequence[str] = ("spp",), fits: bool | None = None) -> DataFrame:
    """What :func:`drop_listed_taxa` leaves when the unchanged report of
    :func:`taxa_not_observed` is applied.

    Whether a row goes depends on its taxon alone, so the small life-history
    table decides and the observations need no shuffle.
    """
    known = life_history.select(*TAXON).distinct().withColumn("__known", F.lit(True))
    tagged = lookup_join(obs, known, TAXON, "left", fits=fits)
    keep = F.col("__known") | F.coalesce(F.col("species").isin(*ignore), F.lit(False))
    return tagged.filter(F.coalesce(keep, F.lit(False))).select(*obs.columns)


def drop_implausible_lengths(length: DataFrame, bounds: DataFrame,
                             fits: bool | None = None) -> DataFrame:
    """What :func:`drop_wrong_lengths` leaves when the unchanged report of
    :func:`wrong_length_taxa` is applied.

    Whether a length is wrong depends on its taxon and itself, so every sample
    is treated alike and the lengths need no shuffle.  Bounds listed twice for
    a taxon come down to the narrowest.
    """
    limits = bounds.groupBy(*TAXON).agg(F.max("min_length").alias("__low"),
                                        F.min("max_length").alias("__high"))
    tested = lookup_join(length, limits, TAXON, "left", fits=fits)
    wrong = (F.col("length") < F.col("__low")) | (F.col("length") > F.col("__high"))
    return tested.filter(~F.coalesce(wrong, F.lit(False))).select(*length.columns)


def drop_errors(maxn: DataFrame, length: DataFrame, bad_taxa_maxn: DataFrame | None,
                bad_taxa_length: DataFrame | None, wrong: DataFrame | None,
                max_range_mm: float | None = MAX_RANGE_MM,
                per_sample: bool = False) -> tuple[DataFrame, DataFrame]:
    """The decision step with reports that may have been edited by hand: each
    list given is applied, ``None`` skips it."""
    if max_range_mm is not None:
        length = within_range(length, max_range_mm)
    if bad_taxa_maxn is not None:
        maxn = drop_listed_taxa(maxn, bad_taxa_maxn)
    if bad_taxa_length is not None:
        length = drop_listed_taxa(length, bad_taxa_length)
    if wrong is not None:
        length = drop_wrong_lengths(length, wrong, per_sample)
    return maxn, length
