"""Stage 4: percent cover, field of view and relief from habitat point scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import (
    SAMPLE, columns_with_prefix, row_percent, sample_id, with_numeric)
from fathomframe.operators.joins import attach_metadata, join_on
from fathomframe.operators.reshape import prefix_sums, rename_by_map

HABITAT_IDS = ("id", "sample", "campaignid", "project")

# The relief scores, field-of-view classes and biota classes.
RELIEF = tuple(f"relief_{score}" for score in range(6))
FIELD_OF_VIEW = ("fieldofview_facing_down", "fieldofview_facing_up",
                 "fieldofview_limited", "fieldofview_open")
BIOTA = ("ascidians", "bryozoa", "consolidated", "crinoids", "hydrocoral", "hydroids",
         "invertebrate_complex", "macroalgae", "mangrove", "octocoral_black", "seagrasses",
         "sponges", "stony_corals", "true_anemones", "unconsolidated", "zoanthids")


def habitat_broad(habitat: DataFrame, names=None, biota: Sequence[str] = BIOTA) -> DataFrame:
    """Point scores added up to broad classes.

    ``names`` maps detailed column names to broad ones (pairs applied in
    order, several to one allowed).  Points on open water count for no biota
    class, so they stay out of the cover total.
    """
    if "id" not in habitat.columns:
        habitat = habitat.withColumn("id", sample_id())
    values = [c for c in habitat.columns if c not in HABITAT_IDS]
    scored = with_numeric(habitat, values)
    if names is not None:
        scored = rename_by_map(scored, names, HABITAT_IDS)
    classes = {c: c for c in (*RELIEF, *FIELD_OF_VIEW)}
    classes |= {f"biota_{c}": c for c in biota}
    return prefix_sums(scored, classes, HABITAT_IDS)


def fov_percent(h: DataFrame) -> DataFrame:
    """Field-of-view classes in percent; NULL where a sample has no points."""
    cols = columns_with_prefix(h, "fieldofview")
    return row_percent(h.select(*SAMPLE, *cols), cols)


def broad_percent(h: DataFrame) -> DataFrame:
    """Biota classes in percent; zero where a sample has no points."""
    cols = columns_with_prefix(h, "biota_")
    return row_percent(h.select(*SAMPLE, *cols), cols, empty=0.0)


def relief_stats(h: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the relief of all points.

    Scores act as weights: counts, sums and squares give the same result as
    one row per point without creating those rows.  Fractions of a point are
    cut off and samples without points are absent.
    """
    weights = {i: F.coalesce(F.floor(F.greatest(F.col(c).cast("double"), F.lit(0.0))), F.lit(0))
               for i, c in enumerate(RELIEF) if c in h.columns}
    n = sum(weights.values(), F.lit(0))
    total = sum((w * i for i, w in weights.items()), F.lit(0))
    square = sum((w * i * i for i, w in weights.items()), F.lit(0))
    sums = (h.select(*SAMPLE, n.alias("n"), total.alias("s"), square.alias("q"))
            .groupBy(*SAMPLE)
            .agg(*[F.sum(c).cast("double").alias(c) for c in ("n", "s", "q")])
            .filter(F.col("n") > 0))
    spread = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0))
    return sums.select(*SAMPLE, (F.col("s") / F.col("n")).alias("mean_relief"),
                       F.when(F.col("n") > 1, F.sqrt(F.try_divide(spread, F.col("n") - 1)))
                       .alias("sd_relief"))


def full_join_habitat(relief: DataFrame, fov: DataFrame, broad: DataFrame) -> DataFrame:
    both = join_on(relief, fov, SAMPLE, "full", null_safe=())
    return join_on(both, broad, SAMPLE, "full", null_safe=())


def complete_habitat(relief: DataFrame, fov: DataFrame, broad: DataFrame,
                     metadata: DataFrame) -> DataFrame:
    """All habitat measures of the samples in the metadata, with their factors.

    Keeping rows with metadata and then adding it is one inner join.
    """
    joined = attach_metadata(full_join_habitat(relief, fov, broad), metadata)
    out = joined.withColumn("id", sample_id())
    return out.withColumnsRenamed({c: c.replace("biota_", "") for c in out.columns})
