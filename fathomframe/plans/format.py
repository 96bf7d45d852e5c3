"""Stage 3: true zeros, individual lengths and biomass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import (
    SAMPLE, TAXON, measure_rank, sample_id, scientific_name, to_numeric)
from fathomframe.operators.aggregates import best_ranked, geometric_mean
from fathomframe.operators.filters import exclude_values, positive
from fathomframe.operators.joins import (
    anti_join, attach_metadata, hinted, join_on, lookup_join)
from fathomframe.operators.reshape import (
    cells_by_left, complete_cells, expand_cells, fill_missing, keyed, left_tuples, right_tuples,
    uncount)
from fathomframe.session import stored


def complete_maxn(maxn: DataFrame, metadata: DataFrame,
                  key: Sequence[str] = SAMPLE, fits: bool | None = None) -> DataFrame:
    """MaxN of every taxon in every sample with fish, zeros included.

    ``key=("sample",)`` adds up equal sample names of different campaigns and
    joins the factors by sample name alone.  Samples without any fish are
    not part of this table (they are part of :func:`complete_length`).
    """
    key = [key] if isinstance(key, str) else list(key)
    summed = maxn.groupBy(*key, *TAXON).agg(
        F.sum(F.coalesce(to_numeric("maxn"), F.lit(0.0))).alias("maxn"))
    filled = complete_cells(summed, key, TAXON, fill={"maxn": 0.0}, carry=metadata.drop("id"),
                            wanted=F.col("family") != "Unknown", fits=fits)
    return filled.withColumns({"scientific": scientific_name(), "id": sample_id()})


def _known(length: DataFrame) -> DataFrame:
    return exclude_values(length, "family", ["Unknown"], keep_missing=False).select(
        *SAMPLE, *TAXON, to_numeric("length").alias("length"), to_numeric("number").alias("number"),
        to_numeric("range").alias("range"))


def _pairs(known: DataFrame, metadata: DataFrame) -> DataFrame:
    """Samples of the metadata with the taxa seen in them."""
    return join_on(known.select(*SAMPLE, *TAXON).distinct(), metadata.select(*SAMPLE), SAMPLE,
                   "left_semi", null_safe=())


def _no_taxon(samples: DataFrame) -> DataFrame:
    """The missing taxon as one row, if there is a sample."""
    return samples.select(*[F.lit(None).cast("string").alias(t) for t in TAXON]).distinct()


def complete_length(length: DataFrame, metadata: DataFrame,
                    fits: bool | None = None) -> DataFrame:
    """Lengths and 3D points plus a zero row for each taxon a sample lacks.

    Every sample of the metadata appears; where one has no fish at all a row
    without taxon stands for it, and that missing taxon takes part in the
    completion like any other.
    """
    factors = hinted(metadata.drop("id"), fits)
    known = _known(length)
    observed = join_on(known, factors, SAMPLE, "inner", null_safe=())
    seen = cells_by_left(_pairs(known, factors), SAMPLE, TAXON)
    empty = join_on(factors.select(*SAMPLE), left_tuples(seen, SAMPLE), SAMPLE, "left_anti", null_safe=())
    taxa = right_tuples(seen, TAXON).unionByName(_no_taxon(empty))
    missing = expand_cells(seen, keyed(factors, SAMPLE), SAMPLE, taxa, TAXON)
    filled = observed.unionByName(missing, allowMissingColumns=True)
    return fill_missing(filled, {"number": 0}).withColumn("id", sample_id())


def completed_taxa(length: DataFrame, metadata: DataFrame) -> DataFrame:
    """The taxa of :func:`complete_length`, from the observed rows alone."""
    pairs = _pairs(_known(length), metadata)
    empty = join_on(metadata.select(*SAMPLE), pairs.select(*SAMPLE).distinct(), SAMPLE, "left_anti",
                    null_safe=())
    return pairs.select(*TAXON).distinct().unionByName(_no_taxon(empty))


def expanded_length(completed: DataFrame) -> DataFrame:
    """One row per measured individual."""
    return uncount(completed.filter(F.col("length").isNotNull()), "number")


def missing_length_weight(taxa: DataFrame, life_history: DataFrame,
                          level: str = "species", fits: bool | None = None) -> DataFrame:
    """Taxa, genera or families without any length-weight relation.

    ``taxa`` is any table with taxa; :func:`completed_taxa` gives those of a
    completed table without completing it.
    """
    keys = {"species": list(TAXON), "genus": ["genus"], "family": ["family"]}[level]
    known = life_history.filter(F.col("a").isNotNull())
    return anti_join(taxa.select(*keys).distinct(), known, keys, fits=fits)


def family_length_weight(life_history: DataFrame) -> DataFrame:
    """Mean length-weight parameters per family, for the best length measure."""
    means = (life_history.groupBy("family", "length_measure")
             .agg(geometric_mean("a").alias("a"), F.avg("b").alias("b"),
                  F.coalesce(F.avg("all"), F.lit(0.0)).alias("all"),
                  F.coalesce(F.avg("bll"), F.lit(1.0)).alias("bll"))
             .filter(F.col("a").isNotNull()))
    return best_ranked(means, ["family"], measure_rank())


def body_mass(length_cm: Column, a: Column, b: Column, all_: Column, bll: Column) -> Column:
    """Grams of one individual; NULL where the power has no real value."""
    adjusted = length_cm * bll + all_
    grams = F.pow(adjusted, b) * a
    return F.when(~F.isnan(grams), grams)


# Parameters of the length-weight relation, and the columns of a mass table.
_LW = ("length_measure", "a", "b", "all", "bll")
MASS_COLUMNS = ("family", "genus", "species", "length", "range", "number", "mass_g", "length_cm")


#: Rows of taxon parameters (some 100 bytes each) that are broadcast.
MOST_PARAMETERS = 50_000


def mass_parameters(taxa: DataFrame, life_history: DataFrame) -> DataFrame:
    """Length-weight parameters (``__a``, ``__b``, ``__all``, ``__bll``) of distinct taxa.

    They come from genus and species; where those are not listed, from the
    family.  A taxon listed twice has two rows, one without ``a`` has none.
    """
    lw = life_history.select("genus", "species", *[F.col(c).alias("s_" + c) for c in _LW],
                             F.lit(True).alias("listed"))
    fam = family_length_weight(life_history).select(
        "family", F.lit(True).alias("unlisted"), *[F.col(c).alias("f_" + c) for c in _LW])
    rows = join_on(taxa.select(*TAXON), lw, ["genus", "species"], "left")
    rows = rows.withColumn("unlisted", F.col("listed").isNull())
    rows = join_on(rows, fam, ["family", "unlisted"], "left")
    pick = {c: F.when(F.col("unlisted"), F.col("f_" + c)).otherwise(F.col("s_" + c))
            for c in _LW}
    rows = rows.select(*TAXON, *[v.alias("__" + c) for c, v in pick.items()])
    standard = F.col("__length_measure").isin("TL", "FL", "SL")
    return rows.filter(F.col("__a").isNotNull()).withColumns({
        "__all": F.when(F.col("__all").isNull() & standard, 0.0).otherwise(F.col("__all")),
        "__bll": F.when(F.col("__bll").isNull() & standard, 1.0).otherwise(F.col("__bll")),
    }).drop("__length_measure")


def _weighed(rows: DataFrame) -> DataFrame:
    cm = F.col("length") / 10
    grams = body_mass(cm, F.col("__a"), F.col("__b"), F.col("__all"), F.col("__bll"))
    return rows.withColumns({"length_cm": cm, "mass_g": grams * F.col("number")})


def length_to_mass(completed: DataFrame, life_history: DataFrame,
                   metadata: DataFrame | None = None,
                   key: Sequence[str] = SAMPLE) -> DataFrame:
    """Biomass of each row of a length table that was completed before.

    Rows without parameters are dropped.  With ``metadata`` the factors are
    joined by ``key``; otherwise those already present stay.  Parameters are
    found once per taxon, so rows meet one small table.  To complete and
    weigh in one go, :func:`complete_mass` needs no join of dense rows.
    """
    key = [key] if isinstance(key, str) else list(key)
    rows = lookup_join(completed, mass_parameters(completed.select(*TAXON).distinct(), life_history), TAXON)
    rows = _weighed(rows)
    if metadata is not None:
        own = [c for c in dict.fromkeys([*key, *MASS_COLUMNS])]
        return attach_metadata(rows.select(*own), metadata, "inner", key)
    kept = [c for c in completed.columns if c not in MASS_COLUMNS]
    return rows.select(*kept, *MASS_COLUMNS)


def complete_mass(length: DataFrame, metadata: DataFrame, life_history: DataFrame,
                  key: Sequence[str] = SAMPLE, fits: bool | None = None) -> DataFrame:
    """:func:`complete_length` and :func:`length_to_mass` in one.

    Parameters are found per taxon, taxa without any are left out before the
    expansion, and factors are joined per sample, so no join stands above
    the dense rows.  A row filled in has no length and no mass, only its
    taxon: one listed twice is filled in twice.  ``key=("sample",)`` takes
    the factors of every campaign that has a sample of that name.
    """
    key = [key] if isinstance(key, str) else list(key)
    factors = hinted(metadata.drop("id"), fits)
    known = _known(length)
    observed = join_on(known, factors, SAMPLE, "inner", null_safe=())
    # Samples with their taxa are read once; all that is asked about taxa comes from there.
    pairs = stored(_pairs(known, metadata), "sample-taxa")
    empty = join_on(metadata.select(*SAMPLE), pairs.select(*SAMPLE).distinct(), SAMPLE, "left_anti", null_safe=())
    taxa = pairs.select(*TAXON).distinct().unionByName(_no_taxon(empty))
    parameters = stored(mass_parameters(taxa, life_history), "mass-parameters")
    times = parameters.groupBy(*TAXON).agg(F.count(F.lit(1)).cast("int").alias("__times"))
    rows, most = times.agg(F.coalesce(F.sum("__times"), F.lit(0)), F.coalesce(F.max("__times"), F.lit(0))).first()
    few = rows <= MOST_PARAMETERS
    parameters, times = hinted(parameters, few), hinted(times, few)
    found = join_on(observed, parameters, TAXON)
    # a cell names how often its taxon is listed, so a missing one can be repeated after the expansion
    cells = cells_by_left(join_on(pairs, times, TAXON), SAMPLE, [*TAXON, "__times"])
    samples, by_key = keyed(factors, SAMPLE), {}
    if key != list(SAMPLE):
        found = attach_metadata(found.select(*key, *TAXON, "length", "number", "range", "__a", "__b",
                                             "__all", "__bll"), factors, "inner", key)
        own = [c for c in samples.columns if c not in factors.columns]
        samples, by_key = samples.select(*key, *own), {"carry": factors, "carry_key": key}
    rows = _weighed(fill_missing(found, {"number": 0})).drop("__a", "__b", "__all", "__bll")
    missing = expand_cells(cells, samples, SAMPLE, times, [*TAXON, "__times"], **by_key)
    missing = missing.withColumn("number", F.lit(0.0))
    # without a taxon listed twice no dense row need be repeated
    missing = uncount(missing, "__times") if most > 1 else missing.drop("__times")
    rows = rows.unionByName(missing, allowMissingColumns=True)
    kept = [c for c in rows.columns if c not in MASS_COLUMNS]
    out = rows.select(*kept, *MASS_COLUMNS)
    return out.withColumn("id", sample_id()) if key == list(SAMPLE) else out


def observed_mass(length: DataFrame, metadata: DataFrame, life_history: DataFrame,
                  fits: bool | None = None) -> DataFrame:
    """The rows of :func:`complete_mass` that were observed, without completing anything."""
    observed = join_on(_known(length), hinted(metadata.drop("id"), fits), SAMPLE, "inner", null_safe=())
    parameters = mass_parameters(observed.select(*TAXON).distinct(), life_history)
    rows = _weighed(fill_missing(lookup_join(observed, parameters, TAXON), {"number": 0}))
    kept = [c for c in observed.columns if c not in MASS_COLUMNS]
    return rows.select(*kept, *MASS_COLUMNS).withColumn("id", sample_id())


def check_mass(mass: DataFrame) -> DataFrame:
    """Mass per individual (kg) and length (cm) per taxon, heaviest first.

    A mass needs a length; saying so lets Spark leave out the zero rows of the
    completion before it creates them.
    """
    kg = F.col("mass_g") / F.col("number") / 1000
    cm = F.round(F.col("length") / 10, 2)
    weighed = positive(mass, "mass_g").filter(F.col("length").isNotNull())
    rows = weighed.select(*TAXON, kg.alias("kg"), cm.alias("cm"))
    return (rows.groupBy(*TAXON)
            .agg(F.round(F.avg("kg"), 3).alias("mean_kg"),
                 F.round(F.max("kg"), 3).alias("max_kg"),
                 F.round(F.min("kg"), 3).alias("min_kg"),
                 F.min("cm").alias("min_length"),
                 F.round(F.avg("cm"), 2).alias("mean_length"),
                 F.max("cm").alias("max_length"))
            .orderBy(F.col("mean_kg").desc(), *TAXON))
