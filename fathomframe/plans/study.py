"""The whole workflow of a study: gather, check, format, habitat.

Each step takes tables and returns named tables, which run when they are
written.  Before that a step only measures its small tables, each once
(``check_study`` life history and synonyms, ``format_study`` metadata, life
history and the taxa with parameters).  Between the steps the tables are
written (``sources.sinks``), so a later step starts from files and not from a
long lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomframe.functions.columns import SAMPLE, TAXON
from fathomframe.operators import filters, summary
from fathomframe.operators.joins import fits_broadcast
from fathomframe.plans import check, format as fmt, gather, habitat as hab, names
from fathomframe.session import stored
from fathomframe.sources import files
from fathomframe.sources.store import StudyStore, campaign_states, changes

# The endings of the annotation files of one campaign.
SUFFIXES = {
    "points": "_Points.txt", "lengths": "_Lengths.txt", "points3d": "_3DPoints.txt",
    "count": "_Count.csv", "length": "_Length.csv",
    "habitat": "_Habitat.point.score.txt",
}
# Headers of annotation exports and the names used here.
EXPORT_NAMES = {"opcode": "sample", "length_mm_": "length", "range_mm_": "range",
                "period_time_mins_": "periodtime"}


def _scan(spark: SparkSession, root: str, kind: str, layout: str,
          multi_line: bool, campaigns: DataFrame | None) -> DataFrame | None:
    """One kind of file, or None where a study has none."""
    suffix = SUFFIXES[kind]
    try:
        df = files.scan_files(spark, root, suffix, layout=layout, multi_line=multi_line,
                              sep="\t" if suffix.endswith(".txt") else ",", campaigns=campaigns)
    except FileNotFoundError:
        return None
    return df.withColumnsRenamed({old: new for old, new in EXPORT_NAMES.items()
                                  if new not in df.columns})


def gather_study(spark: SparkSession, root: str, layout: str = "project/campaign",
                 metadata: DataFrame | None = None, multi_line: bool = False,
                 campaigns: DataFrame | None = None) -> dict[str, DataFrame]:
    """Metadata, MaxN, lengths with 3D points, and habitat of all campaigns
    below ``root``, or of those that a search has found (``campaigns``, with
    ``name``): files of others are not opened.

    ``metadata`` may be given as a table instead of files.  ``multi_line``
    reads annotation cells with line breaks; metadata is always read so.
    Length tables keep all their columns but time, project and comment.
    """
    if metadata is None:
        metadata = files.scan_metadata(spark, root, layout=layout, campaigns=campaigns)
    points, count, lengths, length, points3d, habitat = (
        _scan(spark, root, kind, layout, multi_line, campaigns)
        for kind in ("points", "count", "lengths", "length", "points3d", "habitat"))
    out = {"metadata": metadata}
    if points is not None or count is not None:
        out["maxn"] = gather.build_maxn(points, count, metadata)
    if any(p is not None for p in (length, lengths, points3d)):
        out["length3dpoints"] = gather.build_length3d(length, lengths, points3d, metadata)
    if habitat is not None:
        out["habitat"] = habitat
    return out


def gather_counts(spark: SparkSession, root: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """Studies with legal and sublegal counts: metadata, count and length as
    they are, and counts completed with zeros."""
    metadata = files.scan_files(spark, root, "Metadata.csv", multi_line=True)
    count = files.scan_files(spark, root, "Count.csv", multi_line=multi_line)
    length = files.scan_files(spark, root, "Length.csv", multi_line=multi_line)
    return {"metadata": metadata, "count": count, "length": length,
            "complete.count": gather.complete_count(count, metadata)}


@dataclass
class Decisions:
    """What to drop after the reports were read.

    The reports are applied as they are; to apply edited ones pass them to
    ``check.drop_errors``.
    """

    max_range_mm: float | None = filters.MAX_RANGE_MM
    drop_taxa: bool = True
    drop_lengths: bool = True


def check_study(maxn: DataFrame, length: DataFrame, life_history: DataFrame,
                synonyms: DataFrame | None = None,
                decisions: Decisions | None = None,
                metadata: DataFrame | None = None
                ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Reports and checked tables.  ``life_history`` is one marine region;
    ``metadata``, if given, comes back as ``checked.metadata``, where the
    later steps start from."""
    decisions = decisions or Decisions()
    known = fits_broadcast(life_history)
    maxn, length = check.standardise_maxn(maxn), check.standardise_length(length)
    reports: dict[str, DataFrame] = {
        "3d.points": filters.three_d_points(length),
        "schools": filters.schools(length),
        "out.of.range": filters.out_of_range(length),
    }
    if synonyms is not None:
        if names.has_chains(synonyms):
            synonyms = names.resolve_synonyms(synonyms)
        renames = fits_broadcast(synonyms)
        maxn, reports["maxn.taxa.names.updated"] = check.apply_synonyms(maxn, synonyms, renames)
        length, reports["length.taxa.names.updated"] = check.apply_synonyms(length, synonyms, renames)
    bounds = check.max_length_bounds(life_history)
    reports |= {
        "maxn.species.not.previously.observed": check.taxa_not_observed(maxn, life_history, fits=known),
        "length.species.not.previously.observed": check.taxa_not_observed(length, life_history, fits=known),
        "maxn.taxa.names.suggested": names.suggest_synonyms(maxn, life_history, fits=known),
        "length.taxa.names.suggested": names.suggest_synonyms(length, life_history, fits=known),
        "check.wrong.length.taxa.vs.life.history": check.wrong_length_taxa(length, bounds, known),
        "taxa.maxn.vs.stereo.summary": check.maxn_vs_stereo(length, maxn),
        "length.greater.than.1.meter": filters.big_fish(length).select(*SAMPLE, *TAXON, "length"),
        "length.range.summary": summary.summary_stats(length, "range"),
        "length.range.box": summary.box_stats(length, "range"),
        "length.histogram": summary.histogram_density(length, "length"),
        "length.vs.range": summary.pair_projection(length, "range", "length"),
        "length.vs.range.curve": summary.local_curve(length, "range", "length"),
    }
    if decisions.max_range_mm is not None:
        length = filters.within_range(length, decisions.max_range_mm)
    if decisions.drop_taxa:
        maxn = check.drop_unknown_taxa(maxn, life_history, fits=known)
        length = check.drop_unknown_taxa(length, life_history, fits=known)
    if decisions.drop_lengths:
        length = check.drop_implausible_lengths(length, bounds, known)
    tables = {"checked.maxn": maxn, "checked.length": length}
    if metadata is not None:
        tables["checked.metadata"] = metadata
    return reports, tables


def _empty(spark: SparkSession, *columns: str) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*SAMPLE, *TAXON, *columns)))


def refresh_study(spark: SparkSession, root: str, store: StudyStore, life_history: DataFrame,
                  synonyms: DataFrame | None = None, decisions: Decisions | None = None,
                  layout: str = "project/campaign", multi_line: bool = False) -> dict[str, str]:
    """Bring a store's checked tables up to date with the files below ``root``: campaign -> what happened to it.

    Only campaigns whose files differ from what they were last time are gathered and checked again, and only they
    are replaced in the store; those without files any more are emptied.  Rows are checked within their campaign, so
    the tables are those of a full run, as long as life history, synonyms and decisions stay the same; with other
    ones start a new store.  The state is written last: what a run leaves undone is done by the next one.
    """
    now = stored(campaign_states(spark, root, [*SUFFIXES.values(), "_Metadata.csv"], layout), "states")
    changed = {r["campaignid"]: r["change"] for r in changes(now, store.states()).collect()}
    if not changed:
        return {}
    names_ = [(c,) for c, change in changed.items() if change != "removed"]
    if names_:
        raw = gather_study(spark, root, layout, multi_line=multi_line, campaigns=spark.createDataFrame(names_, "name string"))
        maxn = raw.get("maxn", _empty(spark, "maxn"))
        length = raw.get("length3dpoints", _empty(spark, "length", "number", "range"))
        _, tables = check_study(maxn, length, life_history, synonyms, decisions, raw["metadata"])
    else:
        tables = {t: store.table(t).limit(0) for t in ("checked.maxn", "checked.length", "checked.metadata")}
    for name, table in tables.items():
        store.replace(name, table, list(changed))
    store.save_states(now)
    return changed


def format_study(maxn: DataFrame, length: DataFrame, metadata: DataFrame,
                 life_history: DataFrame) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Reports and completed tables from checked ones.  ``length`` may come
    back from files: its numbers are made numeric again."""
    samples, known = fits_broadcast(metadata), fits_broadcast(life_history)
    completed = fmt.complete_length(length, metadata, samples)
    taxa = fmt.completed_taxa(length, metadata)
    mass = fmt.complete_mass(length, metadata, life_history, fits=samples)
    reports = {
        f"{level}.missing.lw": fmt.missing_length_weight(taxa, life_history, level, known)
        for level in ("species", "genus", "family")}
    reports["check.mass"] = fmt.check_mass(mass)
    weighed = mass.filter(F.col("mass_g").isNotNull())
    reports |= {"mass.summary": summary.summary_stats(weighed, "mass_g"),
                "mass.box": summary.box_stats(weighed, "mass_g"),
                "mass.vs.length": summary.pair_projection(weighed, "length_cm", "mass_g"),
                "mass.vs.length.curve": summary.local_curve(weighed, "length_cm", "mass_g")}
    tables = {"complete.maxn": fmt.complete_maxn(maxn, metadata, fits=samples),
              "complete.length": completed,
              "expanded.length": fmt.expanded_length(completed),
              "complete.mass": mass}
    return reports, tables


def habitat_study(habitat: DataFrame, metadata: DataFrame, names=None) -> DataFrame:
    """Percent cover, field of view and relief per sample with its factors.

    ``names`` are pairs, or a table that ``files.load_name_map`` reads.
    """
    if isinstance(names, DataFrame):
        names = files.load_name_map(names)
    h = hab.habitat_broad(habitat, names)
    return hab.complete_habitat(hab.relief_stats(h), hab.fov_percent(h),
                                hab.broad_percent(h), metadata)
