"""Names of taxa: what an unknown name may stand for, and chains of renamings."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import TAXON
from fathomframe.operators.filters import exclude_values
from fathomframe.operators.joins import anti_join, hinted, join_on
from fathomframe.plans.check import one_name_each
from fathomframe.session import stored

#: Edits between an unknown name and a suggestion.
DISTANCE = 2
_NEW = [f"new_{t}" for t in TAXON]
_GAP = "\u0000"


def unknown_taxa(obs: DataFrame, life_history: DataFrame, ignore: Sequence[str] = ("spp",),
                 fits: bool | None = None) -> DataFrame:
    """Taxa that the life-history table does not know, each once, with the number of rows that bear it."""
    wanted = exclude_values(obs.select(*TAXON), "species", list(ignore))
    counted = wanted.groupBy(*TAXON).agg(F.count("*").alias("rows"))
    return anti_join(counted, life_history, TAXON, fits=fits)


def _name() -> Column:
    return F.lower(F.concat_ws(" ", "genus", "species"))


def _segment(size: str, i: str, distance: int) -> tuple[str, str]:
    """Start and length of the i-th of distance + 1 segments of a name, as even as can be, the longer ones last."""
    n = distance + 1
    rest = f"({size} % {n})"
    return (f"({i} * ({size} DIV {n}) + greatest(0, {i} - ({n} - {rest})))",
            f"({size} DIV {n} + if({i} >= {n} - {rest}, 1, 0))")


def _keys(name: str, distance: int) -> Column:
    """Keys of a known name: its length with each of its segments; a name of up to ``distance`` letters has but one."""
    size = f"int(length({name}))"
    start, length = _segment(size, "i", distance)
    parts = f"transform(sequence(0, {distance}), i -> struct({size} AS size, i AS part, substring({name}, int({start}) + 1, int({length})) AS text))"
    return F.expr(f"if({size} <= {distance}, array(struct({size} AS size, -1 AS part, '' AS text)), {parts})")


def _probes(name: str, distance: int) -> Column:
    """Keys under which a known name within ``distance`` edits must stand: of the segments of a name of each possible
    length one is untouched, and has moved by no more places than there are edits."""
    size = f"int(length({name}))"
    start, length = _segment("size", "i", distance)
    spots = (f"transform(filter(sequence(-{distance}, {distance}), by -> {start} + by >= 0 AND {start} + by + {length} <= {size}), "
             f"by -> struct(size AS size, i AS part, substring({name}, int({start} + by) + 1, int({length})) AS text))")
    segments = f"flatten(transform(sequence(0, {distance}), i -> {spots}))"
    return F.expr(
        f"array_distinct(flatten(transform(sequence(greatest(0, {size} - {distance}), {size} + {distance}), size -> "
        f"if(size <= {distance}, array(struct(size AS size, -1 AS part, '' AS text)), {segments}))))")


def near_names(unknown: DataFrame, known: DataFrame, name: str = "name", distance: int = DISTANCE) -> DataFrame:
    """name, known_name, distance: all pairs of names within ``distance`` edits, by an equi join.

    A known name is cut into ``distance`` + 1 segments; within that many edits one of them is left as it is.  Pairs that
    share one at the right place are confirmed by their edit distance, so nothing is missed and nothing is compared
    that shares no segment.  Both tables may be large; equal names are compared once.
    """
    left = unknown.select(F.col(name).alias("name")).distinct().select("name", F.explode(_probes("name", distance)).alias("key"))
    right = known.select(F.col(name).alias("known_name")).distinct().select("known_name", F.explode(_keys("known_name", distance)).alias("key"))
    pairs = left.join(right, "key").select("name", "known_name").distinct()
    return pairs.withColumn("distance", F.levenshtein("name", "known_name", distance)).where("distance >= 0")


def suggest_synonyms(obs: DataFrame, life_history: DataFrame, distance: int = DISTANCE,
                     ignore: Sequence[str] = ("spp",), fits: bool | None = None) -> DataFrame:
    """For each unknown taxon the known one with the nearest name, in the columns of a synonym table.

    family, genus, species, rows, new_family, new_genus, new_species, distance.  Genus and species are compared
    together, whatever their case; of equally near names one of the same family comes first, then the first in
    alphabetical order.  A taxon with no name within ``distance`` edits has no row.
    """
    unknown = unknown_taxa(obs, life_history, ignore, fits).withColumn("name", _name())
    known = life_history.select(*TAXON).distinct().withColumn("name", _name())
    near = near_names(unknown, known, "name", distance)
    named = known.select(F.col("name").alias("known_name"), *[F.col(t).alias(n) for t, n in zip(TAXON, _NEW, strict=True)])
    met = unknown.join(near, "name").join(named, "known_name")
    order = F.struct("distance", ~F.col("family").eqNullSafe(F.col("new_family")), *_NEW)
    best = met.groupBy(*TAXON, "rows").agg(F.min_by(F.struct(*_NEW, "distance"), order).alias("best"))
    return best.select(*TAXON, "rows", "best.*")


def suggest_reclassified(obs: DataFrame, life_history: DataFrame, ignore: Sequence[str] = ("spp",),
                         fits: bool | None = None) -> DataFrame:
    """Known taxa that an unknown one may have been moved to: its species under another genus of the family, or its
    genus and species under another family.  One row for each such taxon, with the part that ``moved``."""
    unknown = unknown_taxa(obs, life_history, ignore, fits)
    known = life_history.select(*[F.col(t).alias(n) for t, n in zip(TAXON, _NEW, strict=True)]).distinct()
    tables = []
    for moved in ("genus", "family"):
        same = [F.col(t) == F.col(f"new_{t}") for t in TAXON if t != moved]
        tables.append(unknown.join(hinted(known, fits), same).select(*TAXON, "rows", *_NEW, F.lit(moved).alias("moved")))
    return tables[0].unionByName(tables[1])


def _full(parts: Sequence[str], alias: str) -> Column:
    return F.struct(*[F.coalesce(p, F.lit(_GAP)).alias(t) for p, t in zip(parts, TAXON, strict=True)]).alias(alias)


def _label(x: str) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.col(f"{x}.{t}"), F.lit(_GAP)) for t in TAXON])


def resolve_synonyms(synonyms: DataFrame) -> DataFrame:
    """The synonym table with chains followed to their end: A to B and B to C gives A to C, in whatever order.

    Each round doubles the steps that every name has gone, so a chain of n names takes log n joins.  Names that go
    round in a circle have no end; they end the job with an error that names them.  An empty new part keeps
    the old one; contradictory synonyms are an error, a name that stays as it is has no row.
    """
    once = one_name_each(synonyms)
    steps = once.select(_full(TAXON, "old"), _full([F.coalesce(n, t) for n, t in zip(_NEW, TAXON, strict=True)], "new")).where("old <> new")
    now, done = stored(steps, "synonyms"), 1
    most = now.count()
    while True:
        further = now.select(F.col("old").alias("_from"), F.col("new").alias("_to"))
        joined = now.join(further, F.col("new") == F.col("_from"), "left")
        after = stored(joined.select("old", F.coalesce("_to", "new").alias("new"), F.col("_from").isNotNull().alias("going")), "synonyms")
        if after.where("going").isEmpty():
            break
        if done > most:  # every name has gone more steps than there are names, so those that still go are in a circle
            names = after.where("going").select(_label("new").alias("name")).distinct().orderBy("name").limit(20)
            raise ValueError("synonyms go round in a circle: " + ", ".join(r["name"] for r in names.collect()))
        now, done = after.drop("going"), done * 2
    ends = [F.nullif(F.col(f"{x}.{t}"), F.lit(_GAP)).alias(n) for x, names in (("old", TAXON), ("new", _NEW)) for t, n in zip(TAXON, names, strict=True)]
    return after.select(*ends)


def has_chains(synonyms: DataFrame) -> bool:
    """Whether some new name is itself an old one."""
    new = synonyms.select(*[F.coalesce(n, t).alias(t) for n, t in zip(_NEW, TAXON, strict=True)])
    changed = synonyms.where(" OR ".join(f"(new_{t} IS NOT NULL AND NOT new_{t} <=> {t})" for t in TAXON))
    return not join_on(new.distinct(), changed.select(*TAXON).distinct(), TAXON, "left_semi").isEmpty()
