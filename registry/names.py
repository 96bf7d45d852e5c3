"""Names of taxa: suggestions for unknown ones, and chains of renamings."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.plans import check, decisions, names
from registry.book import query
from registry.files import fresh

_UNKNOWN = """SELECT family, genus, species, count(*) AS "rows" FROM misspelt m
    WHERE species <> 'sp1x' AND NOT EXISTS (SELECT 1 FROM life_history h
        WHERE h.family = m.family AND h.genus = m.genus AND h.species = m.species) GROUP BY ALL"""
_NAMES = {
    "misspelt": """SELECT campaignid, sample, family, CASE WHEN maxn > 30 THEN replace(genus, 'Brand', 'Bramd')
          WHEN sample LIKE '%3' THEN left(genus, length(genus) - 1) ELSE genus END AS genus,
          CASE WHEN sample LIKE '%7' THEN concat(species, 'x') ELSE species END AS species, maxn FROM maxn_role""",
    "unknown": _UNKNOWN,
    "pairs": """SELECT u.*, h.family AS new_family, h.genus AS new_genus, h.species AS new_species,
          levenshtein(lower(concat(u.genus, ' ', u.species)), lower(concat(h.genus, ' ', h.species))) AS distance
        FROM unknown u, life_history h""",
    "moves": """SELECT family, genus, species, family AS new_family, concat(family, '-Brand#', k + 1) AS new_genus,
          CASE WHEN k = 3 THEN 'sp0' END AS new_species
        FROM (SELECT *, split_part(genus, '#', 2)::INTEGER AS k FROM taxa) WHERE k % 10 <> 0""",
    "ends": """WITH RECURSIVE walk AS (
          SELECT family, genus, species, new_family, new_genus, coalesce(new_species, species) AS new_species FROM moves
          UNION ALL SELECT w.family, w.genus, w.species, m.new_family, m.new_genus, coalesce(m.new_species, m.species)
          FROM walk w JOIN moves m ON m.family = w.new_family AND m.genus = w.new_genus AND m.species = w.new_species)
        SELECT * FROM walk w WHERE NOT EXISTS (SELECT 1 FROM moves m
            WHERE m.family = w.new_family AND m.genus = w.new_genus AND m.species = w.new_species)""",
}


def _misspelt(r):
    genus = F.when(F.col("maxn") > 30, F.replace(F.col("genus"), F.lit("Brand"), F.lit("Bramd"))).when(
        F.col("sample").endswith("3"), F.expr("left(genus, length(genus) - 1)")).otherwise(F.col("genus"))
    species = F.when(F.col("sample").endswith("7"), F.concat("species", F.lit("x"))).otherwise(F.col("species"))
    return r.maxn().withColumns({"genus": genus, "species": species})


def _moves(r):
    """Each brand moves to the next one, those of ten brands in a chain."""
    k = F.substring_index("genus", "#", -1).cast("int")
    return r.taxa().withColumn("k", k).where("k % 10 <> 0").select(
        *C.TAXON, F.col("family").alias("new_family"), F.concat("family", F.lit("-Brand#"), F.col("k") + 1).alias("new_genus"),
        F.when(F.col("k") == 3, "sp0").alias("new_species"))


@query("suggest_synonyms", """SELECT family, genus, species, "rows", new_family, new_genus, new_species, distance::INTEGER AS distance
    FROM pairs WHERE distance <= 2 QUALIFY row_number() OVER (PARTITION BY family, genus, species
        ORDER BY distance, new_family <> family, new_family, new_genus, new_species) = 1""", _NAMES)
def _(r):
    return names.suggest_synonyms(_misspelt(r), r.life_history(), 2, ignore=["sp1x"])


@query("suggest_reclassified", """SELECT u.*, h.family AS new_family, h.genus AS new_genus, h.species AS new_species,
      CASE WHEN h.family = u.family THEN 'genus' ELSE 'family' END AS moved
    FROM unknown u JOIN life_history h ON h.species = u.species
      AND ((h.family = u.family AND h.genus <> u.genus) OR (h.genus = u.genus AND h.family <> u.family))""", _NAMES)
def _(r):
    return names.suggest_reclassified(_misspelt(r), r.life_history(), ignore=["sp1x"])


@query("synonym_chains", """SELECT l.* REPLACE (coalesce(new_family, l.family) AS family,
      coalesce(new_genus, l.genus) AS genus, coalesce(new_species, l.species) AS species)
    FROM maxn_role l LEFT JOIN ends s ON l.family = s.family AND l.genus = s.genus AND l.species = s.species""", _NAMES)
def _(r):
    fresh(r)
    return check.apply_synonyms(r.maxn(), names.resolve_synonyms(_moves(r)))[0]


_LOG = {"log": """SELECT DISTINCT CASE WHEN length > 900 THEN 2 ELSE 1 END::BIGINT AS seq,
      CASE WHEN length > 900 THEN 'set' WHEN species = 'sp1' THEN 'keep' ELSE 'drop' END AS action,
      campaignid, sample, family, genus, species, length, CASE WHEN length > 900 THEN 'sp9' END AS new_species
    FROM observed WHERE sample LIKE '%1' AND length > 500
    UNION ALL SELECT DISTINCT 3::BIGINT, 'drop', campaignid, sample, family, genus, species, NULL, NULL
    FROM observed WHERE sample LIKE '%1' AND species = 'sp0'
    UNION ALL SELECT DISTINCT 3::BIGINT, 'drop', campaignid, concat(sample, '?'), family, genus, species, length, NULL
    FROM observed WHERE sample LIKE '%2' AND length > 900"""}
_SAME = " AND ".join(f"l.{c} IS NOT DISTINCT FROM d.{c}" for c in (*C.SAMPLE, *C.TAXON))


def _log(r):
    """Long fish renamed, others dropped or kept one by one, one species dropped as a whole, and entries that fit nothing."""
    seen = r.observed().where("length > 500 AND sample LIKE '%1'")
    long = seen.where("length > 900").withColumn("new_species", F.lit("sp9"))
    parts = [decisions.as_decisions(long, "set", 2), decisions.as_decisions(seen.where("length <= 900 AND species = 'sp1'"), "keep", 1),
             decisions.as_decisions(seen.where("length <= 900 AND species <> 'sp1'"), "drop", 1),
             decisions.as_decisions(r.observed().where("sample LIKE '%1' AND species = 'sp0'").drop("length"), "drop", 3),
             decisions.as_decisions(r.observed().where("sample LIKE '%2' AND length > 900").withColumn("sample", F.concat("sample", F.lit("?"))), "drop", 3)]
    log = parts[0]
    for more in parts[1:]:
        log = log.unionByName(more)
    return log


@query("apply_decisions", f"""SELECT l.campaignid, l.sample, l.family, l.genus,
      CASE WHEN coalesce(d.action, g.action) = 'set' THEN coalesce(d.new_species, g.new_species, l.species) ELSE l.species END AS species,
      l.length, number, l.range
    FROM observed l LEFT JOIN log d ON {_SAME} AND l.length = d.length
    LEFT JOIN log g ON {_SAME.replace("d.", "g.")} AND g.length IS NULL
    WHERE coalesce(d.action, g.action, 'keep') <> 'drop'""", _LOG)
def _(r):
    return decisions.apply_decisions(r.observed(), _log(r)).select("campaignid", "sample", *C.TAXON, "length", "number", "range")


@query("stale_decisions", f"""SELECT seq, action, campaignid, sample, family, genus, species, length, new_species FROM log d
    WHERE NOT EXISTS (SELECT 1 FROM observed l WHERE {_SAME} AND (d.length IS NULL OR l.length = d.length))""", _LOG)
def _(r):
    return decisions.stale_decisions(r.observed(), _log(r)).select("seq", "action", *decisions.KEYS, "length", "new_species")
