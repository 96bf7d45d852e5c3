"""The four stages: gather, check, format, habitat; and campaign information."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.plans import check, format as fmt, gather, habitat as hab
from fathomframe.plans.info import campaign_info_wide
from registry.book import query, rounded
from registry.files import fresh
from registry.rows import BROAD_NAMES

_KEYS = "campaignid, sample, family, genus, species"
_TAXON_EQ = ("{0}.family IS NOT DISTINCT FROM {1}.family AND {0}.genus IS NOT DISTINCT FROM "
             "{1}.genus AND {0}.species IS NOT DISTINCT FROM {1}.species")


def _taxon_eq(a: str, b: str) -> str:
    return _TAXON_EQ.format(a, b)


# ---------------------------------------------------------------- gather

@query("build_maxn", """SELECT x.campaignid, x.sample, family, genus, species, maxn, periodtime,
      location, status, depth, successful_count, successful_length
    FROM (
      SELECT campaignid, sample, family, genus, species, max(n) AS maxn,
        arg_min(t, struct_pack(a := -n, b := t)) AS periodtime
      FROM (SELECT campaignid, sample, family, genus, species, frame, sum(number) AS n,
              min(periodtime) AS t FROM points GROUP BY ALL)
      GROUP BY ALL
      UNION ALL SELECT campaignid, sample, family, genus, species, "count", NULL FROM count_role) x
    JOIN metadata m ON x.campaignid = m.campaignid AND x.sample = m.sample
    WHERE successful_count = 'Yes' AND maxn > 0""")
def _(r):
    return gather.build_maxn(r.points(), r.count(), r.metadata())


@query("build_length3d", """SELECT l.campaignid, l.sample, family, genus, species, length, number,
      l.range, location, status, depth, successful_count, successful_length
    FROM length_role l JOIN metadata m ON l.campaignid = m.campaignid AND l.sample = m.sample
    WHERE successful_length = 'Yes'""")
def _(r):
    rows = r.length().withColumn("time", F.lit("0:00"))
    generic = rows.filter("legal_sublegal = 'F' AND length IS NOT NULL").drop("legal_sublegal")
    em = rows.filter("legal_sublegal = 'O' AND length IS NOT NULL").drop("legal_sublegal")
    located = rows.filter("length IS NULL").drop("legal_sublegal", "length")
    return gather.build_length3d(generic, em, located, r.metadata())


@query("complete_count", """SELECT a.project, a.campaignid, a.sample, a.family, a.genus, a.species,
      b.legal_sublegal, coalesce(c."count", 0.0) AS "count", location, status, depth,
      successful_count, successful_length
    FROM (SELECT DISTINCT project, campaignid, sample, family, genus, species FROM count_role) a
    CROSS JOIN (SELECT DISTINCT legal_sublegal FROM count_role) b
    LEFT JOIN count_role c ON a.campaignid = c.campaignid AND a.sample = c.sample
      AND a.genus = c.genus AND a.species = c.species AND b.legal_sublegal = c.legal_sublegal
    LEFT JOIN metadata m ON a.campaignid = m.campaignid AND a.sample = m.sample""")
def _(r):
    return gather.complete_count(r.count(), r.metadata())


# ---------------------------------------------------------------- check

@query("load_life_history", """SELECT DISTINCT family, genus, species, marine_region,
      length_measure, round(a, 6) AS a, round(b, 6) AS b, "all", bll, fb_length_max, fb_ltypemaxm
    FROM life_history WHERE marine_region LIKE '%NW%' AND family <> 'SMALL'""")
def _(r):
    """The sheet lists SMALL taxa for another country only."""
    return rounded(check.load_life_history(r.life_history_sheet()), digits=6)


_RENAMED = f"""SELECT l.* REPLACE (coalesce(new_family, l.family) AS family,
      coalesce(new_genus, l.genus) AS genus, coalesce(new_species, l.species) AS species)
    FROM maxn_role l LEFT JOIN synonyms s ON {_taxon_eq('l', 's')}"""


@query("apply_synonyms", _RENAMED)
def _(r):
    return check.apply_synonyms(r.maxn(), r.synonyms())[0]


@query("synonym_report", f"""SELECT DISTINCT s.* FROM maxn_role l JOIN synonyms s
    ON {_taxon_eq('l', 's')}""")
def _(r):
    return check.apply_synonyms(r.maxn(), r.synonyms())[1]


def _unobserved(table: str) -> str:
    return f"""SELECT DISTINCT {_KEYS} FROM {table} l WHERE species <> 'sp1' AND NOT EXISTS (
      SELECT 1 FROM life_history h WHERE {_taxon_eq('l', 'h')})"""


@query("taxa_not_observed_maxn", _unobserved("maxn_role"))
def _(r):
    return check.taxa_not_observed(r.maxn(), r.life_history(), ignore=["sp1"])


@query("taxa_not_observed_length", _unobserved("observed"))
def _(r):
    return check.taxa_not_observed(r.observed(), r.life_history(), ignore=["sp1"])


_BOUNDS = """SELECT h.* REPLACE (coalesce(fb_length_max, g.m, f.m) AS fb_length_max),
      0.15::DOUBLE * coalesce(fb_length_max, g.m, f.m) AS min_length,
      0.85::DOUBLE * coalesce(fb_length_max, g.m, f.m) AS max_length
    FROM life_history h
    LEFT JOIN (SELECT genus, avg(fb_length_max) AS m FROM life_history
               WHERE fb_length_max IS NOT NULL GROUP BY genus) g
      ON h.genus IS NOT DISTINCT FROM g.genus
    LEFT JOIN (SELECT family, avg(fb_length_max) AS m FROM life_history
               WHERE fb_length_max IS NOT NULL GROUP BY family) f
      ON h.family IS NOT DISTINCT FROM f.family"""
_WRONG = f"""SELECT campaignid, sample, l.family, l.genus, l.species, length, min_length, max_length,
      fb_length_max, CASE WHEN length < min_length THEN 'too small' ELSE 'too big' END AS reason,
      CASE WHEN length < min_length THEN min_length - length ELSE length - max_length END
        AS difference, length / fb_length_max * 100 AS percent_of_fb_max
    FROM observed l JOIN bounds b ON {_taxon_eq('l', 'b')}
    WHERE length < min_length OR length > max_length"""
_CHECKS = {"bounds": _BOUNDS, "wrong": _WRONG,
           "bad_length": _unobserved("observed").replace("sp1", "spp"),
           "bad_maxn": _unobserved("maxn_role").replace("sp1", "spp")}


@query("max_length_bounds", """SELECT family, genus, species, marine_region, length_measure,
      round(a, 4) AS a, round(b, 4) AS b, "all", bll, round(fb_length_max, 4) AS fb_length_max,
      fb_ltypemaxm, round(min_length, 4) AS min_length, round(max_length, 4) AS max_length
    FROM bounds""", _CHECKS)
def _(r):
    return rounded(check.max_length_bounds(r.life_history()))


@query("wrong_length_taxa", f"""SELECT {_KEYS}, length, round(min_length, 4) AS min_length,
      round(max_length, 4) AS max_length, round(fb_length_max, 4) AS fb_length_max, reason,
      round(difference, 4) AS difference, round(percent_of_fb_max, 4) AS percent_of_fb_max
    FROM wrong""", _CHECKS)
def _(r):
    return rounded(check.wrong_length_taxa(
        r.observed(), check.max_length_bounds(r.life_history())))


@query("wrong_length_legacy", f"""SELECT campaignid, sample, l.family, l.genus, l.species, length,
      round(top, 4) AS fb_length_max, fb_ltypemaxm,
      round((length - top) / top * 100, 4) AS percent_error
    FROM observed l JOIN (
      SELECT h.family, genus, species, fb_ltypemaxm, coalesce(fb_length_max, m) AS top
      FROM life_history h LEFT JOIN (
        SELECT family, avg(coalesce(fb_length_max, 0.0)) AS m FROM life_history GROUP BY family) f
      ON h.family = f.family AND m <> 0) b ON {_taxon_eq('l', 'b')}
    WHERE length >= top""")
def _(r):
    return rounded(check.wrong_length_legacy(r.observed(), r.life_history()))


_STEREO = f"SELECT {_KEYS}, sum(number) AS stereo_maxn FROM observed GROUP BY ALL"


@query("maxn_vs_stereo", f"""SELECT {_KEYS}, maxn, stereo_maxn, abs(maxn - stereo_maxn) AS difference,
      round(abs(CASE WHEN maxn = 0 THEN NULL ELSE (maxn - stereo_maxn) / maxn END * 100), 4)
        AS percent_difference
    FROM (SELECT s.*, coalesce(m.maxn, 0.0) AS maxn FROM stereo s
      LEFT JOIN maxn_role m ON s.campaignid = m.campaignid AND s.sample = m.sample
        AND {_taxon_eq('s', 'm')})
    WHERE maxn <> stereo_maxn""", {"stereo": _STEREO})
def _(r):
    return rounded(check.maxn_vs_stereo(r.observed(), r.maxn()), "percent_difference")


@query("maxn_vs_stereo_all", f"""SELECT {_KEYS}, maxn, stereo_maxn,
      abs(maxn - stereo_maxn) AS difference,
      round(abs(CASE WHEN maxn = 0 THEN NULL ELSE (maxn - stereo_maxn) / maxn END * 100), 4)
        AS percent_difference
    FROM (SELECT coalesce(s.campaignid, m.campaignid) AS campaignid,
        coalesce(s.sample, m.sample) AS sample, coalesce(s.family, m.family) AS family,
        coalesce(s.genus, m.genus) AS genus, coalesce(s.species, m.species) AS species,
        coalesce(stereo_maxn, 0.0) AS stereo_maxn, coalesce(m.maxn, 0.0) AS maxn
      FROM stereo s FULL JOIN maxn_role m ON s.campaignid = m.campaignid AND s.sample = m.sample
        AND {_taxon_eq('s', 'm')}) x
    WHERE maxn <> stereo_maxn AND EXISTS (SELECT 1 FROM observed o
      WHERE o.campaignid = x.campaignid AND o.sample = x.sample)""", {"stereo": _STEREO})
def _(r):
    gaps = check.maxn_vs_stereo(r.observed(), r.maxn(), include_unmeasured=True)
    return rounded(gaps, "percent_difference")


_OBS = f"{_KEYS}, length, number, l.range"


@query("drop_errors_range", f"SELECT {_OBS} FROM observed l WHERE l.range < 10000")
def _(r):
    return check.drop_errors(r.maxn(), r.observed(), None, None, None)[1]


@query("drop_errors_taxa", f"""SELECT {_KEYS}, maxn FROM maxn_role l WHERE NOT EXISTS (
      SELECT 1 FROM bad_maxn b WHERE b.campaignid = l.campaignid AND b.sample = l.sample
        AND {_taxon_eq('l', 'b')})""", _CHECKS)
def _(r):
    bad = check.taxa_not_observed(r.maxn(), r.life_history())
    return check.drop_errors(r.maxn(), r.observed(), bad, None, None)[0]


@query("drop_errors_length", f"""SELECT {_OBS} FROM observed l
    WHERE l.range < 10000 AND NOT EXISTS (SELECT 1 FROM bad_length b
        WHERE b.campaignid = l.campaignid AND b.sample = l.sample AND {_taxon_eq('l', 'b')})
      AND NOT EXISTS (SELECT 1 FROM wrong w WHERE {_taxon_eq('l', 'w')}
        AND l.length IS NOT DISTINCT FROM w.length)""", _CHECKS)
def _(r):
    length, lh = r.observed(), r.life_history()
    bad = check.taxa_not_observed(length, lh)
    wrong = check.wrong_length_taxa(length, check.max_length_bounds(lh))
    return check.drop_errors(r.maxn(), length, None, bad, wrong)[1]


@query("drop_errors_length_per_sample", f"""SELECT {_OBS} FROM observed l
    WHERE NOT EXISTS (SELECT 1 FROM wrong w WHERE {_taxon_eq('l', 'w')}
        AND w.campaignid = l.campaignid AND w.sample = l.sample
        AND l.length IS NOT DISTINCT FROM w.length)""", _CHECKS)
def _(r):
    length = r.observed()
    wrong = check.wrong_length_taxa(length, check.max_length_bounds(r.life_history()))
    return check.drop_wrong_lengths(length, wrong, per_sample=True)


@query("drop_unknown_taxa", f"""SELECT {_OBS} FROM observed l WHERE NOT EXISTS (
      SELECT 1 FROM bad_length b WHERE b.campaignid = l.campaignid AND b.sample = l.sample
        AND {_taxon_eq('l', 'b')})""", _CHECKS)
def _(r):
    return check.drop_unknown_taxa(r.observed(), r.life_history())


@query("drop_implausible_lengths", f"""SELECT {_OBS} FROM observed l WHERE NOT EXISTS (
      SELECT 1 FROM wrong w WHERE {_taxon_eq('l', 'w')}
        AND l.length IS NOT DISTINCT FROM w.length)""", _CHECKS)
def _(r):
    return check.drop_implausible_lengths(r.observed(), check.max_length_bounds(r.life_history()))


# ---------------------------------------------------------------- format

_META = "location, status, depth, successful_count, successful_length"
_FORMAT = {
    # PROMO stands for fish that could not be named.
    "named_maxn": "SELECT * REPLACE (CASE WHEN family = 'PROMO' THEN 'Unknown' ELSE family END "
                  "AS family) FROM maxn_role",
    "named_length": "SELECT * REPLACE (CASE WHEN family = 'PROMO' THEN 'Unknown' ELSE family END "
                    "AS family) FROM observed",
    "every_row": """SELECT m.campaignid, m.sample, family, genus, species, length, number,
          l.range AS range
        FROM (SELECT * FROM named_length WHERE family <> 'Unknown') l
        RIGHT JOIN metadata m ON l.campaignid = m.campaignid AND l.sample = m.sample""",
    "completed": f"""SELECT a.campaignid, a.sample, b.family, b.genus, b.species, length,
          coalesce(number, 0.0) AS number, e.range AS range
        FROM (SELECT DISTINCT campaignid, sample FROM every_row) a
        CROSS JOIN (SELECT DISTINCT family, genus, species FROM every_row) b
        LEFT JOIN every_row e ON a.campaignid = e.campaignid AND a.sample = e.sample
          AND {_taxon_eq('b', 'e')}""",
    "family_lw": """SELECT family, length_measure, a, b, "all", bll, rank FROM (
          SELECT *, min(rank) OVER (PARTITION BY family) AS best FROM (
            SELECT family, length_measure, pow(10, avg(log10(a))) AS a, avg(b) AS b,
              coalesce(avg("all"), 0.0) AS "all", coalesce(avg(bll), 1.0) AS bll,
              CASE length_measure WHEN 'FL' THEN 1 WHEN 'TL' THEN 2 ELSE 3 END::INTEGER AS rank
            FROM life_history GROUP BY ALL) WHERE a IS NOT NULL)
        WHERE rank = best""",
    "mass": """SELECT *, length / 10 AS length_cm, pow(length / 10
            * CASE WHEN bll IS NULL AND length_measure IN ('TL','FL','SL') THEN 1.0 ELSE bll END
            + CASE WHEN "all" IS NULL AND length_measure IN ('TL','FL','SL') THEN 0.0 ELSE "all" END,
            b) * a * number AS mass_g
        FROM (
          SELECT c.*, length_measure, a, b, "all", bll FROM completed c
          JOIN life_history h ON c.genus IS NOT DISTINCT FROM h.genus
            AND c.species IS NOT DISTINCT FROM h.species
          UNION ALL
          SELECT c.*, length_measure, a, b, "all", bll FROM completed c
          LEFT JOIN family_lw f ON c.family IS NOT DISTINCT FROM f.family
          WHERE NOT EXISTS (SELECT 1 FROM life_history h WHERE c.genus IS NOT DISTINCT FROM h.genus
            AND c.species IS NOT DISTINCT FROM h.species))
        WHERE a IS NOT NULL""",
}
_META_JOIN = "JOIN metadata m ON x.campaignid = m.campaignid AND x.sample = m.sample"


def _named(df):
    """PROMO stands for fish that could not be named."""
    return df.withColumn("family", F.when(F.col("family") == "PROMO", "Unknown")
                         .otherwise(F.col("family")))


def _completed(r):
    return fmt.complete_length(_named(r.observed()), r.metadata())


def _taxa(r):
    return fmt.completed_taxa(_named(r.observed()), r.metadata())


def _mass(r, key=C.SAMPLE):
    fresh(r)
    return fmt.complete_mass(_named(r.observed()), r.metadata(), r.life_history(), key)


@query("complete_maxn", f"""SELECT x.campaignid, x.sample, family, genus, species, maxn, {_META},
      concat(family, ' ', genus, ' ', species) AS scientific,
      concat(x.campaignid, '.', x.sample) AS id
    FROM (SELECT a.campaignid, a.sample, b.family, b.genus, b.species,
        sum(coalesce(maxn, 0.0)) AS maxn
      FROM (SELECT DISTINCT campaignid, sample FROM named_maxn) a
      CROSS JOIN (SELECT DISTINCT family, genus, species FROM named_maxn) b
      LEFT JOIN named_maxn n ON n.campaignid = a.campaignid AND n.sample = a.sample
        AND {_taxon_eq('n', 'b')} GROUP BY ALL) x {_META_JOIN}
    WHERE family <> 'Unknown'""", _FORMAT)
def _(r):
    return fmt.complete_maxn(_named(r.maxn()), r.metadata())


@query("complete_maxn_by_sample", f"""SELECT m.campaignid, x.sample, family, genus, species, maxn,
      {_META}, concat(family, ' ', genus, ' ', species) AS scientific,
      concat(m.campaignid, '.', x.sample) AS id
    FROM (SELECT a.sample, b.family, b.genus, b.species, sum(coalesce(maxn, 0.0)) AS maxn
      FROM (SELECT DISTINCT sample FROM named_maxn) a
      CROSS JOIN (SELECT DISTINCT family, genus, species FROM named_maxn) b
      LEFT JOIN named_maxn n ON n.sample = a.sample AND {_taxon_eq('n', 'b')} GROUP BY ALL) x
    JOIN metadata m ON x.sample = m.sample WHERE family <> 'Unknown'""", _FORMAT)
def _(r):
    return fmt.complete_maxn(_named(r.maxn()), r.metadata(), key=["sample"])


@query("complete_length", f"""SELECT x.campaignid, x.sample, family, genus, species, length, number,
      x.range, {_META}, concat(x.campaignid, '.', x.sample) AS id
    FROM completed x LEFT {_META_JOIN}""", _FORMAT)
def _(r):
    return _completed(r)


@query("expanded_length", f"""SELECT x.campaignid, x.sample, family, genus, species, length,
      x.range, {_META}, concat(x.campaignid, '.', x.sample) AS id
    FROM completed x LEFT {_META_JOIN} JOIN generate_series(1, 7) g(i) ON i <= number
    WHERE length IS NOT NULL""", _FORMAT)
def _(r):
    return fmt.expanded_length(_completed(r))


def _missing(keys: list[str]) -> str:
    match = " AND ".join(f"c.{k} IS NOT DISTINCT FROM h.{k}" for k in keys)
    return (f"SELECT DISTINCT {', '.join(keys)} FROM completed c WHERE NOT EXISTS "
            f"(SELECT 1 FROM life_history h WHERE a IS NOT NULL AND {match})")


@query("missing_lw_species", _missing(["family", "genus", "species"]), _FORMAT)
def _(r):
    return fmt.missing_length_weight(_taxa(r), r.life_history(), "species")


@query("missing_lw_genus", _missing(["genus"]), _FORMAT)
def _(r):
    return fmt.missing_length_weight(_taxa(r), r.life_history(), "genus")


@query("missing_lw_family", _missing(["family"]), _FORMAT)
def _(r):
    return fmt.missing_length_weight(_taxa(r), r.life_history(), "family")


@query("family_length_weight", """SELECT family, length_measure, round(a, 6) AS a,
      round(b, 6) AS b, round("all", 6) AS "all", round(bll, 6) AS bll, rank FROM family_lw""",
       _FORMAT)
def _(r):
    return rounded(fmt.family_length_weight(r.life_history()), digits=6)


@query("length_to_mass", f"""SELECT x.campaignid, x.sample, family, genus, species, length,
      x.range, number, round(mass_g, 4) AS mass_g, length_cm, {_META},
      concat(x.campaignid, '.', x.sample) AS id
    FROM mass x LEFT {_META_JOIN}""", _FORMAT)
def _(r):
    return rounded(_mass(r), "mass_g")


@query("length_to_mass_completed", f"""SELECT x.campaignid, x.sample, family, genus, species, length,
      x.range, number, round(mass_g, 4) AS mass_g, length_cm, {_META},
      concat(x.campaignid, '.', x.sample) AS id
    FROM mass x LEFT {_META_JOIN}""", _FORMAT)
def _(r):
    """From a table that was completed before."""
    return rounded(fmt.length_to_mass(_completed(r), r.life_history()), "mass_g")


@query("length_to_mass_by_sample", f"""SELECT m.campaignid, x.sample, family, genus, species, length,
      x.range, number, round(mass_g, 4) AS mass_g, length_cm, {_META}
    FROM mass x JOIN metadata m ON x.sample = m.sample""", _FORMAT)
def _(r):
    return rounded(_mass(r, ["sample"]), "mass_g")


@query("check_mass", """SELECT family, genus, species, round(avg(kg), 3) AS mean_kg,
      round(max(kg), 3) AS max_kg, round(min(kg), 3) AS min_kg, min(cm) AS min_length,
      round(avg(cm), 2) AS mean_length, max(cm) AS max_length
    FROM (SELECT family, genus, species, mass_g / number / 1000 AS kg,
            round(length / 10, 2) AS cm FROM mass WHERE mass_g > 0) GROUP BY ALL""", _FORMAT)
def _(r):
    return fmt.check_mass(fmt.observed_mass(_named(r.observed()), r.metadata(), r.life_history()))


# ---------------------------------------------------------------- habitat

_BROAD_VALUES = {
    "relief_0": "relief_0_flat", "relief_1": "relief_1_some", "relief_2": "relief_2_mostly",
    "relief_3": "relief_3_good", "relief_4": "relief_4_high",
    "fieldofview_limited": "fieldofview_limited", "fieldofview_open": "fieldofview_open",
    "biota_sponges": "sponges_cups + sponges_tubes", "biota_macroalgae": "macroalgae",
    "biota_unconsolidated": "sand"}
_BROAD_COLUMNS = [*hab.RELIEF, *hab.FIELD_OF_VIEW, *(f"biota_{b}" for b in hab.BIOTA)]
_BIOTA = [c for c in _BROAD_COLUMNS if c.startswith("biota_")]


def _share(cols, empty: str) -> str:
    total = " + ".join(cols)
    return ", ".join(f"round(CASE WHEN {total} = 0 THEN {empty} ELSE {c} / ({total}) END * 100, 4)"
                     f" AS {c}" for c in cols)


_HABITAT = {
    "broad_role": "SELECT concat(campaignid, '.', sample) AS id, sample, campaignid, project, "
                  + ", ".join(f"{_BROAD_VALUES.get(c, '0.0::DOUBLE')} AS {c}"
                              for c in _BROAD_COLUMNS) + " FROM habitat",
    "fov_pct": f"SELECT campaignid, sample, {_share(hab.FIELD_OF_VIEW, 'NULL')} FROM broad_role",
    "broad_pct": f"SELECT campaignid, sample, {_share(_BIOTA, '0.0')} FROM broad_role",
    "relief_pts": " UNION ALL ".join(
        f"SELECT campaignid, sample, {i}.0::DOUBLE AS score FROM broad_role "
        f"JOIN generate_series(1, 1000) g(i) ON i <= relief_{i}" for i in range(6)),
    "relief_role": """SELECT campaignid, sample, round(avg(score), 4) AS mean_relief,
        round(stddev_samp(score), 4) AS sd_relief FROM relief_pts GROUP BY ALL""",
}


def _broad(r):
    return hab.habitat_broad(r.habitat(), BROAD_NAMES)


@query("habitat_broad", "SELECT * FROM broad_role", _HABITAT)
def _(r):
    return _broad(r)


@query("fov_percent", "SELECT * FROM fov_pct", _HABITAT)
def _(r):
    return rounded(hab.fov_percent(_broad(r)))


@query("relief_stats", "SELECT * FROM relief_role", _HABITAT)
def _(r):
    return rounded(hab.relief_stats(_broad(r)))


@query("broad_percent", "SELECT * FROM broad_pct", _HABITAT)
def _(r):
    return rounded(hab.broad_percent(_broad(r)))


@query("complete_habitat", "SELECT x.campaignid, x.sample, mean_relief, sd_relief, "
       + ", ".join(hab.FIELD_OF_VIEW) + ", "
       + ", ".join(f"{c} AS {c.replace('biota_', '')}" for c in _BIOTA)
       + f""", {_META}, concat(x.campaignid, '.', x.sample) AS id
    FROM (SELECT coalesce(a.campaignid, f.campaignid) AS campaignid,
        coalesce(a.sample, f.sample) AS sample, a.mean_relief, a.sd_relief,
        f.* EXCLUDE (campaignid, sample), b.* EXCLUDE (campaignid, sample)
      FROM relief_role a FULL JOIN fov_pct f ON a.campaignid = f.campaignid AND a.sample = f.sample
      FULL JOIN broad_pct b ON b.campaignid = f.campaignid AND b.sample = f.sample) x
    {_META_JOIN}""", _HABITAT)
def _(r):
    h = _broad(r)
    return rounded(hab.complete_habitat(
        hab.relief_stats(h), hab.fov_percent(h), hab.broad_percent(h), r.metadata()))


# ---------------------------------------------------------------- information

# The names of the pairs in the given data.
INFO_NAMES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("campaign_info_wide", "SELECT project, campaignid, " + ", ".join(
    f"max(CASE WHEN name = '{n}' THEN value END) AS \"{n}\"" for n in INFO_NAMES)
    + " FROM info GROUP BY project, campaignid")
def _(r):
    return campaign_info_wide(r.info(), INFO_NAMES)
