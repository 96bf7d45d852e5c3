"""Catalog search, column expressions and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.functions.names import clean_names
from fathomframe.operators import filters as flt
from fathomframe.operators.reshape import bind_rows, rename_by_map
from fathomframe.plans import check
from fathomframe.sources import catalog as cat
from fathomframe.sources.files import provenance
from registry.book import query, rounded


def _found(df):
    return df.select("name", "project")


@query("campaign_search_eq",
       "SELECT name, project FROM catalog WHERE name = 'Customer#000000012'")
def _(r):
    return _found(cat.by_name(r.catalog(), "Customer#000000012"))


@query("campaign_search_like", "SELECT name, project FROM catalog WHERE name LIKE '%00001%'")
def _(r):
    return _found(cat.by_pattern(r.catalog(), "%00001%"))


@query("campaign_search_ilike",
       "SELECT name, project FROM catalog WHERE name ILIKE 'customer#%7'")
def _(r):
    return _found(cat.campaign_search(
        r.catalog(), '{"filters":[{"name":"name","op":"ilike","val":"customer#%7"}]}'))


@query("campaign_search_has",
       "SELECT name, project FROM catalog WHERE email = 'nation_7@example.org'")
def _(r):
    return _found(cat.by_user(r.catalog(), "nation_7@example.org"))


@query("campaign_search_any", """SELECT name, project FROM catalog
    WHERE workgroups[1] ILIKE 'a%ca' OR workgroups[2] ILIKE 'a%ca'""")
def _(r):
    return _found(cat.campaign_search(r.catalog(), [{
        "name": "workgroups", "op": "any",
        "val": {"name": "name", "op": "ilike", "val": "a%ca"}}]))


@query("campaign_search_project", "SELECT name, project FROM catalog WHERE project = 'BUILDING'")
def _(r):
    return _found(cat.by_project(r.catalog(), "BUILDING"))


@query("campaign_search_workgroup", """SELECT name, project FROM catalog
    WHERE list_contains(workgroups, 'MIDDLE EAST')""")
def _(r):
    return _found(cat.by_workgroup(r.catalog(), "MIDDLE+EAST"))


@query("campaign_search_all", "SELECT name, project FROM catalog")
def _(r):
    return _found(cat.campaign_search(r.catalog(), ""))


@query("restrict_to_campaigns", """SELECT project, campaignid, name, value FROM (
      SELECT project, concat('Customer#', lpad(campaignid, 9, '0')) AS campaignid, name, value
      FROM info) i
    WHERE campaignid IN (SELECT name FROM catalog WHERE project = 'BUILDING')""")
def _(r):
    info = r.info().withColumn(
        "campaignid", F.concat(F.lit("Customer#"), F.lpad("campaignid", 9, "0")))
    return cat.restrict(info, cat.by_project(r.catalog(), "BUILDING"))


@query("scan_bind_rows", """SELECT campaignid, sample, length, NULL::DOUBLE AS number
      FROM length_role WHERE length IS NOT NULL
    UNION ALL SELECT campaignid, sample, NULL, number FROM length_role WHERE length IS NULL""")
def _(r):
    a = r.length().filter("length IS NOT NULL").select("campaignid", "sample", "length")
    b = r.length().filter("length IS NULL").select("number", "sample", "campaignid")
    return bind_rows(a, b)


@query("provenance_columns", """SELECT 'project-' || (o_custkey % 10) AS project,
      concat(o_orderstatus, '-', o_custkey) AS campaignid, o_orderkey FROM orders""")
def _(r):
    orders = r.read("orders")
    campaign = F.concat("o_orderstatus", F.lit("-"), "o_custkey")
    path = F.concat(F.lit("file:/data/project-"), F.col("o_custkey") % 10, F.lit("/"),
                    campaign, F.lit("/"), campaign, F.lit("_Metadata.csv"))
    return orders.select(*[c.alias(n) for n, c in provenance(path, "_Metadata.csv").items()],
                         "o_orderkey")


@query("provenance_flat", """SELECT concat(o_orderstatus, '-', o_custkey) AS campaignid,
      o_orderkey FROM orders""")
def _(r):
    path = F.concat(F.lit("file:/data/"), "o_orderstatus", F.lit("-"), "o_custkey",
                    F.lit("_Metadata.csv"))
    flat = provenance(path, "_Metadata.csv", layout="flat")
    return r.read("orders").select(*[c.alias(n) for n, c in flat.items()], "o_orderkey")


@query("na_tokens", """SELECT family, nullif(genus, 'NA') AS genus, species,
      nullif(length, '') AS length, number, campaignid, sample, range
    FROM length_raw""")
def _(r):
    return C.null_tokens(r.length_raw(), ["", " ", "NA"])


@query("clean_names", """SELECT s_suppkey AS sample_no, s_name AS done_dd_mm_yy_,
      s_acctbal AS habitat_image_y_n_, s_nationkey AS biota_hydroids FROM supplier""")
def _(r):
    raw = r.read("supplier").select(
        F.col("s_suppkey").alias("Sample-No"), F.col("s_name").alias("Done.(dd/mm/yy)"),
        F.col("s_acctbal").alias("Habitat.Image.(Y/N)"),
        F.col("s_nationkey").alias("Biota: Hydroids "))
    return clean_names(raw)


@query("select_keep", """SELECT campaignid, sample, number, length, family, genus, species
    FROM length_role""")
def _(r):
    return C.select_keep(r.length(), ["campaignid", "sample", "number"], rest=True,
                         drop=["range", "legal_sublegal"])


@query("select_by_prefix", """SELECT campaignid, sample, relief_0_flat, relief_1_some,
      relief_2_mostly, relief_3_good, relief_4_high, sponges_cups, sponges_tubes FROM habitat""")
def _(r):
    return C.select_by_prefix(r.habitat(), "RELIEF_", "sponges", keep=C.SAMPLE)


@query("to_numeric", """SELECT campaignid, sample, TRY_CAST(length AS DOUBLE) AS length,
      TRY_CAST(number AS DOUBLE) AS number FROM length_raw""")
def _(r):
    return C.with_numeric(r.length_raw().select(*C.SAMPLE, "length", "number"),
                          ["length", "number"])


@query("lower_species", """SELECT campaignid, sample, genus, lower(species) AS species
    FROM length_raw""")
def _(r):
    return C.lower_species(r.length_raw().select(*C.SAMPLE, "genus", "species"))


@query("regex_replace_text", """SELECT campaignid, sample, replace(genus, 'NA', 'Unknown') AS genus
    FROM length_raw""")
def _(r):
    return r.length_raw().select(*C.SAMPLE,
                                 C.replace_text("genus", {"NA": "Unknown"}).alias("genus"))


@query("make_key", """SELECT concat(campaignid, '.', sample) AS id,
      concat(coalesce(family, 'NA'), ' ', genus, ' ', coalesce(species, 'NA')) AS scientific,
      concat(coalesce(family, 'NA'), '_', genus, '_', coalesce(species, 'NA'), '_',
             coalesce(length, 'NA')) AS "key"
    FROM length_raw""")
def _(r):
    return r.length_raw().select(C.sample_id().alias("id"),
                                 C.scientific_name().alias("scientific"),
                                 C.length_key().alias("key"))


@query("replace_na_taxa", """SELECT campaignid, sample, coalesce(family, 'Unknown') AS family,
      coalesce(genus, 'Unknown') AS genus, coalesce(species, 'spp') AS species FROM length_raw""")
def _(r):
    return C.fill_taxa(r.length_raw().select(*C.SAMPLE, *C.TAXON))


@query("conditional_value", """SELECT family, genus, species, length_measure,
      CASE WHEN length_measure = 'FL' THEN 1 WHEN length_measure = 'TL' THEN 2
           WHEN length_measure IS NULL THEN NULL ELSE 3 END::INTEGER AS rank,
      coalesce(a, "all", 0.0) AS filled FROM life_history""")
def _(r):
    return r.life_history().select(
        *C.TAXON, "length_measure", C.measure_rank().alias("rank"),
        C.first_present("a", "all", F.lit(0.0)).alias("filled"))


@query("arith", """SELECT campaignid, sample, round(length / 10, 4) AS length_cm,
      round(log10(length), 4) AS log_length, round(pow(10, log10(length)), 4) AS back,
      round(abs(number - 4), 4) AS gap FROM length_role""")
def _(r):
    return rounded(r.length().select(
        *C.SAMPLE, (F.col("length") / 10).alias("length_cm"),
        F.log10("length").alias("log_length"),
        F.pow(F.lit(10.0), F.log10("length")).alias("back"),
        F.abs(F.col("number") - 4).alias("gap")))


_RELIEF = ["relief_0_flat", "relief_1_some", "relief_2_mostly", "relief_3_good", "relief_4_high"]


@query("row_total", """SELECT campaignid, sample, relief_0_flat + relief_1_some + relief_2_mostly
      + relief_3_good + relief_4_high AS total FROM habitat""")
def _(r):
    return r.habitat().select(*C.SAMPLE, C.row_total(_RELIEF).alias("total"))


@query("row_percent", "SELECT campaignid, sample, " + ", ".join(
    f"round(CASE WHEN {'+'.join(_RELIEF)} = 0 THEN NULL ELSE {c} / ({'+'.join(_RELIEF)}) END * 100, 4)"
    f" AS {c}" for c in _RELIEF) + " FROM habitat")
def _(r):
    return rounded(C.row_percent(r.habitat().select(*C.SAMPLE, *_RELIEF), _RELIEF))


# A detailed-to-broad class map, several names to one.
BROAD_NAMES = (("sponges_cups", "sponges"), ("sponges_tubes", "sponges"),
               ("sand", "soft"), ("soft", "unconsolidated"))


@query("rename_by_map", """SELECT campaignid, sample, sponges_cups + sponges_tubes AS sponges,
      sand AS unconsolidated, macroalgae FROM habitat""")
def _(r):
    h = r.habitat().select(*C.SAMPLE, "sponges_cups", "sponges_tubes", "sand", "macroalgae")
    return rename_by_map(h, BROAD_NAMES, C.SAMPLE)


_LEN = "campaignid, sample, family, genus, species, length, number, range"


@query("successful_filter", """SELECT * FROM metadata
    WHERE successful_count = 'Yes' AND successful_length = 'Yes'""")
def _(r):
    return flt.successful(flt.successful(r.metadata(), "count"), "length")


@query("drop_sync_points", f"SELECT {_LEN} FROM length_role WHERE number IS NOT NULL")
def _(r):
    return flt.drop_sync_points(r.length()).drop("legal_sublegal")


@query("three_d_points", f"""SELECT {_LEN} FROM length_role
    WHERE length IS NULL AND number IS NOT NULL""")
def _(r):
    return flt.three_d_points(r.length()).drop("legal_sublegal")


@query("schools", f"SELECT {_LEN} FROM length_role WHERE number > 1")
def _(r):
    return flt.schools(r.length()).drop("legal_sublegal")


@query("out_of_range", f"SELECT {_LEN} FROM length_role l WHERE l.range > 10000")
def _(r):
    return flt.out_of_range(r.length()).drop("legal_sublegal")


@query("within_range", f"SELECT {_LEN} FROM length_role l WHERE l.range < 10000")
def _(r):
    return flt.within_range(r.length()).drop("legal_sublegal")


@query("range_gap", f"""SELECT {_LEN} FROM (
      SELECT * REPLACE (CASE WHEN number IS NOT NULL THEN 10000.0::DOUBLE ELSE l.range END AS range)
      FROM length_role l) g WHERE g.range = 10000""")
def _(r):
    at_limit = r.length().drop("legal_sublegal").withColumn(
        "range", F.when(F.col("number").isNotNull(), 10000.0).otherwise(F.col("range")))
    return flt.range_gap(at_limit)


@query("region_filter", """SELECT family, genus, species, marine_region FROM life_history
    WHERE marine_region LIKE '%NW%' AND family <> 'SMALL'""")
def _(r):
    """The sheet lists SMALL taxa for another country only."""
    return flt.in_region(r.life_history_sheet()).select(*C.TAXON, "marine_region")


@query("exclude_spp", """SELECT campaignid, sample, genus, species FROM (
      SELECT campaignid, sample, genus, coalesce(nullif(species, 'SP1'), 'spp') AS species,
        family FROM length_raw WHERE species IS NOT NULL
      UNION ALL SELECT campaignid, sample, genus, NULL, family FROM length_raw
        WHERE species IS NULL)
    WHERE (species <> 'spp' OR species IS NULL) AND family <> 'PROMO'""")
def _(r):
    raw = r.length_raw().withColumn(
        "species", F.when(F.col("species") == "SP1", "spp").otherwise(F.col("species")))
    kept = flt.exclude_values(raw, "species", ["spp"])
    return flt.exclude_values(kept, "family", ["PROMO"], keep_missing=False).select(
        *C.SAMPLE, "genus", "species")


@query("big_fish", "SELECT campaignid, sample, genus, length FROM length_role WHERE length > 960")
def _(r):
    return flt.big_fish(r.length(), 960).select(*C.SAMPLE, "genus", "length")


@query("score_positive", """SELECT campaignid, sample, relief_3_good FROM habitat
    WHERE relief_3_good > 0""")
def _(r):
    return flt.positive(r.habitat(), "relief_3_good").select(*C.SAMPLE, "relief_3_good")


@query("standardise_maxn", """SELECT campaignid, sample, coalesce(family, 'Unknown') AS family,
      coalesce(genus, 'Unknown') AS genus, coalesce(lower(species), 'spp') AS species,
      TRY_CAST(number AS DOUBLE) AS maxn FROM length_raw""")
def _(r):
    return check.standardise_maxn(r.length_raw().withColumn("maxn", F.col("number")))


@query("standardise_length", """SELECT campaignid, sample, coalesce(family, 'Unknown') AS family,
      replace(coalesce(genus, 'Unknown'), 'NA', 'Unknown') AS genus,
      coalesce(species, 'spp') AS species, TRY_CAST(length AS DOUBLE) AS length,
      TRY_CAST(number AS DOUBLE) AS number, l.range
    FROM length_raw l WHERE TRY_CAST(number AS DOUBLE) IS NOT NULL""")
def _(r):
    return check.standardise_length(r.length_raw())


@query("standardise_observations", """SELECT 'maxn' AS kind, campaignid, sample,
      coalesce(family, 'Unknown') AS family, coalesce(genus, 'Unknown') AS genus,
      coalesce(lower(species), 'spp') AS species, TRY_CAST(number AS DOUBLE) AS maxn,
      NULL::DOUBLE AS length, NULL::DOUBLE AS number, NULL::DOUBLE AS range FROM length_raw
    UNION ALL SELECT 'length', campaignid, sample, coalesce(family, 'Unknown'),
      replace(coalesce(genus, 'Unknown'), 'NA', 'Unknown'), coalesce(species, 'spp'), NULL,
      TRY_CAST(length AS DOUBLE), TRY_CAST(number AS DOUBLE), l.range
    FROM length_raw l WHERE TRY_CAST(number AS DOUBLE) IS NOT NULL""")
def _(r):
    maxn = check.standardise_maxn(r.length_raw().withColumn("maxn", F.col("number")))
    length = check.standardise_length(r.length_raw())
    return bind_rows(maxn.withColumn("kind", F.lit("maxn")),
                     length.withColumn("kind", F.lit("length")))
