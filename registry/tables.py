"""Joins, aggregates and reshaping on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathomframe.functions import columns as C
from fathomframe.operators import aggregates as agg
from fathomframe.operators import joins as J
from fathomframe.operators import reshape as R
from fathomframe.operators import summary as S
from fathomframe.plans import check, habitat as hab
from registry.book import query, rounded
from registry.files import fresh
from registry.roles import FAMILIES

_STEREO = """SELECT campaignid, sample, family, genus, species, sum(number) AS stereo_maxn
    FROM observed GROUP BY ALL"""
_KEYS = "campaignid, sample, family, genus, species"


@query("attach_metadata_inner", """SELECT l.campaignid, l.sample, genus, species, length,
      location, status, depth, successful_count, successful_length
    FROM length_role l JOIN metadata m ON l.campaignid = m.campaignid AND l.sample = m.sample""")
def _(r):
    left = r.length().select(*C.SAMPLE, "genus", "species", "length",
                             F.lit("dropped").alias("status"))
    return J.attach_metadata(left, r.metadata())


@query("attach_metadata_left", """SELECT p.campaignid, p.sample, frame, genus, location
    FROM points p LEFT JOIN metadata m ON p.campaignid = m.campaignid AND p.sample = m.sample""")
def _(r):
    return J.attach_metadata(r.points().select(*C.SAMPLE, "frame", "genus"),
                             r.metadata().select(*C.SAMPLE, "location"), "left")


@query("all_samples_right", """SELECT m.campaignid, m.sample, family, genus, species, maxn
    FROM maxn_role x RIGHT JOIN metadata m ON x.campaignid = m.campaignid AND x.sample = m.sample""")
def _(r):
    return J.keep_all_samples(r.maxn(), r.metadata())


@query("full_join_compare", f"""SELECT coalesce(s.campaignid, m.campaignid) AS campaignid,
      coalesce(s.sample, m.sample) AS sample, coalesce(s.family, m.family) AS family,
      coalesce(s.genus, m.genus) AS genus, coalesce(s.species, m.species) AS species,
      stereo_maxn, maxn
    FROM stereo s FULL JOIN (SELECT * REPLACE (CASE WHEN maxn > 3 THEN species ELSE 'sp9' END AS species)
                       FROM maxn_role) m
      ON s.campaignid = m.campaignid AND s.sample = m.sample
      AND s.family IS NOT DISTINCT FROM m.family AND s.genus IS NOT DISTINCT FROM m.genus
      AND s.species IS NOT DISTINCT FROM m.species""", {"stereo": _STEREO})
def _(r):
    """Rare taxa are counted under another species, so both sides have rows of their own."""
    counted = r.maxn().withColumn("species", F.when(F.col("maxn") > 3, F.col("species")).otherwise("sp9"))
    return J.join_on(check.stereo_maxn(r.observed()), counted, [*C.SAMPLE, *C.TAXON], "full")


@query("full_join_habitat", """SELECT coalesce(a.campaignid, b.campaignid, c.campaignid) AS campaignid,
      coalesce(a.sample, b.sample, c.sample) AS sample, a.flat, b.open, c.sand
    FROM (SELECT campaignid, concat(sample, CASE WHEN relief_0_flat > 12 THEN '' ELSE 'f' END) AS sample,
            relief_0_flat AS flat FROM habitat) a
    FULL JOIN (SELECT campaignid,
            concat(sample, CASE WHEN fieldofview_limited > 12 THEN '' ELSE 'l' END) AS sample,
            fieldofview_open AS open FROM habitat) b
      ON a.campaignid = b.campaignid AND a.sample = b.sample
    FULL JOIN (SELECT campaignid, concat(sample, CASE WHEN sand > 12 THEN '' ELSE 's' END) AS sample,
            sand FROM habitat) c
      ON c.campaignid = coalesce(a.campaignid, b.campaignid)
      AND c.sample = coalesce(a.sample, b.sample)""")
def _(r):
    """Samples of few points have another name in each table, so each has rows of its own."""
    h = r.habitat()

    def part(points: str, mark: str, value: str, name: str):
        few = F.when(F.col(points) > 12, "").otherwise(mark)
        return h.select("campaignid", F.concat("sample", few).alias("sample"), F.col(value).alias(name))

    return hab.full_join_habitat(
        part("relief_0_flat", "f", "relief_0_flat", "flat"),
        part("fieldofview_limited", "l", "fieldofview_open", "open"), part("sand", "s", "sand", "sand"))


@query("anti_join", """SELECT campaignid, sample, family, genus, species, length FROM length_raw l
    WHERE NOT EXISTS (SELECT 1 FROM life_history h WHERE l.family IS NOT DISTINCT FROM h.family
      AND l.genus IS NOT DISTINCT FROM h.genus
      AND lower(l.species) IS NOT DISTINCT FROM h.species)""")
def _(r):
    raw = r.length_raw().select(*C.SAMPLE, *C.TAXON, "length")
    lowered = C.lower_species(raw)
    return J.anti_join(lowered, r.life_history(), C.TAXON).withColumn(
        "species", F.upper("species"))


@query("semi_join", """SELECT campaignid, sample, frame, genus FROM points p
    WHERE EXISTS (SELECT 1 FROM metadata m WHERE p.campaignid = m.campaignid
      AND p.sample = m.sample AND successful_length = 'Yes')""")
def _(r):
    return J.semi_join(r.points().select(*C.SAMPLE, "frame", "genus"),
                       r.metadata().filter("successful_length = 'Yes'"), C.SAMPLE, null_safe=())


@query("lookup_join", """SELECT l.campaignid, l.sample, l.family, l.genus, l.species, length,
      length_measure, round(b, 4) AS b
    FROM length_role l LEFT JOIN life_history h
      ON l.family = h.family AND l.genus = h.genus AND l.species = h.species""")
def _(r):
    return rounded(J.lookup_join(
        r.length().select(*C.SAMPLE, *C.TAXON, "length"),
        r.life_history().select(*C.TAXON, "length_measure", "b"), C.TAXON, "left"))


@query("group_sum", f"SELECT {_KEYS}, sum(number) AS total FROM observed GROUP BY ALL")
def _(r):
    return agg.group_sum(r.observed(), [*C.SAMPLE, *C.TAXON], "number", "total")


@query("group_mean", """SELECT genus, round(avg(fb_length_max), 4) AS mean_max
    FROM life_history WHERE fb_length_max IS NOT NULL GROUP BY genus""")
def _(r):
    return rounded(agg.group_mean(r.life_history(), ["genus"], "fb_length_max", "mean_max"))


@query("group_minmaxmean", """SELECT family, genus, species, min(length) AS min_length,
      round(avg(length), 4) AS mean_length, max(length) AS max_length
    FROM length_role GROUP BY ALL""")
def _(r):
    return rounded(agg.group_spread(r.length(), C.TAXON, "length"))


@query("group_sd", """SELECT campaignid, sample, genus, round(stddev_samp(length), 4) AS sd_length
    FROM length_role GROUP BY ALL""")
def _(r):
    return rounded(agg.group_sd(r.length(), [*C.SAMPLE, "genus"], "length", "sd_length"))


@query("geometric_mean", """SELECT family, length_measure,
      round(pow(10, avg(log10(a))), 6) AS a FROM life_history GROUP BY ALL""")
def _(r):
    return rounded(r.life_history().groupBy("family", "length_measure")
                   .agg(agg.geometric_mean("a").alias("a")), digits=6)


@query("distinct_taxa", "SELECT DISTINCT family, genus, species FROM length_role")
def _(r):
    return agg.distinct_rows(r.length(), C.TAXON)


@query("count_distinct_ids", """SELECT count(*)::BIGINT AS n
    FROM (SELECT DISTINCT campaignid, sample FROM length_role)""")
def _(r):
    return agg.count_distinct(r.length(), C.SAMPLE)


@query("window_min_rank", """SELECT family, genus, species, length_measure, rank FROM (
      SELECT *, min(rank) OVER (PARTITION BY family) AS best FROM (
        SELECT family, genus, species, length_measure, CASE length_measure WHEN 'FL' THEN 1
          WHEN 'TL' THEN 2 ELSE 3 END::INTEGER AS rank FROM life_history WHERE a IS NOT NULL))
    WHERE rank = best""")
def _(r):
    lh = r.life_history().filter("a IS NOT NULL").select(*C.TAXON, "length_measure")
    return agg.best_ranked(lh, ["family"])


@query("sort_desc", f"SELECT {_KEYS}, maxn FROM maxn_role ORDER BY maxn DESC, {_KEYS}")
def _(r):
    return agg.sort_desc(r.maxn(), "maxn", [*C.SAMPLE, *C.TAXON])


@query("bind_rows", """SELECT genus, species, a, NULL::VARCHAR AS family FROM life_history
    UNION ALL SELECT NULL, NULL, a, family FROM life_history""")
def _(r):
    lh = r.life_history()
    return R.bind_rows(lh.select("genus", "species", "a"), lh.select("family", "a"))


@query("complete_cross", """SELECT a.campaignid, a.sample, b.family, b.genus, b.species,
      coalesce(maxn, 0.0) AS maxn
    FROM (SELECT DISTINCT campaignid, sample FROM maxn_role) a
    CROSS JOIN (SELECT DISTINCT family, genus, species FROM maxn_role) b
    LEFT JOIN maxn_role m ON m.campaignid = a.campaignid AND m.sample = a.sample
      AND m.family = b.family AND m.genus = b.genus AND m.species = b.species""")
def _(r):
    return R.complete_cells(r.maxn(), C.SAMPLE, C.TAXON, fill={"maxn": 0.0})


@query("complete_fill", """SELECT a.project, a.campaignid, a.sample, a.family, a.genus, a.species,
      b.legal_sublegal, coalesce(c."count", 0.0) AS "count"
    FROM (SELECT DISTINCT project, campaignid, sample, family, genus, species FROM count_role) a
    CROSS JOIN (SELECT DISTINCT legal_sublegal FROM count_role) b
    LEFT JOIN count_role c ON a.campaignid = c.campaignid AND a.sample = c.sample
      AND a.genus = c.genus AND a.species = c.species AND b.legal_sublegal = c.legal_sublegal""")
def _(r):
    return R.complete(r.count(), ["project", *C.SAMPLE, *C.TAXON], ["legal_sublegal"],
                      fill={"count": 0.0}, blocks=1)


@query("pivot_wide", "SELECT campaignid, sample, " + ", ".join(
    f"coalesce(sum(CASE WHEN family = '{f}' THEN maxn END), 0.0) AS \"{f}\"" for f in FAMILIES)
    + " FROM maxn_role GROUP BY campaignid, sample")
def _(r):
    cells = agg.group_sum(r.maxn(), [*C.SAMPLE, "family"], "maxn", "maxn")
    return R.pivot_wide(cells, C.SAMPLE, "family", "maxn", FAMILIES, fill=0.0)


_RELIEF = ["relief_0_flat", "relief_1_some", "relief_2_mostly", "relief_3_good", "relief_4_high"]


@query("unpivot_long", " UNION ALL ".join(
    f"SELECT campaignid, sample, '{c}' AS relief, {c} AS score FROM habitat" for c in _RELIEF))
def _(r):
    return R.unpivot_long(r.habitat(), C.SAMPLE, _RELIEF, "relief", "score")


@query("uncount", """SELECT campaignid, sample, genus, length
    FROM length_role JOIN generate_series(1, 7) g(i) ON i <= number""")
def _(r):
    rows = r.length().select(*C.SAMPLE, "genus", "length", "number")
    return R.uncount(rows, "number")


@query("rep_by_score", """SELECT campaignid, sample, relief_2_mostly / 2 AS score
    FROM habitat JOIN generate_series(1, 1000) g(i) ON i <= floor(relief_2_mostly / 2)""")
def _(r):
    rows = r.habitat().select(*C.SAMPLE, (F.col("relief_2_mostly") / 2).alias("score"))
    return R.uncount(rows, "score", keep=True)


@query("prefix_sum_columns", """SELECT campaignid, sample, project,
      sponges_cups + sponges_tubes AS biota_sponges, macroalgae AS biota_macroalgae,
      0.0::DOUBLE AS biota_mangrove, relief_0_flat AS relief_0 FROM habitat""")
def _(r):
    return R.prefix_sums(r.habitat(), {
        "biota_sponges": "sponges", "biota_macroalgae": "macroalgae",
        "biota_mangrove": "mangrove", "relief_0": "relief_0"},
        [*C.SAMPLE, "project"])


@query("histogram_density", """SELECT bin, round(low + bin * w, 4) AS bin_start,
      round(low + (bin + 1) * w, 4) AS bin_end, n::BIGINT AS n, round(n / (total * w), 8) AS density
    FROM (SELECT least(floor((x - low) / w), 29)::BIGINT AS bin, low, w, total, count(*) AS n
      FROM (SELECT l.range AS x FROM length_role l) v
      CROSS JOIN (SELECT min(l.range) AS low, (max(l.range) - min(l.range)) / 30.0::DOUBLE AS w,
                    count(l.range) AS total FROM length_role l) e
      GROUP BY ALL)""")
def _(r):
    h = S.histogram_density(r.length(), "range", 30)
    return h.withColumns({"bin_start": F.round("bin_start", 4), "bin_end": F.round("bin_end", 4),
                          "density": F.round("density", 8)})


@query("box_stats", """SELECT q1, median, q3,
      min(CASE WHEN x BETWEEN lo AND hi THEN x END) AS lower_whisker,
      max(CASE WHEN x BETWEEN lo AND hi THEN x END) AS upper_whisker,
      count(CASE WHEN x NOT BETWEEN lo AND hi THEN 1 END)::BIGINT AS outliers
    FROM (SELECT length AS x FROM length_role WHERE length IS NOT NULL)
    CROSS JOIN (SELECT q1, median, q3, q1 - 0.3 * (q3 - q1) AS lo, q3 + 0.3 * (q3 - q1) AS hi
      FROM (SELECT quantile_cont(length, 0.25) AS q1, quantile_cont(length, 0.5) AS median,
              quantile_cont(length, 0.75) AS q3 FROM length_role)) GROUP BY ALL""")
def _(r):
    fresh(r)
    return S.box_stats(r.length(), "length", reach=0.3)


@query("summary_stats", """SELECT round(min(x), 4) AS min, round(quantile_cont(x, 0.25), 4) AS q1,
      round(quantile_cont(x, 0.5), 4) AS median, round(avg(x), 4) AS mean,
      round(quantile_cont(x, 0.75), 4) AS q3, round(max(x), 4) AS max,
      count(CASE WHEN x IS NULL THEN 1 END)::BIGINT AS missing
    FROM (SELECT CASE WHEN number IS NOT NULL THEN l.range END AS x FROM length_role l)""")
def _(r):
    fresh(r)
    known = r.length().withColumn("range", F.when(F.col("number").isNotNull(), F.col("range")))
    return rounded(S.summary_stats(known, "range"))


@query("pair_projection", """SELECT l.range, length,
      concat(genus, ' ', species) AS label
    FROM length_role l WHERE length IS NOT NULL AND l.range IS NOT NULL""")
def _(r):
    return S.pair_projection(r.length(), "range", "length", C.paste("genus", "species"))


@query("local_curve", """SELECT bin::BIGINT AS bin, round(low + place, 6) AS x, n::BIGINT AS n,
      round(sy / sn + (sn * sxy - sx * sy) / (sn * sxx - sx * sx) * (place - sx / sn), 4) AS fitted FROM weighted""", {
    "moments": """SELECT bin, low, width, (bin + 0.5::DOUBLE) * (width / 40) AS place, count(*)::DOUBLE AS n,
        sum(gap) AS sx, sum(y) AS sy, sum(gap * gap) AS sxx, sum(gap * y) AS sxy
      FROM (SELECT y, low, high - low AS width, x - low AS gap, least(floor((x - low) / ((high - low) / 40)), 39) AS bin
            FROM (SELECT l.range AS x, length AS y, min(l.range) OVER () AS low, max(l.range) OVER () AS high
                  FROM length_role l WHERE l.range IS NOT NULL AND length IS NOT NULL))
      GROUP BY bin, low, width""",
    "weighted": """SELECT bin, low, place, n, sum(w * qn) AS sn, sum(w * qx) AS sx, sum(w * qy) AS sy, sum(w * qxx) AS sxx, sum(w * qxy) AS sxy
      FROM (SELECT p.bin, p.low, p.place, p.n, q.n AS qn, q.sx AS qx, q.sy AS qy, q.sxx AS qxx, q.sxy AS qxy,
              pow(1 - pow(least(1.0::DOUBLE, abs(q.sx / q.n - p.place) / (0.3::DOUBLE * p.width)), 3), 3) AS w
            FROM moments p, moments q) GROUP BY bin, low, place, n"""})
def _(r):
    """The curve through lengths over ranges."""
    return rounded(rounded(S.local_curve(r.length(), "range", "length"), "fitted"), "x", digits=6)
