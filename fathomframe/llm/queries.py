"""One registered query per corpus operator, over whole tables with production parameters, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, collocations, exact, langid, merkle, mixing, near, passages, quality, substrings, tokens, urls, wrappers
from .common import small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents")).drop("_row")


ORACLES["op4_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, urls.rule_table(spark, urls.RULES)).drop("url")


_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in urls.RULES)
ORACLES["op7_url_filters"] = f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {_RULE_VALUES}),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
         FROM pages),
parsed AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
           FROM (SELECT page_id, coalesce(rest, '') AS rest FROM rest)),
judged AS (SELECT *, (SELECT arg_max({{'rule': rule_host || rule_path, 'action': action}},
                                     length(rule_host) + length(rule_path))
                      FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
                                   AND starts_with(path, rule_path)) AS best FROM parsed)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.action, 'allow') AS verdict FROM judged
"""


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def encoded(docs: DataFrame, model: str = tokens.MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip: the ids of every whole text, and whether they decode to it."""
    small_batches(docs.sparkSession)
    pieces = tokens.Pieces.load(model)
    out = tokens.encode(docs.select("doc_id", "text"), pieces, decoded="decoded")
    plain = F.translate(F.coalesce("text", F.lit("")), tokens.SPACE, " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == plain).alias("round_trip"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(table(spark, sf_dir, "documents"))


@query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, middle = centroids.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return centroids.with_inertia(placed, middle)


def _cluster_sql() -> str:
    """Rounds written out one after the other; vectors are lists of 64 integers."""
    gap = "CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    nearest = f"""SELECT row, vec_id, v, unnest(p) FROM (
        SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{{{'distance': {gap}, 'cluster': k}}}}) AS p
        FROM kept CROSS JOIN middle{{i}} GROUP BY row)"""
    moved = """SELECT k, coalesce(fresh, c) AS c FROM middle{i} LEFT JOIN (
        SELECT cluster, list(mean ORDER BY place) AS fresh FROM (
            SELECT cluster, place, (sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS mean
            FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{i}) GROUP BY cluster, place)
        GROUP BY cluster) ON k = cluster"""
    steps = []
    for i in range(centroids.ROUNDS + 1):
        steps.append(f"near{i} AS MATERIALIZED ({nearest.format(i=i)})")
        if i < centroids.ROUNDS:
            steps.append(f"middle{i + 1} AS MATERIALIZED ({moved.format(i=i)})")
    last = centroids.ROUNDS
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMENSIONS}),
middle0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c
    FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {centroids.CLUSTERS})),
{", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{last} JOIN middle{last} ON k = cluster
"""


ORACLES["op12_centroid_clustering"] = _cluster_sql()


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLES["op11_phrase_collocations"] = f"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
        SELECT coalesce(lang, '{collocations.UNDETERMINED}') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
spans AS (
    SELECT lang, size, w[i : i + size - 1] AS g
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, {collocations.LONGEST} + 1) t(size))),
grams AS MATERIALIZED (SELECT lang, size, g, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
cuts AS (
    SELECT c.lang, c.g, c.f AS a, l.f AS l, r.f AS r, k, {collocations.SCORE_SCALE}::HUGEINT * c.f // (l.f::HUGEINT + r.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM grams WHERE size > 1) c
    JOIN grams l ON l.lang = c.lang AND l.g = c.g[1 : k] JOIN grams r ON r.lang = c.lang AND r.g = c.g[k + 1 :]),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
within AS (
    SELECT lang, g[i : i + s - 1] AS g, max(f) AS longer
    FROM (SELECT *, unnest(range(1, size - s + 2)) AS i FROM grams, range(2, {collocations.LONGEST}) t(s) WHERE s < size) GROUP BY ALL),
kept AS (
    SELECT w.lang, array_to_string(w.g, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score
    FROM weakest w LEFT JOIN within x ON x.lang = w.lang AND x.g = w.g
    WHERE longer IS NULL OR {collocations.COVERED}::HUGEINT * longer < {collocations.COVERING}::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}
"""


@query
def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.with_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = out.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                     "fingerprint", "edited_fingerprint", "next_fingerprint")
    out = merkle.likeness(out, "fingerprint", "edited_fingerprint", "near_edited")
    out = merkle.likeness(out, "fingerprint", "next_fingerprint", "near_next")
    return merkle.edited(out, "fingerprint", "edited_fingerprint").drop("next_fingerprint", "edit_end")


_CLOSING = ", ".join(f"'{c}'" for c in merkle.CLOSING)
_TREE_SQL = f"""array_to_string(list_transform(regexp_extract_all(array_to_string(list_transform(
    regexp_extract_all($text, '{merkle.LEAF}'), lambda x: left(sha256(x), {merkle.DIGITS}) || '.' || length(x) || CASE
        WHEN ends_with(x, chr(10) || chr(10)) THEN ',/#'
        WHEN ends_with(x, chr(10)) OR left(sha256(x), 1) IN ({_CLOSING}) THEN ',/' ELSE ',' END), ''), '[^/]+(/#?)?'),
    lambda p: CASE WHEN NOT ends_with(p, '#') AND left(sha256(p), 1) IN ({_CLOSING}) THEN p || '#' ELSE p END), '')"""
_ROOT_SQL = """sha256(array_to_string(list_transform(list_filter(string_split({tree}, '#'), lambda s: s <> ''), lambda s: sha256(
    array_to_string(list_transform(list_filter(string_split(s, '/'), lambda p: p <> ''), lambda p: sha256(p)), ''))), ''))"""
_LEAVES_SQL = "regexp_extract_all({tree}, '[0-9a-f]+[.][0-9]+')"
_WEIGHT_SQL = "coalesce(list_sum(list_transform({leaves}, lambda x: CAST(split_part(x, '.', 2) AS BIGINT))), 0)"


def _likeness_sql(a: str, b: str) -> str:
    x, y = (f"list_distinct({_LEAVES_SQL.format(tree=t)})" for t in (a, b))
    shared, left, right = (_WEIGHT_SQL.format(leaves=v) for v in (f"list_intersect({x}, {y})", x, y))
    return f"CASE WHEN {a}_root = {b}_root THEN 1.0::DOUBLE ELSE CAST(2 * {shared} AS DOUBLE) / ({left} + {right}) END"


_SAME_SQL = f"list_transform(list_zip({_LEAVES_SQL.format(tree='own')}, {_LEAVES_SQL.format(tree='edit')}), lambda z: z[1] IS NOT DISTINCT FROM z[2])"
_PREFIX_SQL = f"{_LEAVES_SQL.format(tree='own')}[1 : list_position({_SAME_SQL}, false) - 1]"
ORACLES["op13_document_fingerprints"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
paired AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following FROM docs WINDOW w AS (ORDER BY doc_id DESC)),
texts AS (SELECT *, left(text, length(text) - length(text) // 3) || left(following, length(text) // 3) AS edited FROM paired),
trees AS MATERIALIZED (SELECT *, {", ".join(f"{_TREE_SQL.replace('$text', t)} AS {name}" for t, name in (("text", "own"), ("edited", "edit"), ("following", "other")))} FROM texts),
roots AS (SELECT *, {", ".join(f"{_ROOT_SQL.format(tree=t)} AS {t}_root" for t in ("own", "edit", "other"))} FROM trees)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, own_root || ' ' || own AS fingerprint,
       edit_root || ' ' || edit AS edited_fingerprint, {_likeness_sql("own", "edit")} AS near_edited, {_likeness_sql("own", "other")} AS near_next,
       CASE WHEN own_root <> edit_root THEN CAST({_WEIGHT_SQL.format(leaves=_PREFIX_SQL)} AS BIGINT) END AS edit_start
FROM roots
"""
