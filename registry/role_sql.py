"""The survey tables of ``registry/roles.py`` as SQL common table expressions."""

from __future__ import annotations

import re

_TAXON = """p_type AS family, concat(p_type, '-', p_brand) AS genus,
    concat('sp', p_size % 3) AS species"""
_EVENT_CAMPAIGN = ("CASE WHEN user_id % 3 = 0 THEN 'A' "
                   "WHEN user_id % 3 = 1 THEN 'N' ELSE 'R' END")


def _of(kind: str, name: str) -> str:
    return f"sum(CASE WHEN event_type = '{kind}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS {name}"


ROLES = {
    "taxa": f"SELECT DISTINCT {_TAXON} FROM part",
    "catch": f"""SELECT l_returnflag AS campaignid, l_suppkey::VARCHAR AS sample, {_TAXON},
        l_orderkey, l_linenumber, l_quantity, l_tax, l_discount, l_linestatus, l_extendedprice
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "length_role": """SELECT campaignid, sample, family, genus, species,
        CASE WHEN l_linenumber <> 7 THEN l_quantity * 20 END AS length,
        CASE WHEN l_tax <> 0.08::DOUBLE THEN l_linenumber::DOUBLE END AS number,
        l_extendedprice / 5 AS range, l_linestatus AS legal_sublegal FROM catch""",
    "observed": """SELECT campaignid, sample, family, genus, species, length, number, range
        FROM length_role WHERE number IS NOT NULL""",
    "length_raw": """SELECT campaignid, sample,
        CASE WHEN l_discount <> 0.0 THEN family END AS family,
        CASE WHEN l_discount = 0.01::DOUBLE THEN 'NA' ELSE genus END AS genus,
        CASE WHEN l_discount <> 0.02::DOUBLE THEN upper(species) END AS species,
        CASE WHEN l_linenumber = 7 THEN '' ELSE (l_quantity * 20)::INTEGER::VARCHAR END AS length,
        CASE WHEN l_tax = 0.08::DOUBLE THEN 'none' ELSE l_linenumber::VARCHAR END AS number,
        l_extendedprice / 5 AS range FROM catch""",
    "maxn_role": """SELECT campaignid, sample, family, genus, species,
        (sum(l_linenumber) + min(l_orderkey) % 3 - 1)::DOUBLE AS maxn
        FROM catch GROUP BY ALL""",
    "count_role": """SELECT concat('project-', campaignid) AS project, campaignid, sample,
        family, genus, species, l_linestatus AS legal_sublegal,
        sum(l_linenumber)::DOUBLE AS "count" FROM catch GROUP BY ALL""",
    "metadata": """SELECT c.campaignid, s_suppkey::VARCHAR AS sample, n_name AS location,
        CASE WHEN s_nationkey % 2 = 0 THEN 'Fished' ELSE 'No-take' END AS status,
        s_nationkey::DOUBLE AS depth,
        CASE WHEN s_acctbal < 500 THEN 'No' ELSE 'Yes' END AS successful_count,
        CASE WHEN s_acctbal < 1500 THEN 'No' ELSE 'Yes' END AS successful_length
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        CROSS JOIN (VALUES ('A'), ('N'), ('R'), ('Z')) c(campaignid)""",
    "points": f"""SELECT {_EVENT_CAMPAIGN} AS campaignid, user_id::VARCHAR AS sample,
        strftime(ts, '%Y-%m-%d') AS frame,
        (hour(ts) * 60 + minute(ts))::DOUBLE AS periodtime, 'Eventidae' AS family,
        event_type AS genus, 'spp' AS species, 1.0::DOUBLE AS number FROM events""",
    "life_history": f"""SELECT family, genus, species,
        CASE WHEN family IN ('ECONOMY', 'LARGE') THEN 'SW' WHEN family = 'MEDIUM' THEN 'N/NW'
             ELSE 'NW' END AS marine_region,
        CASE species WHEN 'sp0' THEN 'FL' WHEN 'sp1' THEN 'TL' ELSE 'SL' END AS length_measure,
        CASE WHEN species <> 'sp1' AND NOT (family = 'LARGE' AND species = 'sp0')
             THEN price / 1e5 END AS a,
        size / 100.0::DOUBLE + 2.5::DOUBLE AS b,
        CASE WHEN species <> 'sp2' THEN 0.5::DOUBLE END AS "all",
        CASE WHEN species <> 'sp2' THEN 1.1::DOUBLE END AS bll,
        CASE WHEN species <> 'sp0' AND NOT genus LIKE '%Brand#13'
             THEN size * 20.0::DOUBLE END AS fb_length_max,
        CASE WHEN species = 'sp0' THEN 'FL' ELSE 'TL' END AS fb_ltypemaxm
        FROM (SELECT family, genus, species, max(p_size) AS size, max(p_retailprice) AS price
              FROM (SELECT {_TAXON}, p_size, p_retailprice FROM part) GROUP BY ALL)
        WHERE NOT (family = 'PROMO' AND species = 'sp2')""",
    "synonyms": """SELECT family, genus, species, family AS new_family,
          concat(family, '-Brand#8') AS new_genus, species AS new_species
        FROM taxa WHERE genus LIKE '%-Brand#7'
        UNION ALL SELECT family, genus, species, family, genus, 'sp1'
        FROM taxa WHERE genus LIKE '%-Brand#9' AND species = 'sp2'""",
    "habitat": f"""SELECT {_EVENT_CAMPAIGN} AS campaignid, user_id::VARCHAR AS sample,
        'habitat' AS project, {_of('click', 'relief_0_flat')}, {_of('error', 'relief_1_some')},
        {_of('purchase', 'relief_2_mostly')}, {_of('signup', 'relief_3_good')},
        {_of('view', 'relief_4_high')}, {_of('click', 'fieldofview_open')},
        {_of('error', 'fieldofview_limited')}, {_of('click', 'sponges_cups')},
        {_of('error', 'sponges_tubes')}, {_of('purchase', 'macroalgae')},
        {_of('signup', 'sand')}, {_of('view', 'open_water')}
        FROM events GROUP BY user_id
        UNION ALL SELECT 'Z', s_suppkey::VARCHAR, 'habitat', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0
        FROM supplier""",
    "info": """SELECT concat('P', o_custkey % 10) AS project, o_custkey::VARCHAR AS campaignid,
        o_orderpriority AS name, max(o_orderstatus) AS value FROM orders GROUP BY ALL""",
    "catalog": """SELECT c_name AS name, c_mktsegment AS project,
        concat(lower(n_name), '@example.org') AS email, [r_name, n_name] AS workgroups
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
}


def _mentions(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", text)]


def with_roles(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the expressions it needs, in dependency order."""
    known = {**ROLES, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _mentions(text, known):
            if name not in order:
                visit_name(name)

    def visit_name(name: str) -> None:
        for inner in _mentions(known[name], known):
            if inner != name and inner not in order:
                visit_name(inner)
        if name not in order:
            order.append(name)

    visit(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + body
