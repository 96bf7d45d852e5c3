"""Compare a registered query with its SQL on the same parquet tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb

KINDS = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(rows):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return "\0" if v is None else str(v)
    return sorted(tuple(cell(v) for v in row) for row in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences found; empty when both sides agree."""
    problems = []
    names = sorted(spark_df.columns)
    spark_types = dict(spark_df.dtypes)
    desc = con.execute("DESCRIBE " + sql).fetchall()
    duck_types = {d[0]: d[1] for d in desc}
    if names != sorted(duck_types):
        return [f"columns {names} vs {sorted(duck_types)}"]
    for n in names:
        if KINDS.get(duck_types[n], duck_types[n]) != spark_types[n]:
            problems.append(f"type of {n}: {spark_types[n]} vs {duck_types[n]}")
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = _canonical(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    table = spark_df.select(*[f"`{n}`" for n in names]).toArrow()
    got = _canonical(zip(*[c.to_pylist() for c in table.columns], strict=True)
                     if table.num_rows else [])
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} vs {len(expected)}")
    if got != expected:
        only = sorted(set(got) - set(expected))[:2], sorted(set(expected) - set(got))[:2]
        problems.append(f"values differ, e.g. {names} {only[0]} vs {only[1]}")
    return problems
