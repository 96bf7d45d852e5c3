"""The list of registered queries with their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.role_sql import with_roles
from registry.roles import Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DIGITS = 4


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    """Register ``fn(roles) -> DataFrame`` under ``name``."""
    def register(fn: Callable[[Roles], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Roles(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_roles(sql, extra)
        return fn
    return register


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Round the columns whose last digits depend on the order of the rows or
    on the mathematical library (all doubles unless named)."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: F.round(n, digits) for n in names})
