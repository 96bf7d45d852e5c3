"""Campaign search: which campaigns a study is built from.

A catalog row describes one campaign.  A filter is a mapping ``name, op, val``:

* ``eq``, ``like`` (``%`` is the wildcard), ``ilike`` (ignoring case),
* ``has``: ``val`` is a filter on the fields of a struct column,
* ``any``: ``val`` is a filter that some element of an array column meets.

Several filters must all hold; no filter means every campaign.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The field names and operation words of the search format.
def _predicate(spec: dict, field: Callable[[str], Column]) -> Column:
    name, op, val = spec["name"], spec["op"], spec.get("val")
    column = field(name)
    if op == "eq":
        return column == F.lit(val)
    if op == "like":
        return column.like(val)
    if op == "ilike":
        return column.ilike(val)
    if op == "has":
        return _predicate(val, lambda inner: column[inner])
    if op == "any":
        return F.exists(column, lambda item: _predicate(val, lambda inner: item[inner]))
    raise ValueError(f"unknown filter operation: {op}")


def campaign_search(catalog: DataFrame,
                    filters: Sequence[dict] | str | None = None) -> DataFrame:
    """Campaigns that meet all filters (a list, or JSON text with ``filters``)."""
    if isinstance(filters, str):
        filters = json.loads(filters)["filters"] if filters.strip() else None
    for spec in filters or []:
        catalog = catalog.filter(_predicate(spec, F.col))
    return catalog


def by_name(catalog: DataFrame, name: str) -> DataFrame:
    return campaign_search(catalog, [{"name": "name", "op": "eq", "val": name}])


def by_pattern(catalog: DataFrame, pattern: str) -> DataFrame:
    return campaign_search(catalog, [{"name": "name", "op": "like", "val": pattern}])


def by_project(catalog: DataFrame, project: str) -> DataFrame:
    """``+`` stands for a blank in a project name."""
    project = project.replace("+", " ")
    return campaign_search(catalog, [{"name": "project", "op": "eq", "val": project}])


def by_workgroup(catalog: DataFrame, workgroup: str) -> DataFrame:
    workgroup = workgroup.replace("+", " ")
    return campaign_search(catalog, [{"name": "workgroups", "op": "any", "val": {
        "name": "name", "op": "eq", "val": workgroup}}])


def by_user(catalog: DataFrame, email: str) -> DataFrame:
    return campaign_search(catalog, [{"name": "user", "op": "has", "val": {
        "name": "email", "op": "eq", "val": email}}])


def restrict(table: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Rows of the campaigns found (catalog ``name`` is the campaign id)."""
    from fathomframe.operators.joins import semi_join

    found = campaigns.select(F.col("name").alias("campaignid"))
    return semi_join(table, found, ["campaignid"], null_safe=())
