"""Header normalisation (works on names only, never on data)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

_SEPARATORS = re.compile(r"[^0-9a-z]+")


def clean_name(name: str) -> str:
    """Lower-case a header and turn each run of punctuation or blanks into ``_``.

    Blanks around the header go; a separator that stands for closing
    punctuation stays, so ``done (Y/N)`` becomes ``done_y_n_``.
    """
    return _SEPARATORS.sub("_", name.strip().lower())


def unique_names(raw: Iterable[str]) -> list[str]:
    """Normalised names; a name that would repeat gets a number."""
    seen: dict[str, int] = {}
    names = []
    for name in raw:
        base = clean_name(name)
        seen[base] = seen.get(base, 0) + 1
        names.append(base if seen[base] == 1 else f"{base}_{seen[base]}")
    return names


def clean_names(df: DataFrame) -> DataFrame:
    """Normalise all column names."""
    return df.toDF(*unique_names(df.columns))
