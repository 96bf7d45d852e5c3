"""Column expressions shared by all stages: built-in functions only."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = ("campaignid", "sample")
TAXON = ("family", "genus", "species")

# Names given to taxa that were left blank.
TAXON_DEFAULTS = {"family": "Unknown", "genus": "Unknown", "species": "spp"}

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: What counts as a number in text; the words and suffixes that a cast would also take do not.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_numeric(col: ColumnLike) -> Column:
    """Finite number or NULL; text that is no number never fails the job."""
    c = _c(col)
    text = c.cast("string")
    value = F.when((F.typeof(c) != "string") | text.rlike(NUMBER), c.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def with_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_numeric(c) for c in columns})


def null_tokens(df: DataFrame, tokens: Sequence[str],
                columns: Iterable[str] | None = None) -> DataFrame:
    """Turn the given missing-value tokens into NULL in the text columns."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in columns
    })


def lower_species(df: DataFrame, column: str = "species") -> DataFrame:
    return df.withColumn(column, F.lower(column))


def fill_taxa(df: DataFrame, defaults: Mapping[str, str] = TAXON_DEFAULTS) -> DataFrame:
    return df.fillna(dict(defaults))


def replace_text(col: ColumnLike, replacements: Mapping[str, str]) -> Column:
    """Apply regex replacements one after the other (case-sensitive)."""
    return reduce(lambda c, pair: F.regexp_replace(c, pair[0], pair[1]),
                  replacements.items(), _c(col))


def text_or_na(col: ColumnLike) -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit("NA"))


def paste(*cols: ColumnLike, sep: str = " ") -> Column:
    """Join values to text; a missing value shows as the text ``NA``."""
    return F.concat_ws(sep, *[text_or_na(c) for c in cols])


def sample_id() -> Column:
    return paste("campaignid", "sample", sep=".")


def scientific_name() -> Column:
    return paste(*TAXON)


def length_key() -> Column:
    return paste(*TAXON, "length", sep="_")


def row_total(columns: Sequence[str]) -> Column:
    """Sum across columns of one row; missing counts as zero."""
    terms = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    return reduce(add, terms, F.lit(0.0))


def percent_of(part: ColumnLike, whole: ColumnLike) -> Column:
    """``part / whole * 100``; NULL where the whole is zero."""
    return F.try_divide(_c(part), _c(whole)) * 100


def row_percent(df: DataFrame, columns: Sequence[str],
                empty: float | None = None) -> DataFrame:
    """Each column as percentage of the row total over ``columns``.

    A zero total gives ``empty`` (NULL unless stated).
    """
    total = row_total(columns)
    out = {}
    for c in columns:
        share = percent_of(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), total)
        out[c] = share if empty is None else F.coalesce(share, F.lit(float(empty)))
    return df.withColumns(out)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Literal prefix, upper or lower case alike."""
    return [c for c in df.columns if c.lower().startswith(prefix.lower())]


def select_by_prefix(df: DataFrame, *prefixes: str,
                     keep: Sequence[str] = ()) -> DataFrame:
    picked = [c for p in prefixes for c in columns_with_prefix(df, p) if c not in keep]
    return df.select(*keep, *dict.fromkeys(picked))


def select_keep(df: DataFrame, first: Sequence[str], rest: bool = False,
                drop: Sequence[str] = ()) -> DataFrame:
    """Keep ``first`` in that order; ``rest=True`` appends all other columns."""
    tail = [c for c in df.columns if c not in first] if rest else []
    return df.select(*[c for c in [*first, *tail] if c not in drop])


def measure_rank(col: ColumnLike = "length_measure") -> Column:
    """Preference among length measures: fork, then total, then any other."""
    c = _c(col)
    return (F.when(c.isNull(), F.lit(None).cast("int"))
            .when(c == "FL", 1).when(c == "TL", 2).otherwise(3))


def first_present(*cols: ColumnLike) -> Column:
    return F.coalesce(*[_c(c) for c in cols])
