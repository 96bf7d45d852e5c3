"""Writing result tables.  Each table is a folder of part files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from fathomframe.operators.filters import positive


def table_path(root: str, study: str, name: str, sep: str = "_") -> str:
    return f"{root.rstrip('/')}/{study}{sep}{name}"


def write_csv_table(df: DataFrame, root: str, study: str, name: str, sep: str = "_") -> str:
    """Comma-separated with header; missing values are written as ``NA``."""
    path = table_path(root, study, name + ".csv", sep)
    (df.write.mode("overwrite").option("header", True).option("nullValue", "NA")
       .option("escape", '"').csv(path))
    return path


def write_columnar(df: DataFrame, root: str, study: str, name: str, sep: str = ".") -> str:
    path = table_path(root, study, name + ".parquet", sep)
    df.write.mode("overwrite").parquet(path)
    return path


def write_length_columnar(df: DataFrame, root: str, study: str) -> str:
    """Columnar copy of the completed lengths, without the zero rows."""
    return write_columnar(positive(df, "number"), root, study, "complete.length")


def write_tables(tables: Mapping[str, DataFrame], root: str, study: str,
                 columnar: bool = False) -> dict[str, str]:
    """One file set per table.  The columnar copy of the completed lengths
    leaves out the zero rows."""
    out = {}
    for name, df in tables.items():
        if not columnar:
            out[name] = write_csv_table(df, root, study, name)
        elif name == "complete.length":
            out[name] = write_length_columnar(df, root, study)
        else:
            out[name] = write_columnar(df, root, study, name)
    return out
