"""Reading campaign files: many files of one kind, bound by column name."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomframe.functions.columns import null_tokens
from fathomframe.functions.names import clean_name, clean_names, unique_names
from fathomframe.operators.reshape import bind_rows
from fathomframe.session import scratch_root
from fathomframe.sources import manifest

DEFAULT_NA = ("", "NA")
BLANK_NA = ("", " ")


def _escape_glob(path: str) -> str:
    return "".join("\\" + ch if ch in "\\*?[]{}" else ch for ch in path)


def decoded(path: Column) -> Column:
    """Undo the percent-encoding of a file path; ``+`` stays a plus sign."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def unquoted(path: str) -> str:
    """:func:`decoded` for one path on the driver."""
    return unquote(path)


def provenance(path: Column, suffix: str, layout: str = "project/campaign") -> dict[str, Column]:
    """``project`` and ``campaignid`` from a path.

    ``project/campaign`` takes the last two folders; ``flat`` takes the
    campaign from the file name ``<campaignid><suffix>`` and has no project.
    """
    parts = F.split(path, "/")
    if layout == "flat":
        name = F.element_at(parts, -1)
        size = F.length(name) - F.lit(len(suffix))
        stem = F.substring(name, F.lit(1), size)
        return {"campaignid": F.regexp_replace(stem, "_$", "")}
    if layout == "project/campaign":
        return {"project": F.element_at(parts, -3), "campaignid": F.element_at(parts, -2)}
    raise ValueError(f"unknown layout: {layout}")


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def list_files(spark: SparkSession, root: str, suffix: str) -> list[tuple[str, int, int]]:
    """Path, bytes and time (ms) of all files below ``root`` whose name ends in ``suffix``, those with a leading
    ``_`` or ``.`` included."""
    fs, path = _file_system(spark, root)
    if not fs.exists(path):
        raise FileNotFoundError(f"no such folder: {root!r}")
    found, files = [], fs.listFiles(path, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath()
        if name.getName().endswith(suffix) and not name.getName().endswith(".crc"):
            found.append((name.toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def _first_line(spark: SparkSession, file: str) -> str:
    """The header of one file: the stream is closed after it, however long the file is.

    A line break inside quotes belongs to the header.
    """
    jvm, (fs, path) = spark._jvm, _file_system(spark, file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    stream = fs.open(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        codec.createInputStream(stream) if codec is not None else stream, "UTF-8"))
    try:
        header = reader.readLine()
        while header is not None and header.count('"') % 2:
            more = reader.readLine()
            if more is None:
                break
            header += "\n" + more
    finally:
        reader.close()
    return (header or "").rstrip("\r").removeprefix("\ufeff")


def campaign_files(spark: SparkSession, root: str, suffix: str, layout: str = "project/campaign",
                   campaigns: DataFrame | None = None) -> DataFrame:
    """The manifest of the files below ``root`` (see :mod:`fathomframe.sources.manifest`), of some campaigns or of all."""
    return manifest.file_manifest(spark, list_files(spark, root, suffix), suffix, layout, campaigns)


def files_by_header(spark: SparkSession, root: str, suffix: str, layout: str = "project/campaign",
                    campaigns: DataFrame | None = None) -> dict[str, list[str]]:
    """Header -> files that carry it; an empty file is in no group.

    One reader must never see two headers: Spark would put values under the wrong names without a word. Only
    the first line of a file is read here, on the driver, which holds the list of files anyway.
    """
    paths = [f for f, _, _ in list_files(spark, root, suffix)]
    if campaigns is not None:
        kept = campaign_files(spark, root, suffix, layout, campaigns).select("file")
        paths = sorted(r["file"] for r in kept.collect())
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: _first_line(spark, f), paths))
    groups: dict[str, list[str]] = {}
    for header, path in zip(headers, paths, strict=True):
        if header:
            groups.setdefault(header, []).append(path)
    return groups


_STAGED = "visible-copy-"


def _readable(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths that Spark's readers do not pass over.

    They leave out files whose own name begins with ``_`` or ``.``; such files (the campaign information
    files are named so) are copied, project and campaign folder included, below the shared scratch folder
    under a name with one letter before it. The copy streams through the file system client.
    """
    hidden = [p for p in paths if p.rsplit("/", 1)[1][0] in "_."]
    if not hidden:
        return paths
    target, out = f"{scratch_root(spark)}/{_STAGED}{uuid.uuid4().hex}", {}
    conf, copy = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    for i, p in enumerate(hidden):
        *_, project, campaign, name = p.split("/")
        out[p] = f"{target}/{i}/{project}/{campaign}/v{name}"
        (fs, source), (to, place) = _file_system(spark, p), _file_system(spark, out[p])
        copy(fs, source, to, place, False, conf)
    return [out.get(p, p) for p in paths]


def _columns_of(header: str, sep: str) -> list[str]:
    return next(csv.reader(io.StringIO(header), delimiter=sep, quotechar='"', doublequote=True), [])


def _scan_group(spark: SparkSession, header: str, paths: list[str], sep: str, multi_line: bool,
                odd: str) -> tuple[DataFrame, list[str]]:
    """Files with one header under places 0, 1, ... as text, with the record of a row of another width."""
    names = unique_names(_columns_of(header, sep))
    places = [f"c{i}" for i in range(len(names))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*places, _ODD)])
    # Every cell is parsed: with pruned columns a row would only be as wide as the columns asked for.
    raw = (spark.read.schema(schema).option("columnPruning", False).csv(
        [_escape_glob(p) for p in _readable(spark, paths)], header=True, sep=sep, quote='"', escape='"',
        multiLine=multi_line, ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False,
        mode="PERMISSIVE", columnNameOfCorruptRecord=_ODD))
    # Spark refuses to read nothing but the odd records, so the tests below look at a cell as well
    if odd == "fail":
        problem = F.concat(
            F.lit(f"a row is not as wide as its header ({len(names)} columns) in "), F.col("_metadata.file_path"),
            F.lit(": "), F.substring(_ODD, 1, 200))
        raw = raw.select("*", "_metadata").filter(
            F.when(F.col(_ODD).isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.expr(_CELL)))
    return raw, names


_ODD = "__odd"
_CELL = "length(coalesce(c0, '')) >= 0"


def scan_files(spark: SparkSession, root: str, suffix: str, sep: str = ",",
               na: Sequence[str] = DEFAULT_NA, layout: str = "project/campaign",
               multi_line: bool = False, odd_rows: str = "fail", campaigns: DataFrame | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """All files below ``root`` whose name ends in ``suffix``, as text columns.

    Headers are normalised, missing-value tokens become NULL, and the
    provenance columns come first.  Files whose name begins with ``_`` or
    ``.`` are read like any other.  ``multi_line`` reads cells with line
    breaks (such files are not split).  A row that is not as wide as its
    header ends the job that reads it; with ``odd_rows="skip"`` it is left
    to :func:`odd_width_rows`, which lists all of them.  ``campaigns``, a
    search result, keeps files of other campaigns from being opened at all;
    ``columns`` names the columns to read.

    Tasks open files themselves (:mod:`fathomframe.sources.manifest`); where
    they cannot, in a store that only Spark opens, Spark's reader is used,
    one for each header.
    """
    if not manifest.opens(root):
        table = _scan_with_spark(spark, root, suffix, sep, layout, multi_line, odd_rows, campaigns)
        own = [c for c in table.columns if c in ("project", "campaignid")]
        return null_tokens(table if columns is None else table.select(*own, *columns), na)
    found = campaign_files(spark, root, suffix, layout, campaigns)
    names = manifest.column_names(found, sep)
    if not names:
        raise FileNotFoundError(f"no file ending in {suffix!r} below {root!r}")
    return null_tokens(manifest.scan_manifest(found, names if columns is None else columns, sep, multi_line, odd_rows), na)


def _scan_with_spark(spark: SparkSession, root: str, suffix: str, sep: str, layout: str, multi_line: bool,
                     odd_rows: str, campaigns: DataFrame | None) -> DataFrame:
    tables = []
    for header, paths in _groups(spark, root, suffix, layout, campaigns).items():
        raw, names = _scan_group(spark, header, paths, sep, multi_line, odd_rows)
        if odd_rows == "skip":
            raw = raw.select("*", "_metadata").filter(F.col(_ODD).isNull() & F.expr(_CELL))
        source = provenance(_seen_path(), suffix, layout)
        keep = [(i, n) for i, n in enumerate(names) if n not in source]
        tables.append(raw.select(*[c.alias(n) for n, c in source.items()],
                                 *[F.col(f"c{i}").alias(n) for i, n in keep]))
    return bind_rows(*tables)


def _groups(spark: SparkSession, root: str, suffix: str, layout: str = "project/campaign",
            campaigns: DataFrame | None = None) -> dict[str, list[str]]:
    groups = files_by_header(spark, root, suffix, layout, campaigns)
    if not groups:
        raise FileNotFoundError(f"no file ending in {suffix!r} below {root!r}")
    return groups


def _seen_path() -> Column:
    """The path of the file a row came from, a copy's letter taken off again."""
    path = decoded(F.col("_metadata.file_path"))
    return F.when(path.contains(f"/{_STAGED}"), F.regexp_replace(path, "/v([^/]*)$", "/$1")).otherwise(path)


def odd_width_rows(spark: SparkSession, root: str, suffix: str, sep: str = ",",
                   layout: str = "project/campaign", multi_line: bool = False) -> DataFrame:
    """Provenance, file and record of every row that is not as wide as its file's header."""
    if manifest.opens(root):
        return manifest.odd_rows(campaign_files(spark, root, suffix, layout), sep, multi_line)
    tables = []
    for header, paths in _groups(spark, root, suffix).items():
        raw, _ = _scan_group(spark, header, paths, sep, multi_line, "keep")
        rows = raw.select("*", "_metadata").filter(F.col(_ODD).isNotNull() & F.expr(_CELL))
        tables.append(rows.select(*[c.alias(n) for n, c in provenance(_seen_path(), suffix, layout).items()],
                                  _seen_path().alias("file"), F.col(_ODD).alias("record")))
    return bind_rows(*tables)


def scan_tsv(spark: SparkSession, root: str, suffix: str = "_Habitat.point.score.txt",
             na: Sequence[str] = DEFAULT_NA, layout: str = "project/campaign",
             multi_line: bool = False, campaigns: DataFrame | None = None) -> DataFrame:
    return scan_files(spark, root, suffix, sep="\t", na=na, layout=layout, multi_line=multi_line, campaigns=campaigns)


def scan_campaign_info(spark: SparkSession, root: str, suffix: str = "info.csv",
                       layout: str = "project/campaign", multi_line: bool = True,
                       campaigns: DataFrame | None = None) -> DataFrame:
    """Name/value pairs of all campaigns in one scan; the files are usually named ``.info.csv``."""
    return scan_files(spark, root, suffix, layout=layout, multi_line=multi_line, campaigns=campaigns,
                      columns=["name", "value"]).select("project", "campaignid", "name", "value")


def scan_reference_table(spark: SparkSession, path: str, sep: str = ",",
                         na: Sequence[str] = DEFAULT_NA, multi_line: bool = True) -> DataFrame:
    """A life-history, synonym or name-map table (csv or parquet); cells may hold line breaks."""
    if path.rstrip("/").endswith(".parquet"):
        return clean_names(spark.read.parquet(path))
    raw = spark.read.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=multi_line)
    return null_tokens(clean_names(raw), na)


def load_name_map(table: DataFrame, old: str = "old_name", new: str = "new_name") -> list[tuple[str, str]]:
    """The pairs of a map from detailed habitat names to broad ones, for ``rename_by_map``.

    Both columns come in the form headers have here (lower case, ``_`` for
    dots and blanks), new names are lower-cased.  Pairs keep the order of the
    table when it has an ``order`` column, and are sorted otherwise; a map
    has at most one row per column of a table, so it is brought to the driver.
    """
    rows = table.filter(F.col(old).isNotNull() & F.col(new).isNotNull())
    rows = rows.orderBy(*(["order"] if "order" in table.columns else []), old, new)
    pairs = [(clean_name(r[old]), clean_name(r[new])) for r in rows.select(old, new).collect()]
    return list(dict.fromkeys(pairs))


# The metadata columns a study keeps, in their usual order.
METADATA_COLUMNS = (
    "project", "campaignid", "sample", "latitude", "longitude", "date", "time",
    "location", "status", "site", "depth", "observer", "successful_count",
    "successful_length", "comment",
)


def scan_metadata(spark: SparkSession, root: str, suffix: str = "_Metadata.csv",
                  layout: str = "project/campaign",
                  columns: Sequence[str] | None = METADATA_COLUMNS,
                  multi_line: bool = True, campaigns: DataFrame | None = None) -> DataFrame:
    """Sample metadata narrowed to the usual columns (``None`` keeps all).

    Its comments are free text, so cells with line breaks are expected.
    """
    meta = scan_files(spark, root, suffix, layout=layout, multi_line=multi_line, campaigns=campaigns)
    if columns is None:
        return meta
    if layout == "flat":
        columns = [c for c in columns if c != "project"]
    return meta.select(*columns)
