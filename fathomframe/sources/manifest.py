"""Campaign files as a table: what there is, which of it a study needs, and one scan for all headers.

The driver lists files and opens none.  A manifest has one row for each file, so a search result prunes it with a
join before a byte is read.  Headers are read in tasks; what reaches the driver is one row for each column name.
One scan then reads all files, whatever their headers and names: tasks take stretches of files and bind cells to
columns by the header of the file at hand.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import csv as pa_csv
from pyarrow import fs as pa_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomframe.functions.names import unique_names
from fathomframe.operators.joins import join_on

#: Bytes of one stretch of a file whose cells hold no line breaks, and of files that one task reads about.
STRETCH = 128 << 20
#: Bytes that a task parses at once.
BLOCK = 4 << 20
# Stores that tasks open by themselves, and endings of packed files, which are read as a whole.
SCHEMES = ("file", "hdfs", "s3", "gs", "abfs", "abfss")
PACKED = (".gz", ".bz2", ".zst", ".lz4")
_FILE = "file string, size long, modified timestamp"


def opens(root: str) -> bool:
    """Whether tasks can open the files below ``root`` without Spark's readers."""
    return (root.split(":", 1)[0] if ":" in root.split("/", 1)[0] else "file") in SCHEMES


def file_manifest(spark: SparkSession, files: Sequence[tuple[str, int, int]], suffix: str,
                  layout: str = "project/campaign", campaigns: DataFrame | None = None) -> DataFrame:
    """file, size, modified and the provenance columns of listed files (path, bytes, milliseconds).

    ``campaigns`` (a search result with ``name``) keeps the files of these campaigns only.
    """
    from fathomframe.sources.files import provenance

    rows = [(path, size, at) for path, size, at in files]
    table = spark.createDataFrame(rows, "file string, size long, at long").select(
        "file", "size", F.timestamp_millis("at").alias("modified"))
    table = table.withColumns(provenance(F.col("file"), suffix, layout))
    if campaigns is None:
        return table
    found = campaigns.select(F.col("name").alias("campaignid")).distinct()
    return join_on(table, found, ["campaignid"], "left_semi", null_safe=()).select(*table.columns)


def _local(file: str) -> tuple[pa_fs.FileSystem, str]:
    if file.startswith("file:") or "://" not in file:
        return pa_fs.LocalFileSystem(), "/" + file.removeprefix("file:").lstrip("/")
    scheme, rest = file.split("://", 1)
    system, _ = pa_fs.FileSystem.from_uri(f"{scheme}://{rest.split('/', 1)[0]}/")
    return system, rest if scheme in ("s3", "gs") else "/" + rest.split("/", 1)[-1]


def _reader(file: str, start: int = 0) -> io.BufferedReader:
    system, path = _local(file)
    if file.endswith(PACKED):
        return io.BufferedReader(system.open_input_stream(path, compression="detect"), BLOCK)
    stream = system.open_input_file(path)
    stream.seek(start)
    return io.BufferedReader(stream, BLOCK)


def _header(raw: io.BufferedReader, sep: str) -> tuple[list[str], int]:
    """The names in the first record, line breaks within quotes included, and its bytes; no names in an empty file."""
    head = raw.readline()
    while head.count(b'"') % 2 and (more := raw.readline()):
        head += more
    text = head.decode("utf-8", "replace").removeprefix("﻿")
    return next(csv.reader(io.StringIO(text), delimiter=sep, quotechar='"', doublequote=True), []), len(head)


class _Stretch(io.RawIOBase):
    """The lines of a file that begin before ``left`` more bytes are read; without an end, all of them."""

    def __init__(self, raw: io.BufferedReader, left: int | None) -> None:
        self.raw, self.left, self.last = raw, left, b"\n"

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        if self.left is None:
            got = self.raw.read(len(out))
        elif self.left > 0:
            got = self.raw.read(min(len(out), self.left))
            self.left -= len(got)
        elif self.last != b"\n":  # the line that reaches over the end
            got = self.raw.readline(len(out))
        else:
            got = b""
        self.last = got[-1:] or self.last
        out[: len(got)] = got
        return len(got)


def headers(manifest: DataFrame, sep: str = ",") -> DataFrame:
    """The manifest with ``header``, the normalised names of each file; read in tasks, an empty array in an empty file."""
    kinds = {f.name: f.dataType.simpleString() for f in manifest.schema}
    ddl = ", ".join(f"{k} {v}" for k, v in kinds.items())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [unique_names(_header(_reader(f), sep)[0]) for f in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.list_(pa.string()))], [*batch.schema.names, "header"])

    return _dealt(manifest).mapInArrow(read, f"{ddl}, header array<string>")


def _dealt(rows: DataFrame, size: str | None = None) -> DataFrame:
    """Rows of files in as many partitions as their bytes or, at least, their number and the session's cores ask for."""
    found = rows.agg(F.count("*").alias("n"), F.sum(size or F.lit(0)).alias("b")).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(found.n, cores), min(found.n, (found.b or 0) // STRETCH)))


def column_names(manifest: DataFrame, sep: str = ",") -> list[str]:
    """All names in the headers, in the order in which they come first (by path, then place)."""
    seen = headers(manifest, sep).select("file", F.posexplode("header").alias("place", "name"))
    first = seen.groupBy("name").agg(F.min(F.struct("file", "place")).alias("first"))
    return [r["name"] for r in first.orderBy("first", "name").collect()]


def _stretches(manifest: DataFrame, multi_line: bool) -> DataFrame:
    """file, start, bytes of the stretches that are read on their own; the last one of a file has no end."""
    whole = F.lit(multi_line) | F.col("file").rlike("(" + "|".join("\\" + p for p in PACKED) + ")$")
    count = F.when(whole, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(STRETCH)))).cast("int")
    parts = manifest.withColumn("count", count).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
    long = F.lit(STRETCH).cast("long")
    return parts.select(*manifest.columns, (F.col("at") * long).alias("start"),
                        F.when(F.col("at") < F.col("count") - 1, long).alias("bytes"),
                        F.when(F.col("count") > 1, F.least(long, F.col("size"))).otherwise(F.col("size")).alias("weight"))


def _tables(file: str, start: int, size: int | None, sep: str, multi_line: bool, wanted: Sequence[str] | None,
            odd) -> Iterator[tuple[list[str], pa.Table]]:
    """Names and cells, a block at a time, of the lines of one file that begin in a stretch.

    ``odd`` is given the record and the width asked for of each row of another width; such a row is left out.
    """
    raw = _reader(file)
    names, skipped = _header(raw, sep)
    names = unique_names(names)
    if not names:
        return
    if start:  # a line that begins at the start is its own; one byte before tells
        raw = _reader(file, max(start - 1, skipped - 1))
        begin = max(start - 1, skipped - 1) + len(raw.readline())
        if size is not None and begin >= start + size:
            return
    else:
        begin = skipped
    body = io.BufferedReader(_Stretch(raw, None if size is None else max(0, start + size - begin)), BLOCK)
    if not body.peek(1):
        return

    met: list[str] = []  # an error must not be raised within the parser, which would hide it

    def narrow(row) -> str:
        met.append(row.text)
        return "skip"

    def told() -> None:
        for record in met:
            if record.strip():
                odd(record, len(names))
        met.clear()

    places = [f"c{i}" for i in range(len(names))]
    use = [p for p, n in zip(places, names) if wanted is None or n in wanted]
    try:
        blocks = pa_csv.open_csv(
            body, pa_csv.ReadOptions(column_names=places, block_size=BLOCK, use_threads=False),
            pa_csv.ParseOptions(delimiter=sep, newlines_in_values=multi_line, invalid_row_handler=narrow),
            pa_csv.ConvertOptions(column_types={p: pa.binary() for p in places}, include_columns=use or places[:1], null_values=[""],
                                  strings_can_be_null=True, quoted_strings_can_be_null=False))
    except pa.ArrowInvalid as error:
        told()
        if "Empty CSV" in str(error):  # blank lines or odd rows only
            return
        raise
    for block in blocks:
        told()
        yield [names[int(p[1:])] for p in block.schema.names], pa.Table.from_batches([block])
    told()


def _text(column: pa.ChunkedArray) -> pa.Array:
    column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x if x is None else x.decode("utf-8", "replace") for x in column.to_pylist()], pa.string())


def _provenance_of(manifest: DataFrame) -> list[str]:
    return [c for c in manifest.columns if c in ("project", "campaignid")]


def scan_manifest(manifest: DataFrame, names: Sequence[str], sep: str = ",", multi_line: bool = False,
                  odd_rows: str = "fail") -> DataFrame:
    """Provenance and the named columns, as text, of all files of a manifest in one scan.

    A file without a column has NULL there.  Columns that are not named are not converted.  A row that is not as
    wide as its file's header ends the job, or is left out with ``odd_rows="skip"``.
    """
    own = _provenance_of(manifest)
    wanted = [n for n in names if n not in own]
    schema = ", ".join(f"`{n}` string" for n in [*own, *wanted])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                def odd(record, width):
                    if odd_rows == "fail":
                        raise ValueError(f"a row is not as wide as its header ({width} columns) in {row['file']}: {record[:200]}")

                for there, block in _tables(row["file"], row["start"], row["bytes"], sep, multi_line, wanted, odd):
                    at = {n: i for i, n in reversed(list(enumerate(there)))}
                    cells = [_text(block.column(at[n])) if n in at else pa.nulls(len(block), pa.string()) for n in wanted]
                    source = [pa.array([row[c]] * len(block), pa.string()) for c in own]
                    yield pa.RecordBatch.from_arrays([*source, *cells], [*own, *wanted])

    return _dealt(_stretches(manifest, multi_line), "weight").mapInArrow(read, schema)


def odd_rows(manifest: DataFrame, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """Provenance, file and record of every row that is not as wide as its file's header."""
    own = _provenance_of(manifest)
    out = [*own, "file", "record"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                records: list[str] = []
                for _ in _tables(row["file"], row["start"], row["bytes"], sep, multi_line, [], lambda record, _: records.append(record)):
                    pass
                rows = [[row[c]] * len(records) for c in [*own, "file"]] + [records]
                yield pa.RecordBatch.from_arrays([pa.array(r, pa.string()) for r in rows], out)

    return _dealt(_stretches(manifest, multi_line), "weight").mapInArrow(read, ", ".join(f"{c} string" for c in out))
