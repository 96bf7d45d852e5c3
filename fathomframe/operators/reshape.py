"""Reshaping: completing combinations, repeating rows, wide/long, name maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomframe.functions.columns import columns_with_prefix, row_total
from fathomframe.operators.joins import hinted, join_on

_KEY, _BLOCK, _SHARE, _CELLS, _ALL, _ONE, _OUT = (
    "__key", "__block", "__share", "__cells", "__all", "__one", "__out")
RIGHT_BLOCKS = 32


def _bucket(columns: Sequence[str], count: int) -> Column:
    """Hash bucket, never NULL: for a column that could be, Spark would add a
    not-null filter to one of several readers of a shared exchange, and the
    exchange would no longer be shared."""
    return F.coalesce(F.pmod(F.xxhash64(*columns), F.lit(count)), F.lit(0)).cast("int")


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _left_names(left: Sequence[str]) -> list[str]:
    return [f"__left{i}" for i in range(len(left))]


def keyed(lefts: DataFrame, left: Sequence[str]) -> DataFrame:
    """``lefts`` with what finds their cells again, even after ``left`` columns were replaced."""
    return lefts.withColumns({
        **{k: F.col(c) for k, c in zip(_left_names(left), left, strict=True)},
        _KEY: F.coalesce(F.xxhash64(*left), F.lit(0))})


def cells_by_left(cells: DataFrame, left: Sequence[str], right: Sequence[str],
                  blocks: int = RIGHT_BLOCKS) -> DataFrame:
    """One row per ``left`` tuple and block of ``right`` tuples with the array of its cells there.

    ``cells`` holds each (left, right) pair once and a ``right`` tuple belongs
    to one hashed block, so a row holds no more cells than a block has tuples,
    however many raw rows or cells one ``left`` tuple has.  The partition
    count is explicit: these partitions are small now but grow to the dense
    result, so they must not be merged by size.  All later steps read this
    one exchange.
    """
    left = list(left)
    values = [c for c in cells.columns if c not in left and c not in right]
    names = _left_names(left)
    packed = keyed(cells, left).select(_KEY, _bucket(right, blocks).alias(_BLOCK), *names, F.struct(*right, *values).alias(_ONE))
    packed = packed.repartition(shuffle_partitions(cells), _KEY, _BLOCK)
    return packed.groupBy(_KEY, _BLOCK, *names).agg(F.collect_list(_ONE).alias(_CELLS))


def left_tuples(by_left: DataFrame, left: Sequence[str]) -> DataFrame:
    """The distinct ``left`` tuples that have cells."""
    # the condition always holds: it keeps the cells in the plan, so that their exchange is shared
    held = by_left.where(F.size(_CELLS) > 0)
    return held.select(*[F.col(k).alias(c) for k, c in zip(_left_names(left), left, strict=True)]).distinct()


def right_tuples(by_left: DataFrame, right: Sequence[str]) -> DataFrame:
    """The distinct ``right`` tuples that occur in any cell.

    Taken from the gathered cells and not from the table they came from:
    the columns needed would be pruned down to the scan there, and the data
    would be read and aggregated a second time.
    """
    one = by_left.select(F.explode(_CELLS).alias(_ONE))
    return one.select(*[F.col(f"{_ONE}.{c}").alias(c) for c in right]).distinct()


def expand_cells(by_left: DataFrame, lefts: DataFrame, left: Sequence[str], tuples: DataFrame,
                 right: Sequence[str], values: Sequence[str] | None = None,
                 blocks: int = RIGHT_BLOCKS, carry: DataFrame | None = None,
                 carry_key: Sequence[str] = ()) -> DataFrame:
    """Rows for the ``right`` tuples each of ``lefts`` (see :func:`keyed`) lacks.

    With ``values`` the cells it has are returned as well, and new cells carry
    NULL values.  A left row meets its cells and then the tuples block by
    block through equi joins.  The difference and the expansion come after
    the last shuffle; dense rows never move.
    """
    right, names = list(right), _left_names(left)
    others = [c for c in lefts.columns if c not in (_KEY, *names)]
    # Few blocks would mean few join keys: spread each over several shares of
    # the left rows, as many as the cluster has partitions for.
    shares = max(1, -(-shuffle_partitions(by_left) // blocks))

    block = _bucket(right, blocks)
    listed = (tuples.groupBy(block.alias(_BLOCK))
              .agg(F.collect_list(F.struct(*right)).alias(_ALL))
              .withColumn(_SHARE, F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))))
    spread = lefts.withColumn(_BLOCK, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # The hash of the left tuple is the key, so its columns are compared apart from the key: as equalities they
    # would become part of it, and the gathered cells would be shuffled anew.
    alike = ~F.array_contains(F.array(*[spread[k].eqNullSafe(by_left[k]) for k in names]), F.lit(False))
    own = spread.join(by_left, (spread[_KEY] == by_left[_KEY]) & (spread[_BLOCK] == by_left[_BLOCK]) & alike, "left")
    per_block = own.select(*[spread[c] for c in others], spread[_BLOCK],
                           F.coalesce(F.pmod(spread[_KEY], F.lit(shares)), F.lit(0)).cast("int").alias(_SHARE), _CELLS)

    # What a row lacks is told by places in the list, what it has by negative ones in its cells: the tuples
    # themselves are compared once for each cell and copied only into the rows they end in.
    places = F.sequence(F.lit(1), F.size(_ALL))
    held = F.transform(_CELLS, lambda c: F.array_position(
        _ALL, F.struct(*[c[k].alias(k) for k in right])).cast("int"))
    out = F.array_except(places, held)
    if values is not None:
        out = F.concat(out, F.sequence(-F.size(_CELLS), F.lit(-1)))
    out = F.when(F.col(_CELLS).isNull(), places).otherwise(out)
    # The places are a column of their own: inside the generator they would keep Spark from compiling the
    # expansion. A plain explode would filter on their number first, and so compute them twice.
    lacking = per_block.join(listed, [_BLOCK, _SHARE]).select(
        *others, _BLOCK, _SHARE, _ALL, _CELLS if values is not None else F.lit(None).alias(_CELLS), out.alias(_OUT))
    if carry is not None:
        others = [*carry_key, *[c for c in others if c not in carry_key], *[c for c in carry.columns if c not in carry_key]]
        lacking = join_on(lacking.drop(_ALL), carry, carry_key, "inner", null_safe=()).join(listed, [_BLOCK, _SHARE])
    dense = lacking.select(*others, _ALL, _CELLS, F.explode_outer(_OUT).alias(_ONE)).where(F.col(_ONE).isNotNull())
    at, listed_at, cell_at = F.col(_ONE), F.get(_ALL, F.col(_ONE) - 1), F.get(_CELLS, -F.col(_ONE) - 1)
    if values is None:
        return dense.select(*others, *[listed_at[c].alias(c) for c in right])
    return dense.select(
        *others, *[F.when(at > 0, listed_at[c]).otherwise(cell_at[c]).alias(c) for c in right],
        *[F.when(at < 0, cell_at[c]).alias(c) for c in values])


def fill_missing(df: DataFrame, fill: Mapping[str, object]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
        for c, v in fill.items()})


def complete_cells(cells: DataFrame, left: Sequence[str], right: Sequence[str],
                   fill: Mapping[str, object] | None = None,
                   carry: DataFrame | None = None, carry_how: str = "inner",
                   blocks: int = RIGHT_BLOCKS, wanted: Column | None = None,
                   fits: bool | None = None) -> DataFrame:
    """Complete a table that holds each (left, right) pair once.

    The table is read once and its rows travel inside the arrays of their left
    tuple.  ``carry`` (keyed by ``left``) is joined once per left tuple and not
    once per dense row.  Only ``right`` tuples that
    are ``wanted`` are filled in or returned; left tuples stay whatever they hold.
    ``fits`` tells that ``carry`` was measured (see ``joins.hinted``).
    """
    left, right = list(left), list(right)
    values = [c for c in cells.columns if c not in left and c not in right]
    by_left = cells_by_left(cells, left, right, blocks)
    tuples, lefts = right_tuples(by_left, right), left_tuples(by_left, left)
    if wanted is not None:
        tuples = tuples.filter(wanted)
    if carry is not None:
        lefts = join_on(lefts, hinted(carry, fits), left, carry_how, null_safe=left)
    out = expand_cells(by_left, keyed(lefts, left), left, tuples, right, values, blocks)
    if wanted is not None:
        out = out.filter(wanted)
    return fill_missing(out, fill) if fill else out


def complete(df: DataFrame, left: Sequence[str], right: Sequence[str],
             fill: Mapping[str, object] | None = None,
             blocks: int = RIGHT_BLOCKS) -> DataFrame:
    """All rows of ``df`` plus one row for each missing combination of
    observed ``left`` and observed ``right`` tuples; NULL counts as a value.

    Rows of ``df`` are not shuffled, only their distinct pairs.  ``fill``
    replaces missing values, those already in ``df`` included.
    """
    left, right = list(left), list(right)
    by_left = cells_by_left(df.select(*left, *right).distinct(), left, right, blocks)
    lefts = keyed(left_tuples(by_left, left), left)
    missing = expand_cells(by_left, lefts, left, right_tuples(by_left, right), right, None, blocks)
    out = df.unionByName(missing, allowMissingColumns=True)
    return fill_missing(out, fill) if fill else out


def complete_classes(df: DataFrame, left: Sequence[str], column: str,
                     fill: Mapping[str, object] | None = None) -> DataFrame:
    """:func:`complete` for one column of few distinct values.

    The values are brought to the driver if there are few: they are the
    classes of a count (legal and sublegal), not data.  Rows of ``df`` are not
    shuffled; the classes a left tuple has are gathered without its rows.
    """
    found = df.select(column).distinct().limit(MOST_CLASSES + 1).collect()
    classes = sorted((r[0] for r in found), key=lambda v: (v is None, v))
    kind, left = df.schema[column].dataType, list(left)
    if len(classes) > MOST_CLASSES:
        return complete(df, left, [column], fill)
    every = F.array(*[F.struct(F.lit(v).cast(kind).alias(column)) for v in classes])
    seen = df.groupBy(*left).agg(F.collect_set(F.struct(column)).alias(_CELLS))
    lacking = seen.select(*left, F.explode(F.array_except(every, _CELLS)).alias(_ONE)).select(
        *left, F.col(f"{_ONE}.{column}").alias(column))
    out = df.unionByName(lacking, allowMissingColumns=True)
    return fill_missing(out, fill) if fill else out


MOST_CLASSES = 100
_CHUNK = 10_000


def uncount(df: DataFrame, weight: str, keep: bool = False) -> DataFrame:
    """Repeat each row ``weight`` times; fractions are cut off, zero and
    missing give no row.

    A large weight is split into chunks first so that no single array grows
    with the data.
    """
    n = F.coalesce(F.floor(F.col(weight)).cast("long"), F.lit(0).cast("long"))
    chunks = F.ceil(F.col("__n") / F.lit(_CHUNK)).cast("int")
    size = F.least(F.lit(_CHUNK).cast("long"),
                   F.col("__n") - F.col("__chunk") * F.lit(_CHUNK)).cast("int")
    out = (df.withColumn("__n", n).filter(F.col("__n") > 0)
           .withColumn("__chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
           .withColumn("__one", F.explode(F.array_repeat(F.lit(1), size)))
           .drop("__n", "__chunk", "__one"))
    return out if keep else out.drop(weight)


def pivot_wide(df: DataFrame, keys: Sequence[str], name: str, value: str,
               names: Sequence[str] | None = None, fill: object = None) -> DataFrame:
    """One column per name.  Two values for one cell are an error, raised by
    the job that meets them."""
    cell = (F.when(F.count(F.lit(1)) > 1,
                   F.raise_error(F.lit("more than one value for a cell")))
            .otherwise(F.max(value)))
    wide = df.groupBy(*keys).pivot(name, None if names is None else list(names)).agg(cell)
    if fill is None:
        return wide
    return wide.fillna(fill, subset=[c for c in wide.columns if c not in keys])


def unpivot_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 name: str, value: str) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


def bind_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name; a column missing somewhere is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def mapped_names(names: Sequence[str],
                 mapping: Sequence[tuple[str, str]] | Mapping[str, str]) -> list[str]:
    """Rename by exact match, pair after pair: a later pair can rename what an
    earlier pair produced."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping
    out = list(names)
    for old, new in pairs:
        out = [new if n == old else n for n in out]
    return out


def rename_by_map(df: DataFrame, mapping, id_cols: Sequence[str]) -> DataFrame:
    """Rename columns by a name map; columns that end under one name are added."""
    values = [c for c in df.columns if c not in id_cols]
    targets: dict[str, list[str]] = {}
    for old, new in zip(values, mapped_names(values, mapping), strict=True):
        targets.setdefault(new, []).append(old)
    cols = [F.col(old[0]).alias(new) if len(old) == 1 else row_total(old).alias(new)
            for new, old in targets.items()]
    return df.select(*id_cols, *cols)


def prefix_sums(df: DataFrame, prefixes: Mapping[str, str],
                id_cols: Sequence[str]) -> DataFrame:
    """One total per name over all original columns starting with its prefix.

    A prefix without columns gives zero.  All totals read the original
    columns because they share one select.
    """
    return df.select(*id_cols, *[
        row_total([c for c in columns_with_prefix(df, p) if c not in id_cols]).alias(name)
        for name, p in prefixes.items()])
