"""Mixing sources to target weights by nested hash thresholds found from histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

MOST_COPIES = 3
#: Bits of the 63-bit row hash that each histogram resolves.
LEVEL_BITS = 10
HASH_BITS = 63
ALL = (1 << HASH_BITS) - 1


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: one row per source in, one out.

    Sources in code point order, null last, weigh 1, 2, 3, repeating. They share the whole size by weight; no
    target passes ``most`` times its source's size, the excess is shared anew among the others by weight. With
    sources ordered by cap over weight, those below the common level are capped: one pass of running sums.
    The windows without a key run over the one-row-per-source table only.
    """
    ordered = sizes.withColumn("_w", 1 + (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3)
    ordered = ordered.withColumn("_cap", most * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    up = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / (
        F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
    levels = ordered.withColumn("_level", level)
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))
    common = F.min(fits).over(whole)["_level"]
    return levels.withColumn("_common", common).select(
        "source", "source_size",
        F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_common") * F.col("_w"), F.lit(0.0))).alias("target"))


def row_hash(doc_id: Column, text: Column) -> Column:
    """63 bits that decide which documents are taken once more."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), doc_id, text), 1)


def _thresholds(narrow: DataFrame, edge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """source, _cut from one histogram after the other, and the boundary buckets of one hash that hold several rows.

    narrow: source, size, _u; edge: source, _rest.
    """
    edge = edge.select("source", "_rest", F.lit(0).cast("long").alias("_prefix"))
    shift, cuts = HASH_BITS, []
    while True:
        last, shift = shift, max(0, shift - LEVEL_BITS)
        inside = narrow.alias("n").join(
            edge.alias("e"), F.col("n.source").eqNullSafe(F.col("e.source"))
            & (F.shiftright(F.col("n._u"), last) == F.col("e._prefix")) if last < HASH_BITS
            else F.col("n.source").eqNullSafe(F.col("e.source")))
        histogram = inside.groupBy(F.col("n.source").alias("source"), F.shiftright("_u", shift).alias("_prefix")).agg(
            F.sum("size").alias("_sum"), F.count("*").alias("_rows"), F.first("_rest").alias("_rest"))
        upto = Window.partitionBy("source").orderBy("_prefix")
        running = histogram.withColumn("_cum", F.sum("_sum").over(upto))
        edge = written(running.where("_cum > _rest").groupBy("source").agg(F.min_by(
            F.struct("_prefix", "_sum", "_rows", (F.col("_rest") - F.col("_cum") + F.col("_sum")).alias("_rest")),
            "_prefix").alias("_b")).select("source", "_b.*"), "mix-edge")
        done = F.col("_rows") <= 1
        upper = F.col("_prefix") + F.when(done & (F.col("_rest") * 2 >= F.col("_sum")), 1).otherwise(0)
        ends = edge if shift == 0 else edge.where(done)
        cuts.append(ends.select("source", F.when(
            F.shiftright(upper, HASH_BITS - shift) == 0, F.shiftleft(upper, shift)).otherwise(ALL).alias("_cut")))
        edge = edge.where(~done).select("source", "_rest", "_prefix")
        if shift == 0 or edge.isEmpty():
            break
    cut = cuts[0]
    for more in cuts[1:]:
        cut = cut.unionByName(more)
    return cut, edge


def mix_plan(narrow: DataFrame) -> DataFrame:
    """source, source_size, target, _base, _cut, _tie, _tie_cut: whole copies and hash thresholds of each source.

    narrow: source, size, _u, _v; written, as each histogram reads it once. Where the boundary bucket is narrowed
    down to one hash with several rows, _tie is that hash and _tie_cut their threshold on _v.
    """
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    budget = source_targets(sizes).withColumn(
        "_base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    budget = written(budget.withColumn("_rest", F.col("target") - F.col("_base") * F.col("source_size")), "mix-targets")
    cut, ties = _thresholds(narrow.select("source", "size", "_u"), budget)
    ties = ties.select("source", F.col("_prefix").alias("_tie"), "_rest")
    if ties.isEmpty():
        ties = ties.select("source", "_tie", F.col("_tie").alias("_tie_cut"))
    else:
        same = F.col("n.source").eqNullSafe(F.col("t.source")) & (F.col("n._u") == F.col("t._tie"))
        alike = narrow.alias("n").join(ties.alias("t"), same).select("n.source", "size", F.col("_v").alias("_u"))
        finer, _ = _thresholds(written(alike, "mix-ties"), ties)
        # without a boundary among them all are taken once more
        ties = ties.alias("t").join(finer.alias("f"), F.col("t.source").eqNullSafe(F.col("f.source")), "left").select(
            "t.source", "_tie", F.coalesce("_cut", F.lit(ALL)).alias("_tie_cut"))
    found = budget.alias("b").join(cut.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")), "left")
    return found.join(ties.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")), "left").select(
        "b.source", "source_size", "target", "_base",
        # without a boundary the budget covers all that is left: nothing if it is nothing
        F.coalesce("_cut", F.when(F.col("_rest") > 0, ALL).otherwise(0)).alias("_cut"), "_tie", "_tie_cut")


def copies() -> Column:
    more = (F.col("_u") < F.col("_cut")) | F.coalesce((F.col("_u") == F.col("_tie")) & (F.col("_v") < F.col("_tie_cut")), F.lit(False))
    return F.least(F.lit(MOST_COPIES), F.col("_base") + F.when(more, 1).otherwise(0)).cast("int")


def row_number_hash() -> Column:
    """63 bits that tell rows equal in id and text apart, by where they stand in the table."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("tie"), F.monotonically_increasing_id()), 1)


def narrowed(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        row_hash(F.col(doc_id), F.col(text)).alias("_u"), row_number_hash().alias("_v"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken: one row per row of docs.

    Every document is taken floor(target / source size) times, and once more where its hash lies below the
    source's threshold. The threshold comes from histograms of size by source and leading hash bits: whole
    buckets below the budget are in, only the boundary bucket is split by the next bits, until it holds one
    row; that row is in if this brings the sum nearer. Nothing is sorted, the histogram combines before its
    shuffle, so one source may hold most rows. The hash is of id and text, so reruns agree. Rows equal in both
    share it; should they be the boundary, histograms of a second hash take as many of them as come nearest to
    the target, and these are the same rows whichever they are. A null text has size 0, a null source is a
    source, a source of size 0 takes nothing.
    """
    narrow = written(narrowed(docs, doc_id, text, source), "mix-sizes")
    plan = mix_plan(narrow)
    out = narrow.alias("n").join(plan.alias("p"), F.col("n.source").eqNullSafe(F.col("p.source")), "left")
    return out.select(
        "doc_id", "size", "source_size", "target", copies().alias("copies"), (F.col("size") * copies()).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of docs as the mix takes them, each as often as it is taken; columns as they were.

    Where equal rows are a boundary, rows are written with what tells them apart before the mix is planned.
    """
    hashes = {"_u": row_hash(F.col(f"_doc.`{doc_id}`"), F.col(f"_doc.`{text}`")), "_of": F.col(f"_doc.`{source}`")}
    plan = mix_plan(written(narrowed(docs, doc_id, text, source), "mix-sizes"))
    rows = docs.select(F.struct("*").alias("_doc"), F.lit(0).cast("long").alias("_v"))
    if not plan.where("_tie IS NOT NULL").isEmpty():
        rows = written(docs.select(F.struct("*").alias("_doc"), row_number_hash().alias("_v")), "mix-rows")
        sizes = rows.withColumns(hashes).select(F.col("_of").alias("source"), word_count(F.col(f"_doc.`{text}`")).alias("size"), "_u", "_v")
        plan = mix_plan(written(sizes, "mix-sizes"))
    plan = plan.select(F.col("source").alias("_source"), "_base", "_cut", "_tie", "_tie_cut")
    met = rows.withColumns(hashes).join(plan, F.col("_of").eqNullSafe(F.col("_source")))
    taken = met.withColumn("_n", copies()).where("_n > 0")
    return taken.select("_doc", F.explode(F.sequence(F.lit(1), "_n"))).select("_doc.*")
