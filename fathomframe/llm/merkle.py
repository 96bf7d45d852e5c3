"""Document fingerprints: a Merkle tree over the paragraphs and sections of a text, in Spark's own functions.

A text is cut into leaves at sentence and line ends, which lose nothing. A paragraph ends with a line, or where
the digest of a leaf says so, a section at a blank line, or where the digest of a paragraph says so: what ends
them is their content, so that an edit changes the branches it lies in and leaves the others as they were. The
fingerprint is the root's digest, then the tree: leaves are ``digest.length``, each followed by a comma, a slash
closes a paragraph and a hash mark a section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: A leaf: up to a sentence or line end, or some hundred characters of text that has none.
LEAF = r"[^.!?\n]{1,240}[.!?\n]*|[.!?\n]+"
#: Hexadecimal digits of a leaf's digest, and those first digits that close a paragraph or section (an eighth).
DIGITS, CLOSING = 16, ("0", "1")
_ROOT = 64


def _sha(x: Column) -> Column:
    return F.sha2(x, 256)


def _split(x: Column, mark: str) -> Column:
    return F.array_remove(F.split(x, mark), "")


def _closes(digest: Column) -> Column:
    return F.substring(digest, 1, 1).isin(*CLOSING)


def _leaf(x: Column) -> Column:
    digest = F.substring(_sha(x), 1, DIGITS)
    mark = F.when(F.endswith(x, F.lit("\n\n")), ",/#").when(F.endswith(x, F.lit("\n")) | _closes(digest), ",/").otherwise(",")
    return F.concat(digest, F.lit("."), F.char_length(x).cast("string"), mark)


def _paragraph(x: Column) -> Column:
    return F.when(~F.endswith(x, F.lit("#")) & _closes(_sha(x)), F.concat(x, F.lit("#"))).otherwise(x)


def _root(tree: Column) -> Column:
    sections = F.transform(_split(tree, "#"), lambda s: _sha(F.array_join(F.transform(_split(s, "/"), _sha), "")))
    return _sha(F.array_join(sections, ""))


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint of a text; null counts as empty, and an empty text has a root without branches."""
    leaves = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(LEAF), F.lit(0)), _leaf)
    paragraphs = F.regexp_extract_all(F.array_join(leaves, ""), F.lit("[^/]+(/#?)?"), F.lit(0))
    tree = F.array_join(F.transform(paragraphs, _paragraph), "")
    return docs.withColumn(out, tree).withColumn(out, F.concat(_root(F.col(out)), F.lit(" "), F.col(out)))


def root(fingerprint: Column) -> Column:
    """The digest that tells whether two texts are equal."""
    return F.substring(fingerprint, 1, _ROOT)


def _tree(fingerprint: Column) -> Column:
    return F.substring(fingerprint, _ROOT + 2, (1 << 31) - 1)


def _length(leaf: Column) -> Column:
    return F.substring_index(leaf, ".", -1).cast("long")


def _weight(leaves: Column) -> Column:
    return F.aggregate(leaves, F.lit(0).cast("long"), lambda held, x: held + _length(x))


def _leaves(tree: Column) -> Column:
    return _split(F.regexp_replace(tree, "[/#]", ""), ",")


def likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """df with the likeness of two fingerprints, 0 to 1: the characters of the leaves they share, as a part of all.

    Equal roots give 1 at once. Otherwise twice the characters of the shared leaves over the sum of both sides';
    copies of a leaf within a text count once. Null if a fingerprint is null.
    """
    x, y = f"_{out}_a", f"_{out}_b"
    sides = df.withColumns({x: F.array_distinct(_leaves(_tree(F.col(a)))), y: F.array_distinct(_leaves(_tree(F.col(b))))})
    shared = _weight(F.array_intersect(F.col(x), F.col(y)))
    part = 2 * shared / (_weight(F.col(x)) + _weight(F.col(y)))
    return sides.withColumn(out, F.when(root(F.col(a)) == root(F.col(b)), 1.0).otherwise(part)).drop(x, y)


def _common(a: Column, b: Column, levels: tuple[str, ...], from_end: bool) -> Column:
    """Characters that two branches share before (or after) the first that differ: sections, then paragraphs, then leaves."""
    x, y = _split(a, levels[0]), _split(b, levels[0])
    if from_end:
        x, y = F.reverse(x), F.reverse(y)
    at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(False)).cast("int")
    same = F.when(at > 0, F.slice(x, F.lit(1), at - 1)).otherwise(x)
    before = _weight(_leaves(F.array_join(same, ",")))
    if len(levels) == 1:
        return before
    below = _common(F.coalesce(F.get(x, at - 1), F.lit("")), F.coalesce(F.get(y, at - 1), F.lit("")), levels[1:], from_end)
    return before + F.when(at > 0, below).otherwise(0)


def edited(df: DataFrame, a: str, b: str, start: str = "edit_start", end: str = "edit_end") -> DataFrame:
    """df with the stretch of a's text, in code points, outside which its branches are those of b.

    The way down goes from the first (and from the last) section that differs to its first paragraph and leaf that
    differ. Equal texts give null; where text is only put in, the stretch is empty.
    """
    x, y = F.col(a), F.col(b)
    differ = root(x) != root(y)
    levels = ("#", "/", ",")
    size = _weight(_leaves(_tree(x)))
    return df.withColumn(start, F.when(differ, _common(_tree(x), _tree(y), levels, False))).withColumn(
        end, F.when(differ, F.greatest(F.col(start), size - _common(_tree(x), _tree(y), levels, True))))


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """_id, _digest, _before, _chars: each id with the one before it in descending order, and that one's most characters.

    One row per id, a null id coming last; the first follows the last. _digest begins the smallest digest of the
    id's texts. Ids are dealt out by range and put in order within a range; ranges meet in a table with one row
    for each.
    """
    digest = F.substring(_sha(F.col(text)), 1, 2 * DIGITS)
    ids = docs.groupBy(F.col(doc_id).alias("_id")).agg(F.min(digest).alias("_digest"), F.max(F.char_length(text)).alias("_chars"))
    ranged = ids.repartitionByRange(F.col("_id").desc_nulls_last()).withColumn("_range", F.spark_partition_id())
    ranged = written(ranged, "merkle-ids")
    here = F.struct("_id", "_chars")
    order = F.col("_id").desc_nulls_last()
    ordered = ranged.withColumn("_last", F.lag(here).over(Window.partitionBy("_range").orderBy(order)))
    ends = ranged.groupBy("_range").agg(F.min_by(here, F.struct(F.col("_id").isNotNull(), "_id")).alias("_end"))
    whole = Window.orderBy("_range")
    all_rows = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("_range", F.coalesce(F.lag("_end").over(whole), F.last("_end").over(all_rows)).alias("_end"))
    met = ordered.join(F.broadcast(ends), "_range")  # as many rows as ranges, that is partitions
    before = F.coalesce("_last", "_end")
    return met.select("_id", "_digest", before["_id"].alias("_before"), before["_chars"].alias("_chars"))


def _key(doc_id: str) -> dict[str, Column]:
    """An id as two columns that are never null."""
    return {"_named": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_unnamed": F.isnull(doc_id)}


def with_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, edited, fingerprint, edited_fingerprint, next_fingerprint of every row of docs.

    edited is the text with its last third of code points replaced by as many (or all) of the first of the next
    document, in descending order of ids and from the last to the first. Null texts count as empty. A null id
    comes last; rows with one id have the same next document, and the text with the smallest digest stands for
    them as a next document. Only the part of a text that its neighbour needs is shuffled a second time.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    links = written(neighbours(plain, "doc_id", "text").withColumns(_key("_id")), "merkle-links")
    own = [v == F.col(k) for k, v in _key("doc_id").items()]
    # no equality of digests here: it would become part of the join's key, and both joins share one exchange of texts
    given = plain.join(links, own).where(F.startswith(_sha(F.col("text")), F.col("_digest")))
    heads = fingerprint(given, "text", "_next").select(
        *[v.alias(k) for k, v in _key("_before").items()], F.expr("left(text, _chars div 3)").alias("_head"), "_next")
    heads = heads.groupBy("_named", "_unnamed").agg(F.first("_head").alias("_head"), F.first("_next").alias("next_fingerprint"))
    both = plain.join(heads, own)
    third = "char_length(text) div 3"
    both = both.withColumn("edited", F.expr(f"concat(left(text, char_length(text) - {third}), left(_head, {third}))"))
    both = fingerprint(fingerprint(both, "text", "fingerprint"), "edited", "edited_fingerprint")
    return both.select("doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint")
