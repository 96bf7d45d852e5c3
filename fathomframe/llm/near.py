"""Near duplicates: a multi-index Hamming join of b-bit minhash signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only_keys, text_batches, written
from .graph import components

SHINGLE = 5
PERCENT = 85
#: Signature: ELEMENTS minhashes of 16 bits. The first KEYED are indexed, all are compared.
ELEMENTS, KEYED, CHUNKS = 128, 64, 12
#: Largest numbers of differing elements: 5 and 4.75 standard deviations above the mean at similarity 0.85.
KEYED_DISTANCE, DISTANCE = 23, 38
ERRORS = KEYED_DISTANCE // CHUNKS
#: Members of a key or a home that are met with as many others at a time, and shingles of a home.
BLOCK, WHOLE = 512, 1_000_000
#: Members of pairs of homes that a task gathers before it sends them once each.
CELL_ROWS = 200_000
#: Keys of more members than CROWD are first met by members drawn from them, at most TURNS times and while a turn
#: links one of WORTH members.
CROWD, TURNS, WORTH = 8, 8, 50
#: Word hashes that a task keeps between texts, and signatures whose keys leave it at a time.
KNOWN_WORDS, KEYED_ROWS = 100_000, 1_000
LAST = (1 << 63) - 1
_RNG = np.random.default_rng(20)
_XOR = _RNG.integers(0, 1 << 32, ELEMENTS, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 32, ELEMENTS, dtype=np.uint32) | np.uint32(1)
_BOUNDS = np.linspace(0, KEYED, CHUNKS + 1).round().astype(int)


class Shingler:
    """Sets of hashed 5-word shingles; word hashes are kept between texts."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles; of fewer than five words, their whole sequence is one."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()
        known = self.words
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(words))
        n = len(words) - size + 1
        out = np.full(n, size, np.uint64)
        for i in range(size):
            out = (out ^ hashes[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 16 low bits of ELEMENTS minhashes; zeros for an empty set."""
    if not len(shingles):
        return np.zeros(ELEMENTS, np.uint16)
    low = np.full(ELEMENTS, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 512):
        np.minimum(low, ((short[i : i + 512, None] ^ _XOR) * _MUL).min(axis=0), out=low)
    low = low * np.uint32(0x85EBCA6B)
    return (low >> np.uint32(16)).astype(np.uint16)


def index_keys(signature: np.ndarray) -> np.ndarray:
    """Keys of a signature: each chunk with each of its elements left out.

    Two signatures that differ in at most KEYED_DISTANCE indexed elements differ in at most ERRORS = 1 elements
    of some chunk, so they agree on the key that leaves that element out.
    """
    out = np.empty(KEYED, np.uint64)
    for c in range(CHUNKS):
        low, high = _BOUNDS[c], _BOUNDS[c + 1]
        for p in range(low, high):
            out[p] = xxhash.xxh64_intdigest(np.delete(signature[low:high], p - low).tobytes(), p)
    return out.astype(np.int64)


def first_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For rows of signatures, the position left out of the first key that they share; KEYED if none."""
    differ = a[:, :KEYED] != b[:, :KEYED]
    out = np.full(len(a), KEYED)
    for c in reversed(range(CHUNKS)):
        low, high = _BOUNDS[c], _BOUNDS[c + 1]
        own = differ[:, low:high]
        errors = own.sum(axis=1)
        out[errors == 1] = low + own[errors == 1].argmax(axis=1)
        out[errors == 0] = low
    return out


def sets(docs: DataFrame, doc_id: str, text: str, full: bool) -> DataFrame:
    """vertex (the id, null as the largest number), n, and the set itself or its digest and signature."""
    schema = "vertex long, n long, " + ("shingles array<long>" if full else "digest binary, sig binary")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in text_batches(batches, "text"):
            own = [shingler.shingles(x) for x in batch["text"]]
            out = pd.DataFrame({"vertex": batch["vertex"], "n": [len(s) for s in own]})
            if full:
                out["shingles"] = [np.sort(s.view(np.int64)) for s in own]
            else:
                out["digest"] = [xxhash.xxh128_digest(s.tobytes()) for s in own]
                out["sig"] = [signature(s).tobytes() for s in own]
            yield out

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("vertex"), F.col(text).alias("text"))
    return rows.mapInPandas(run, schema)


def _confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            common = int((y[at] == x).sum()) if len(y) else 0
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(out)

    left = full.select(F.col("vertex").alias("a"), F.col("shingles").alias("_x"))
    right = full.select(F.col("vertex").alias("b"), F.col("shingles").alias("_y"))
    sized = pairs.join(left, "a").join(right, "b")
    ordered = sized.where(F.least(F.size("_x"), F.size("_y")) * 100 >= percent * F.greatest(F.size("_x"), F.size("_y")))
    return ordered.where(F.pandas_udf(similar, "boolean")("_x", "_y")).select("a", "b")


def _apart(member: DataFrame) -> DataFrame:
    """The members of keys that still hold several components, with the number of the key's members."""
    keys = member.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count("*").alias("members"))
    return member.drop("members").join(keys.where("_lo < _hi").select("key", "members"), "key")


def _drawn_pairs(member: DataFrame, turn: int, percent: int) -> DataFrame:
    """The pairs (a, b) of one member drawn from each key and the key's members in other components that may be similar."""
    mixed = member.withColumn("_order", F.xxhash64("vertex", F.lit(turn)))
    lowest = mixed.groupBy("key").agg(F.min("_order").alias("_order"))
    drawn = mixed.join(lowest, ["key", "_order"]).select(
        "key", F.col("vertex").alias("_v"), F.col("component").alias("_c"), F.col("n").alias("_n"), F.col("lone").alias("_lone"))
    common = F.least(F.col("n") - F.col("lone"), F.col("_n") - F.col("_lone"))
    near = member.join(drawn, "key").where("component <> _c").where(common * 100 >= percent * (F.col("n") + F.col("_n") - common))
    return near.select(F.least("vertex", "_v").alias("a"), F.greatest("vertex", "_v").alias("b")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (vertex, component) after ``links`` between vertices joined their components."""
    ends = links.join(labels.toDF("a", "_a"), "a", "left").join(labels.toDF("b", "_b"), "b", "left")
    into = written(components(ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))), "merged")
    moved = labels.join(into.toDF("component", "_into"), "component", "left").select(
        "vertex", F.coalesce("_into", "component").alias("component"))
    # a component's smallest vertex has no row of its own
    return written(moved.unionByName(into), "labels")


def _relabelled(member: DataFrame, labels: DataFrame) -> DataFrame:
    return member.drop("component").join(labels, "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))


def _homes(member: DataFrame) -> DataFrame:
    """vertex, home: members whose largest key is the same share a home, of about BLOCK members or WHOLE shingles at most."""
    own = member.groupBy("vertex").agg(F.max(F.struct("members", "key"))["key"].alias("key"), F.max("n").alias("n"))
    many = own.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / WHOLE)).alias("_m"))
    home = F.xxhash64("key", F.pmod(F.xxhash64("vertex", F.lit("home")), F.col("_m")))
    return own.join(many, "key").select("vertex", home.alias("home"))


def _blocks(members: DataFrame) -> DataFrame:
    """Each member of a key once for each pair of blocks it takes part in: no task meets more than two blocks."""
    many = members.withColumn("_m", F.ceil(F.col("members") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("vertex", F.lit("block")), F.col("_m")).cast("int")
    many = many.withColumn("_own", own)
    return many.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_m") - 1))).select(
        "key", "left_out", "vertex", "component", "n", "lone", "sig", "home", "_own",
        F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))


def _groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of each key, which follow each other."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        whole = pd.concat([*held, batch], ignore_index=True)
        last = (whole[key] == whole[key].iloc[-1]).all(axis=1)
        held = [whole[last]]
        for _, g in whole[~last].groupby(key, sort=False):
            yield g
    yield from held


def _similar_signatures(g: pd.DataFrame, side: np.ndarray, i: int, j: int, percent: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """For each row x of side i the rows y of side j that may be similar, with the rows' components, which a caller may join."""
    sig = np.frombuffer(b"".join(g["sig"]), np.uint16).reshape(len(g), ELEMENTS)
    comp, n, lone, v = (g[x].to_numpy(copy=True) for x in ("component", "n", "lone", "vertex"))
    for x in np.flatnonzero(side == i):
        y = np.flatnonzero((side == j) & (comp != comp[x]) & ((v > v[x]) if i == j else True))
        common = np.minimum(n[x] - lone[x], n[y] - lone[y])
        y = y[common * 100 >= percent * (n[x] + n[y] - common)]
        y = y[(sig[y] != sig[x]).sum(axis=1) <= DISTANCE]
        if len(y):
            yield comp, x, y


def _cells(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """lo, hi, vertex: pairs of homes, and those of their members that may be similar to one of the other home.

    A pair counts in the first key that it shares.
    """
    def meeting(g: pd.DataFrame) -> pd.DataFrame:
        home, v = g["home"].to_numpy(), g["vertex"].to_numpy()
        sig = np.frombuffer(b"".join(g["sig"]), np.uint16).reshape(len(g), ELEMENTS)
        found = [np.zeros((0, 3), np.int64)]
        for _, x, y in _similar_signatures(g, g["_own"].to_numpy(), g["_i"].iloc[0], g["_j"].iloc[0], percent):
            y = y[first_key(np.broadcast_to(sig[x], (len(y), ELEMENTS)), sig[y]) == g["left_out"].iloc[0]]
            lo, hi = np.minimum(home[x], home[y]), np.maximum(home[x], home[y])
            found += [np.stack([lo, hi, v[y]], 1), np.stack([lo, hi, np.full(len(y), v[x])], 1)]
        return pd.DataFrame(np.concatenate(found), columns=["lo", "hi", "vertex"]).drop_duplicates()

    out, rows = [], 0
    for g in _groups(batches, ["key", "_i", "_j"]):
        out.append(meeting(g))
        rows += len(out[-1])
        if rows >= CELL_ROWS:
            yield pd.concat(out).drop_duplicates()
            out, rows = [], 0
    if rows:
        yield pd.concat(out).drop_duplicates()


def _links(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """a, b: of the members of each pair of homes, as many similar pairs as join all components that such pairs join."""
    for g in _groups(batches, ["lo", "hi"]):
        v, n, home, found = g["vertex"].to_numpy(), g["n"].to_numpy(), g["home"].to_numpy(), []
        ends = np.cumsum(n)
        values, places = np.unique(np.concatenate(list(g["shingles"])), return_inverse=True)
        own, held = np.split(places, ends[:-1]), np.zeros(len(values), bool)
        for comp, x, near in _similar_signatures(g, home, g["lo"].iloc[0], g["hi"].iloc[0], percent):
            held[own[x]] = True
            for y in near:
                if comp[y] != comp[x]:
                    common = int(held[own[y]].sum())
                    if 100 * common >= percent * (int(n[x]) + int(n[y]) - common):
                        found.append((min(v[x], v[y]), max(v[x], v[y])))
                        comp[comp == comp[y]] = comp[x]
            held[own[x]] = False
        yield pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])


def _all_links(member: DataFrame, vertices: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """a, b: links that join all members of keys that similar pairs of them join.

    Pairs are neither rows nor sent: keys tell which homes have members to be compared, and each such pair of homes
    gets the sets of those members and compares them.
    """
    rows = member.select("vertex", "component", "n", "lone").distinct().join(vertices.select("vertex", "n", "sig"), ["vertex", "n"])
    rows = written(rows.join(_homes(member), "vertex"), "homes")
    blocks = _blocks(member.select("key", "left_out", "members", "vertex", "n").join(rows, ["vertex", "n"]))
    dealt = blocks.repartition("key", "_i", "_j").sortWithinPartitions("key", "_i", "_j")
    cells = written(dealt.mapInPandas(lambda x: _cells(x, percent), "lo long, hi long, vertex long").distinct(), "cells")
    sets_of = full.select("vertex", F.size("shingles").cast("long").alias("n"), "shingles")
    met = cells.join(rows, "vertex").join(sets_of, ["vertex", "n"]).repartition("lo", "hi").sortWithinPartitions("lo", "hi")
    return met.mapInPandas(lambda x: _links(x, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    Documents are linked when the similarity of their sets of distinct 5-word shingles (A-Z lower-cased) is at
    least ``percent``; a component's id is its smallest doc_id, whose row is kept. An empty set links with
    nothing. A null id counts as the largest and comes back null; rows with one id are one document.

    Equal sets are one vertex from the start. Signatures meet on keys, each document of a key is first compared
    with the key's smallest. Where the counts of shingles found nowhere else leave similarity possible, large keys
    still apart are met by members drawn from them, turn after turn, so that a large group is joined by few links;
    what is apart then is compared in pairs of homes, to which keys bring their members that may be similar.
    """
    marks = written(sets(docs, doc_id, text, full=False), "signatures")
    vertices = written(marks.where("n > 0").groupBy("digest").agg(
        F.min("vertex").alias("vertex"), F.first("n").alias("n"), F.first("sig").alias("sig")), "vertices")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), KEYED_ROWS):
                part = batch.iloc[i : i + KEYED_ROWS]
                keys = [index_keys(np.frombuffer(s, np.uint16)) for s in part["sig"]]
                yield pd.DataFrame({
                    "key": np.concatenate(keys), "left_out": np.tile(np.arange(KEYED), len(keys)),
                    "vertex": np.repeat(part["vertex"].to_numpy(), KEYED)})

    index = vertices.select("vertex", "sig").mapInPandas(keyed, "key long, left_out int, vertex long")
    leaders = index.groupBy("key").agg(F.min("vertex").alias("lead"), F.max("vertex").alias("_top"), F.count("*").alias("members"))
    shared = written(index.join(leaders.where("lead < _top").drop("_top"), "key"), "shared-keys")
    stars = written(shared.where("vertex <> lead").select(F.col("lead").alias("a"), F.col("vertex").alias("b")).distinct(), "stars")
    touched = written(stars.select(F.explode(F.array("a", "b")).alias("vertex")).distinct(), "touched")
    ids = docs.withColumn("_vertex", F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))).select("_vertex", F.col(text).alias("_text"))
    wanted = only_keys(ids, touched.withColumnRenamed("vertex", "_vertex"), ["_vertex"])
    full = written(sets(wanted, "_vertex", "_text", full=True), "sets")
    links = written(_confirm(stars, full, percent), "links")
    labels = components(links)

    member = written(_apart(_relabelled(shared.where("members > 2").withColumn("component", F.lit(None)), labels)), "apart")
    if not member.isEmpty():
        rest = full.join(member.select("vertex").distinct(), "vertex", "left_semi")
        each = rest.select("vertex", F.explode("shingles").alias("s"))
        alone = each.groupBy("s").agg(F.min("vertex").alias("vertex"), F.max("vertex").alias("_top")).where("vertex = _top")
        lone = alone.groupBy("vertex").agg(F.count("*").alias("lone"))
        sized = vertices.select("vertex", "n").join(lone, "vertex", "left").withColumn("lone", F.coalesce("lone", F.lit(0)))
        possible = sized.where(F.col("lone") * 100 <= (100 - percent) * F.col("n"))
        member = written(_apart(member.join(possible, "vertex")), "possible")
        for turn in range(TURNS):
            crowded = member.where(F.col("members") > CROWD)
            many = crowded.select("vertex").distinct().count()
            more = written(_confirm(_drawn_pairs(crowded, turn, percent), full, percent), "drawn-links") if many else None
            linked = more.count() if many else 0
            if linked:
                labels = _merged(labels, more)
                member = written(_apart(_relabelled(member, labels)), "possible")
            if linked * WORTH <= many:
                break
        more = written(_all_links(member, vertices, full, percent), "more-links")
        if not more.isEmpty():
            labels = _merged(labels, more)
    first = marks.where("n > 0").groupBy("digest").agg(F.min("vertex").alias("_first"))
    found = marks.join(first, "digest", "left").join(labels.withColumnRenamed("vertex", "_first"), "_first", "left")
    found = found.withColumn("_c", F.coalesce("component", "_first", "vertex"))
    return found.select(
        F.expr(f"nullif(vertex, {LAST}L)").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.expr(f"nullif(_c, {LAST}L)").alias("component_id"), (F.col("vertex") == F.col("_c")).alias("kept"))
