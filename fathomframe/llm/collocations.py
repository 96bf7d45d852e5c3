"""Phrases by top-order marginalisation: only padded longest windows are counted, ROLLUP gives all shorter phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

LONGEST, LEAST, TOP, UNDETERMINED = 4, 30, 2000, "und"
SCORE_SCALE, COVERED, COVERING = 2_000_000, 100, 80
#: Bits of a filter of frequent phrases: 16 MB, whatever the corpus. A full filter only keeps windows long.
FILTER_BITS = 27
#: Characters of text that a task handles at once.
SLICE_CHARS = 2_000_000
_BREAK = "."  # stands between pieces; it splits them, so no word contains it
_SPLITS = r"[.,;:!?\x0A-\x0D]"
_SHARES = 64


class _Words:
    """The words of some texts of one language: codes in order, a negative one between pieces, and what they stand for."""

    def __init__(self, texts: pa.Array) -> None:
        lower = pc.ascii_lower(texts.cast(pa.large_string()))
        marked = pc.replace_substring_regex(lower, _SPLITS, f" {_BREAK} ")
        ended = pc.binary_join_element_wise(marked, pa.scalar(_BREAK, pa.large_string()), pa.scalar(" ", pa.large_string()))
        flat = pc.ascii_split_whitespace(ended).flatten()
        coded = flat.filter(pc.greater(pc.binary_length(flat), 0)).dictionary_encode()
        self.words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        at = pc.index(self.words, pa.scalar(_BREAK, pa.large_string())).as_py()
        self.codes = np.where(codes == at, -1, codes)

    def hashes(self, lang: str, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order up to longest: at which words so many stand in one piece, and the hash of language and words."""
        salt = np.uint64(xxhash.xxh64_intdigest(lang))
        own = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words.to_pylist()), np.uint64, len(self.words))
        follow, out = self.codes, []
        within, h = follow >= 0, own[follow]
        for k in range(1, longest + 1):
            out.append((within, _mixed(h + salt)))
            follow = _shifted(follow, -1)
            within, h = within & (follow >= 0), h * np.uint64(0x9E3779B97F4A7C15) + own[follow]
        return out


class _Filter:
    """Bitmaps of hashes that are met often: of words and pairs, and of longer phrases."""

    def __init__(self, low: np.ndarray, high: np.ndarray | None, bits: int) -> None:
        self.low, self.high, self.bits = low, high, bits

    def has(self, hashes: np.ndarray, order: int) -> np.ndarray:
        held, spot = self.low if order <= 2 else self.high, hashes.view(np.uint64) >> np.uint64(64 - self.bits)
        return (held[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def runs(self, hashes: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """For each order from 2: at which words a phrase of it may be frequent, as it and all phrases in it are held.

        The longest order, and without a bitmap of longer phrases all but pairs, need frequent phrases within only.
        """
        out = [hashes[0][0]]
        for order, (within, h) in enumerate(hashes[1:], 2):
            likely = within & out[-1] & _shifted(out[-1], False)
            if order <= 2 or self.high is not None and order < len(hashes):
                at = np.flatnonzero(likely)
                likely[at] = self.has(h[at], order)
            out.append(likely)
        return out[1:]


def _shifted(x: np.ndarray, last) -> np.ndarray:
    return np.append(x[1:], np.array([last], x.dtype))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))).astype(np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[str, _Words]]:
    """Language and words, of some million characters at a time."""
    for lang in batch.column("lang").unique():
        texts = batch.column("text").filter(pc.equal(batch.column("lang"), lang))
        share = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // SLICE_CHARS
        begin = np.append(np.flatnonzero(np.diff(share, prepend=-1)), len(texts))
        for a, b in zip(begin, begin[1:]):
            yield lang.as_py(), _Words(texts.take(pa.array(np.arange(a, b))))  # a copy: ascii_lower misreads slices


def _bitmap(hashes: DataFrame, least: int, bits: int) -> np.ndarray:
    """A bit for each hash met least times or more; 2**bits bits reach the driver.  hashes: h, n."""
    counted = hashes.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    at = F.shiftrightunsigned("h", 64 - bits) + 1  # bits of a bitmap are counted from 1
    maps = counted.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for r in maps.collect():
        block = np.frombuffer(r.bits, np.uint8)
        first = (r.bucket - 1) * len(block)
        out[first : first + len(block)] = block[: len(out) - first]
    return out


def frequent_phrases(docs: DataFrame, least: int, longest: int = LONGEST, bits: int = FILTER_BITS) -> _Filter:
    """A filter that holds each phrase met least times or more, and few others.

    docs: lang, text. Words and pairs are counted by hash, in tasks first, then the phrases of frequent pairs that
    are longer but for the longest: these are few once all shorter ones in them are frequent.
    """
    def counted(of) -> DataFrame:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, words in _slices(batch):
                    h, n = np.unique(of(words.hashes(lang, longest)), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])
                pa.default_memory_pool().release_unused()

        return docs.mapInArrow(count, "h long, n long")

    low = _bitmap(counted(lambda hashes: np.concatenate([h[within] for within, h in hashes[:2]])), least, bits)
    if longest < 4:
        return _Filter(low, None, bits)
    shared = docs.sparkSession.sparkContext.broadcast(low)

    def longer(hashes):
        likely = _Filter(shared.value, None, bits).runs(hashes)
        return np.concatenate([h[found] for (_, h), found in zip(hashes[2:-1], likely[1:-1])])

    return _Filter(low, _bitmap(counted(longer), least, bits), bits)


def windows(docs: DataFrame, frequent: _Filter, longest: int = LONGEST) -> DataFrame:
    """lang, w1 .. w4, n: at each word the window of it and its followers, counted.

    A window is padded with empty words where its piece ends or a longer phrase is not in the filter, and at its
    first word if that is not: what it loses is in no frequent phrase. Windows are counted in slices, then in tasks,
    and shuffled once as one string, of this longest order only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words in _slices(batch):
                codes, none = words.codes, len(words.words)
                hashes = words.hashes(lang, longest)
                runs = shared.value.runs(hashes)
                follow, wide = codes, np.flatnonzero(runs[0])
                columns = [codes[wide]]
                for found in runs:  # lead columns: the k-th word while the phrase up to it may be frequent
                    follow = _shifted(follow, -1)
                    columns.append(np.where(found, follow, none)[wide])
                first, n = _distinct(columns)
                single = np.flatnonzero(hashes[0][0] & ~runs[0])
                often = shared.value.has(hashes[0][1][single], 1)
                alone = np.bincount(np.where(often, codes[single], none), minlength=none + 1)
                met = np.flatnonzero(alone)
                n = np.concatenate([n, alone[met]])
                columns = [np.concatenate([c[first], met if i == 0 else np.full(len(met), none)]) for i, c in enumerate(columns)]
                text = pa.concat_arrays([words.words, pa.array([""], pa.large_string())])
                cells = [text.take(pa.array(c, mask=None if i == 0 else c == none)) for i, c in enumerate(columns)]
                window = pc.binary_join_element_wise(*cells, pa.scalar(" ", pa.large_string()), null_handling="skip").cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), window, pa.array(n)], ["lang", "window", "n"])
            pa.default_memory_pool().release_unused()

    counted = docs.mapInArrow(run, "lang string, window string, n long").groupBy("lang", "window").agg(F.sum("n").alias("n"))
    words = F.split("window", " ")
    return counted.select("lang", *[F.coalesce(F.get(words, F.lit(i)), F.lit("")).alias(f"w{i + 1}") for i in range(longest)], "n")


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of the columns comes first, and how often it comes."""
    key = columns[0]
    for c in columns[1:]:  # numbers of the rows so far, so that a pair of numbers fits 64 bits
        _, key = np.unique(key * (int(c.max(initial=0)) + 1) + c, return_inverse=True)
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return first, n


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                  bits: int = FILTER_BITS) -> DataFrame:
    """lang, words, f: phrases of one to longest words met least times or more, and per language all words (empty phrase)."""
    plain = docs.select(F.coalesce(F.col(lang), F.lit(UNDETERMINED)).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    wide = windows(plain, frequent_phrases(plain, least, longest, bits), longest)
    names = [f"w{i + 1}" for i in range(longest)]
    summed = wide.rollup("lang", *names).agg(F.sum("n").alias("f"))
    last = F.array_compact(F.array(*names))
    whole = F.size(last) == 0
    return summed.where(F.col("lang").isNotNull()).withColumn("words", last).where(
        whole | ((F.col("f") >= least) & ~F.array_contains("words", ""))).select("lang", "words", "f")


def _joined(words) -> F.Column:
    return F.array_join(words, " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language by the score of their weakest cut.

    Texts are lower-cased (A-Z), split into pieces at punctuation and line ends, and into words at spaces and tabs.
    Windows of the longest order are counted once per slice of text and folded by ROLLUP, on the map side before
    the shuffle, so that frequent words and phrases are no load for one task. A phrase can be frequent only if
    all phrases in it are; a filter of frequent hashes, of fixed size, cuts windows before the count. Joins
    run over frequent phrases only. A null text has no words, a null language is ``und``; repeated rows count as
    often as they come; ties of score and count go by phrase in byte order; without words the result is empty.
    """
    small_batches(docs.sparkSession)
    counts = written(phrase_counts(docs, text, lang, least, longest, bits), "phrases")
    grams = counts.where(F.size("words") > 0).select("lang", _joined(F.col("words")).alias("phrase"), "f")
    totals = counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    candidates = counts.where(F.size("words") > 1).select("lang", "words", _joined(F.col("words")).alias("phrase"), F.col("f").alias("a"))

    k = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "a", "words", k)
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.slice("words", F.lit(1), F.col("k"))).alias("_first"),
                       _joined(F.slice("words", F.col("k") + 1, F.size("words"))).alias("_rest"))
    left = grams.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCORE_SCALE}) DIV (CAST(l AS DECIMAL(20, 0)) + r)")
    scored = cuts.join(left, ["lang", "_first"]).join(right, ["lang", "_rest"]).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_cut"))

    spans = [F.slice("words", i + 1, size) for size in range(2, longest) for i in range(longest - size + 1)]
    within = counts.where(F.size("words") > 2).select("lang", "words", F.col("f").alias("_longer"), F.explode(F.array_distinct(
        F.filter(F.array(*spans), lambda s: (F.size(s) > 1) & (F.size(s) < F.size("words"))))).alias("_span"))
    # a slice past the end is shorter than asked: such a span is one of the smaller size as well
    covered = within.groupBy("lang", _joined(F.col("_span")).alias("phrase")).agg(F.max("_longer").alias("_longer"))
    keeps = F.expr(f"_longer IS NULL OR CAST(_longer AS DECIMAL(20, 0)) * {COVERED} < CAST(a AS DECIMAL(20, 0)) * {COVERING}")
    kept = scored.join(covered, ["lang", "phrase"], "left").where(keeps).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_SHARES))).orderBy(*order)
    few = kept.withColumn("_place", F.row_number().over(share)).where(F.col("_place") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
