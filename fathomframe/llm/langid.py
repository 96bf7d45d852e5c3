"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained with follow-the-regularised-leader under an elastic net, then calibrated with one temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

FEATURES = 1 << 14
ORDERS = 3
#: Bound of the sample the weights are fitted on: documents for each language, in expectation.
PER_LANGUAGE = 800
EPOCHS, ALPHA, BETA, L1, L2 = 4, 1.0, 1.0, 0.002, 0.0005
UNKNOWN = "und"
_PIECE = 1 << 17
_LETTERS = np.empty(0, bool)


def _letters() -> np.ndarray:
    global _LETTERS
    if not len(_LETTERS):
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed 1-, 2- and 3-grams of lower-cased letters (all else is a gap); None without a letter."""
    if not text:
        return None
    counts, any_letter, tail = np.zeros(FEATURES, np.int64), False, np.zeros(0, np.uint64)
    letters = _letters()
    for start in range(0, len(text), _PIECE):
        points = np.frombuffer(text[start : start + _PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        known = letters[points]
        any_letter |= bool(known.any())
        own = np.where(known, points, 32).astype(np.uint64)
        own = np.concatenate([tail if start else np.array([32], np.uint64), own])
        fresh = len(tail) if start else 0  # grams that end in this piece are counted with it
        grams = np.zeros(len(own), np.uint64)
        for order in range(1, ORDERS + 1):
            n = len(own) - order + 1
            if n <= 0:
                break
            grams = (grams[:n] * np.uint64(0x100000001B3)) + own[order - 1 :]
            mixed = ((grams + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14)
            skip = max(0, fresh - order + 1)
            counts += np.bincount(mixed[skip:].astype(np.int64), minlength=FEATURES)
        tail = own[-(ORDERS - 1) :]
    return counts if any_letter else None


def vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features present and their TF-IDF weights, of length one."""
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt((values * values).sum())
    return at, values / norm if norm > 0 else values


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], labels: int) -> np.ndarray:
    """Weights, FEATURES + 1 by labels; the last row is the intercept, which no penalty holds."""
    z, n = np.zeros((FEATURES + 1, labels)), np.zeros((FEATURES + 1, labels))
    l1 = np.full(FEATURES + 1, L1)
    l1[-1] = 0

    def weights(at):
        zs, most = z[at], l1[at][:, None]
        w = -(zs - np.sign(zs) * most) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zs) <= most, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, values, label = rows[i]
            at, values = np.append(at, FEATURES), np.append(values, 1.0)
            w = weights(at)
            p = _softmax(values @ w)
            p[label] -= 1
            g = values[:, None] * p
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    return weights(np.arange(FEATURES + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least loss on rows that the weights have not seen (golden section on its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = _softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    """What the driver keeps: at most FEATURES by labels numbers, whatever the corpus."""

    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES + 1, 0)))
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text) if self.labels else None
        if counts is None:
            return UNKNOWN, 0.0
        at, values = vector(counts, self.idf)
        p = _softmax((values @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the labelled rows that are not held out.

    Document frequencies are counted over all of them, each task sending one row per feature. Weights and
    temperature are fitted in one task, which reads only the vectors of a sample of about ``per_language`` documents for each language,
    chosen by a hash of the id; one in five of them only sets the temperature.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, docs = np.zeros(FEATURES, np.int64), 0
        for batch in text_batches(batches, "text"):
            for x in batch["text"]:
                counts = gram_counts(x)
                if counts is not None:
                    total += counts > 0
                    docs += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(total[at], docs)})

    seen = rows.select("text").mapInPandas(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df, total = np.zeros(FEATURES), 0
    for r in seen.collect():
        if r.feature < 0:
            total = r.n
        else:
            df[r.feature] = r.n
    idf = np.log((1 + total) / (1 + df)) + 1
    of = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = sorted(of)
    if not labels:
        return Model([], idf)
    share = F.create_map(*[F.lit(x) for k in labels for x in (k, min(1.0, per_language / of[k]))])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("langid"), "doc_id"), 11) / float(1 << 53)
    sample = rows.where(draw < share[F.col("lang")]).select(
        "doc_id", "text", "lang", (F.pmod(F.xxhash64(F.lit("temperature"), "doc_id"), F.lit(5)) == 0).alias("calibrate"))

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in text_batches(batches, "text"):
            out = [(i, k, c, *vector(g, idf)) for i, k, c, x in zip(batch["doc_id"], batch["lang"], batch["calibrate"], batch["text"])
                   if (g := gram_counts(x)) is not None]
            yield pd.DataFrame(out, columns=["doc_id", "lang", "calibrate", "at", "value"])

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_rows = pd.concat([pd.DataFrame(columns=["doc_id", "lang", "calibrate", "at", "value"]), *batches])
        all_rows = all_rows.sort_values(["doc_id", "lang"], kind="stable")
        number = {k: i for i, k in enumerate(labels)}
        data = [(a, v, number[k], c) for a, v, k, c in zip(all_rows["at"], all_rows["value"], all_rows["lang"], all_rows["calibrate"])]
        fit = [x[:3] for x in data if not x[3]] or [x[:3] for x in data]
        weights = fit_ftrl(fit, len(labels))
        kept = [x for x in data if x[3]]
        logits = np.array([v @ weights[a] + weights[-1] for a, v, _, _ in kept]).reshape(len(kept), len(labels))
        t = fit_temperature(logits, np.array([x[2] for x in kept], int))
        at = np.flatnonzero(np.abs(weights).any(axis=1))
        yield pd.DataFrame({"feature": np.append(at, -1), "weights": [*weights[at].tolist(), [t]]})

    vectorised = sample.mapInPandas(vectors, "doc_id string, lang string, calibrate boolean, at array<int>, value array<double>")
    weights, temperature = np.zeros((FEATURES + 1, len(labels))), 1.0
    for r in vectorised.repartition(1).mapInPandas(fitted, "feature long, weights array<double>").collect():
        if r.feature < 0:
            temperature = r.weights[0]
        else:
            weights[r.feature] = r.weights
    return Model(labels, idf, weights, temperature)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score appended, each whole text judged on its own.

    ``und`` with score 0 where the text is null or has no letter, or where the model has learned no language.
    Equal scores go to the first label in code point order. Other columns pass through unchanged.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([model.predict(x) for x in batch], columns=["lang", "score"])

    guessed = F.pandas_udf(run, "lang string, score double")(F.col(text))
    return docs.withColumn("_guess", guessed).withColumns(
        {"lang_pred": F.col("_guess.lang"), "score": F.col("_guess.score")}).drop("_guess")
