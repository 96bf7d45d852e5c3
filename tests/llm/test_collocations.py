"""Phrases against a count of every phrase, in Python's whole numbers."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from fathomframe.llm import collocations

SCHEMA = "doc_id long, text string, lang string, w1 string, n string"


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang, lower = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    big = {(g, w): a for (g, w), a in f.items() if len(w) > 1 and a >= least}
    out = []
    for (g, w), a in big.items():
        if any(100 * b >= 80 * a and len(v) > len(w) and h == g and any(v[i : i + len(w)] == w for i in range(len(v)))
               for (h, v), b in big.items()):
            continue
        cuts = [(2_000_000 * a // (f[g, w[:k]] + f[g, w[k:]]), k, f[g, w[:k]], f[g, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        out.append((g, -score, -a, " ".join(w).encode(), left, right))
    lines, at = [], Counter()
    for g, s, a, w, left, right in sorted(out):
        at[g] += 1
        if at[g] <= top:
            lines.append((g, at[g], w.decode(), -a, left, right, n[g], -s))
    return lines


def run(frame, rows, **parameters):
    df = frame([(i, t, g, "x", "y") for i, t, g in rows], SCHEMA)
    out = collocations.collocations(df, **parameters)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, out.collect()))


def sample(seed, docs, vocabulary):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Éa", "éa", "", "NUL\0x", "a b"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(words[: rng.choice([3, vocabulary + 5])]) + rng.choice(ends) for _ in range(rng.randrange(60)))
        rows.append((i, rng.choice([text, text, text, None, "", " leading. THE old Man and the sea "]), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("seed, top, bits", [(1, 2000, 27), (2, 7, 20), (3, 2000, 3)])
def test_phrases(frame, monkeypatch, seed, top, bits):
    monkeypatch.setattr(collocations, "SLICE_CHARS", 500)
    rows = sample(seed, 300, 12)
    assert run(frame, rows, least=8, top=top, bits=bits) == sorted(brute(rows, 8, 4, top))


def test_words_of_slices(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_CHARS", 40_000)
    rng = random.Random(9)
    texts = ["".join(rng.choice("abCDé .,\n\t") for _ in range(rng.randrange(3000))) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y"] * 150), pa.array(texts)], ["lang", "text"])
    seen = {"x": [], "y": []}
    for lang, words in collocations._slices(batch):
        seen[lang] += [words.words[c].as_py() if c >= 0 else "." for c in words.codes.tolist()]
    for lang, own in (("x", texts[::2]), ("y", texts[1::2])):
        plain = [re.findall(r"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + ["."] for t in own]
        assert seen[lang] == [w if w not in ",\n" else "." for t in plain for w in t]


def test_shorter_longest_order(frame):
    rows = sample(4, 200, 8)
    for longest in (2, 3):
        assert run(frame, rows, least=6, longest=longest) == sorted(brute(rows, 6, longest, 2000))


def test_one_phrase_in_most_rows_and_a_long_text(frame):
    rows = [(i, "the hot phrase goes on", "en") for i in range(400)] + [(None, "a b " * 30_000, "en"), (5, None, None), (5, "", "xx")]
    assert run(frame, rows) == sorted(brute(rows, 30, 4, 2000))


def test_no_rows_and_no_frequent_phrases(frame):
    assert run(frame, []) == []
    assert run(frame, [(1, "a b c", "en")]) == []


def test_sizes_past_64_bits(spark, monkeypatch):
    big = 1 << 62
    counts = [("en", [], big), ("en", ["a"], big), ("en", ["b"], big - 1), ("en", ["a", "b"], big - 5), ("en", ["c"], big), ("en", ["a", "b", "c"], big // 2)]
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a, **b: spark.createDataFrame(counts + [("en", ["b", "c"], big // 2)], "lang string, words array<string>, f long"))
    got = {r.phrase: (r.a, r.score) for r in collocations.collocations(spark.range(0)).collect()}
    assert got == {"a b": (big - 5, 2_000_000 * (big - 5) // (2 * big - 1)), "a b c": (big // 2, 2_000_000 * (big // 2) // (2 * big - 5))}
