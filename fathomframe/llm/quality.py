"""Line-first cleaning: rules remove lines, then documents that lose too much are rejected."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import WORD, text_batches

WINDOW = 5
MOST_LOSS = 0.5
FEWEST_WORDS = 10
MOST_REPEATED = 20
SYMBOLS = "#*$%&|<>"
#: A line whose last mark is one of these, closing marks aside, reads as prose.
ENDINGS = tuple(".!?:;…。！？")
CLOSING = "\"'»”’)]} \t\r"
BOILERPLATE = (
    "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service", "javascript",
    "lorem ipsum", "subscribe to our", "sign up for", "click here", "read more", "powered by", "skip to content",
    "released under the", "licensed under the", "permission is hereby granted",
)
NAVIGATION = re.compile(r"[|»›→·•]|\s>\s|\s/\s")
_WORDS = re.compile(WORD)


def line_fails(line: str) -> str | None:
    """The rule that a line fails, or None; a line without words fails none."""
    words = _WORDS.findall(line)
    if not words:
        return None
    low = line.lower()
    if len(words) <= 30 and any(x in low for x in BOILERPLATE):
        return "boilerplate"
    if len(words) <= 20 and len(NAVIGATION.findall(line)) * 4 >= len(words):
        return "navigation"
    if not line.rstrip(CLOSING).endswith(ENDINGS) and len(words) < 4:
        return "punctuation"
    return None


def repeated_words(words: list[str]) -> int:
    """How many words lie in a 5-word window that the text holds twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    bits = max(1, len(numbers).bit_length())
    if bits * WINDOW <= 64:
        key = ids[:n].copy()
        for i in range(1, WINDOW):
            key = (key << np.uint64(bits)) | ids[i : n + i]
    else:  # pairs, then pairs of pairs, numbered anew so that a key never outgrows 64 bits
        wide = np.uint64(32)
        two = np.unique((ids[:-1] << wide) | ids[1:], return_inverse=True)[1].astype(np.uint64)
        four = np.unique((two[:-2] << wide) | two[2:], return_inverse=True)[1].astype(np.uint64)
        key = (four[:n] << wide) | ids[WINDOW - 1 :]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    ends = np.zeros(len(words) + 1, np.int64)
    ends[:n] += twice
    ends[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(ends)[:-1] > 0).sum())


def measure(text: str | None, max_loss: float = MOST_LOSS) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lines_removed, words_removed, kept, clean text."""
    text = text or ""
    lines = text.split("\n")
    seen: set[str] = set()
    words: list[str] = []
    kept_lines: list[str] = []
    dup = lines_removed = words_removed = 0
    for line in lines:
        own = _WORDS.findall(line)
        words += own
        again = bool(own) and line in seen
        dup += again
        if own:
            seen.add(line)
        if line_fails(line):
            lines_removed += 1
            words_removed += len(own)
        else:
            kept_lines.append(line)
    n, chars = len(words), sum(map(len, words))
    repeated = repeated_words(words)
    failed = n < FEWEST_WORDS or 100 * repeated > MOST_REPEATED * n
    kept = not failed and words_removed <= max_loss * n
    symbols = sum(text.count(x) for x in SYMBOLS)
    return n, chars, symbols, dup, repeated, failed, lines_removed, words_removed, kept, "\n".join(kept_lines)


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lines_removed", "words_removed", "kept", "clean_text"]
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, lines_removed bigint, words_removed bigint, kept boolean, clean_text string")


def clean_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_loss: float = MOST_LOSS) -> DataFrame:
    """One row per row of docs: its measures, verdict and the text without the failed lines.

    A line fails as boilerplate, navigation or a fragment without closing punctuation. A document is rejected
    when it has under 10 words, when over a fifth of its words lie in repeated 5-word windows, or when its
    failed lines hold more than ``max_loss`` of its words. A null text has no words; ids may be null or repeat.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in text_batches(batches, "text"):
            rows = [measure(x, max_loss) for x in batch["text"]]
            out = pd.DataFrame(rows, columns=FIELDS)
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text").mapInPandas(run, SCHEMA)
