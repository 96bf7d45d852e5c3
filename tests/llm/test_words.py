"""Mixing, exact copies, quality rules and URL rules against brute force on small tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from fathomframe.llm import common, exact, mixing, quality, urls
from fathomframe.llm.common import written

DOC = "doc_id long, text string, source string, kept string"


def test_exact_duplicates_with_nulls_ties_and_repeats(spark, frame):
    rows = [(1, "a", "x", "k"), (2, "a", None, "k"), (2, "a", "x", "k"), (3, None, "x", "k"), (4, "", "x", "k"),
            (None, "a", "x", "k"), (5, "b" * 200_000, "x", "k"), (6, "b" * 200_000, "x", "k"), (7, "b" * 199_999 + "c", "x", "k")]
    got = exact.exact_duplicates(frame(rows, DOC)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r[1] or "", []).append(r[0])
    for r in got:
        ids = next(v for k, v in by.items() if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        assert r.keep_id == max(i for i in ids if i is not None) and r.group_size == len(ids)
    assert sorted(r.keep_id for r in got if r.kept) == [2, 4, 6, 7]


def test_fingerprints_compose():
    data = bytes(random.Random(1).randrange(256) for _ in range(200_001))
    for p, b in zip(exact.PRIMES, exact.BASES):
        whole = 0
        for x in data:
            whole = (whole * b + x + 1) % p
        parts = [(data[i : i + exact.CHUNK], max(0, len(data) - i - exact.CHUNK)) for i in range(0, len(data), exact.CHUNK)]
        assert sum(exact.chunk_hash(c, n, p, b) for c, n in parts) % p == whole


def test_texts_under_one_fingerprint_are_told_apart(spark, frame, monkeypatch):
    monkeypatch.setattr(exact, "_chunk_hashes", _all_alike)
    monkeypatch.setattr(exact, "_whole_hash", _all_alike_whole)
    rows = [(1, "aa", "x", "k"), (2, "bb", "x", "k"), (3, "aa", "x", "k")]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(frame(rows, DOC)).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True)}


def _all_alike(chunk, after):
    import pandas as pd
    return pd.DataFrame({"a": [1] * len(chunk), "b": [1] * len(chunk)})


def _all_alike_whole(body):
    import pandas as pd
    return pd.DataFrame({"a": [1] * len(body), "b": [1] * len(body)})


def test_texts_are_hashed_once_in_a_task(frame):
    docs = frame([(1, "same"), (2, "same"), (3, "other")], "doc_id long, text string")
    marks = exact.fingerprints(docs)
    shared = marks.groupBy(*exact.FP).count().where("count > 1").select(*exact.FP)
    found = exact.unequal(docs, written(shared, "shared"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert found.collect() == []


def test_written_tables_leave_no_shuffle_files(frame, monkeypatch):
    docs = frame([(i, "x") for i in range(9)], "doc_id long, text string")
    held = docs.sparkSession.conf.get(common.CLEANUP, "false")
    seen = []
    kept = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (
        seen.append(docs.sparkSession.conf.get(common.CLEANUP)), kept(self, *a, **k))[1])
    assert written(docs.groupBy("text").count(), "counts").first()["count"] == 9
    assert seen == ["true"] and docs.sparkSession.conf.get(common.CLEANUP, "false") == held


def test_exact_empty_table(frame):
    assert exact.exact_duplicates(frame([], DOC)).collect() == []


def brute_targets(sizes):
    """Water filling by repeated sharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, open_, left = {}, list(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_targets_and_sums(frame, seed):
    r = random.Random(seed)
    rows = []
    for i in range(900):
        source = r.choice(["hot"] * 6 + ["a", "b", "é", "Z", None, "tiny"] if i > 5 else ["tiny"])
        rows.append((i, " ".join("w" for _ in range(r.randrange(0, 12))) if i % 50 else None, source, "k"))
    rows += [(7, "same same", "hot", "k")] * 3 + [(None, "no id", "hot", "k"), (1000, "", "none", "k")]
    got = mixing.mix(frame(rows, DOC)).collect()
    assert len(got) == len(rows)
    again = mixing.mix(frame(rows, DOC)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    by_size = {}
    for s, n in sizes.items():
        by_size.setdefault(n, []).append(s)
    for n, sources in by_size.items():
        own = [x for x in got if x.source_size == n]
        assert sorted({round(x.target, 6) for x in own}) == sorted({round(want[s], 6) for s in sources})
        assert abs(sum(x.taken for x in own) - sum(want[s] for s in sources)) <= 12 * len(sources)
    assert all(0 <= x.taken <= 3 * x.size for x in got)


def test_equal_rows_meet_the_target(frame):
    rows = [(None, "one text of five words", "a", "k")] * 2000 + [(i, "one two three", "b", "k") for i in range(1000)]
    rows += [(5, "again and again", "c", "k")] * 700 + [(i, "a b c", "c", "k") for i in range(100)]
    df = frame(rows, DOC).repartition(7)
    want = brute_targets({"a": 10_000, "b": 3000, "c": 2400})
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
    taken = {"a": 0, "b": 0, "c": 0}
    for r in got:
        taken["a" if r.source_size == 10_000 else "b" if r.source_size == 3000 else "c"] += r.taken
    assert all(abs(taken[s] - want[s]) <= 5 for s in want)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert words == taken
    assert sorted(map(tuple, mixing.mix(df.repartition(3)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_mixed_rows_repeat(frame):
    rows = [(i, "one two three", "a" if i < 30 else "b", "k") for i in range(90)]
    df = frame(rows, DOC)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixed(df.limit(0)).collect() == []


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed)


def test_quality_measures(frame):
    r = random.Random(4)
    texts = [None, "", " \n", "a b c d e a b c d e", "漢字 x " * 20, "word " * 5000, " ".join(f"w{i}" for i in range(6000)) * 2]
    texts += ["".join(r.choice(["a ", "b ", "c\n", "d. ", "#", "\t", "\x0b", "é "]) for _ in range(r.randrange(0, 90))) for _ in range(60)]
    got = quality.clean_lines(frame([(i, t, "s", "k") for i, t in enumerate(texts)], DOC)).collect()
    assert len(got) == len(texts)
    for x in got:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == brute_quality(texts[x.doc_id])
        assert not (x.kept and x.base_failed)


def test_failed_lines_go_and_poor_documents_are_rejected():
    prose = "This is a line of prose that ends as a sentence should."
    assert quality.line_fails("Home | News | Contact") == "navigation"
    assert quality.line_fails("All rights reserved.") == "boilerplate"
    assert quality.line_fails("Read") == "punctuation"
    assert quality.line_fails(prose) is None
    other = "Nothing here was said before, and so it stays too."
    kept = quality.measure(prose + "\nHome | News\n" + other)
    assert kept[8] and kept[9] == prose + "\n" + other
    assert not quality.measure("\n".join(["Home | News | Contact | More"] + [f"a{i} | b{i} | c{i}" for i in range(9)] + ["One two three four five."]))[8]


def test_url_rules(frame):
    rows = [(1, "http://WWW.Example.com/en/x?q#f"), (2, "https://a.example.com/en/"), (3, "http://example.com/fr/"), (4, None),
            (5, "no scheme"), (6, "http://deep.a.net/es/1"), (7, "http://net/fr/"), (8, "http://notnet/fr/"), (9, "http://x.com"),
            (10, "http://example.com:80/en/"), (11, ""), (12, "ftp://x.y.net/es/#://b"), (12, "ftp://x.y.net/es/#://b")]
    df = frame([(i, u, "h", "p") for i, u in rows], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df, urls.rule_table(df.sparkSession, urls.RULES)).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("example.com", "/fr/", "com/", "allow")
    assert got[4] == got[5] == got[11] == ("", "", None, "allow")
    assert got[6][2:] == ("net/es/", "block") and got[7][2:] == ("net/fr/", "block")
    assert got[8][2:] == (None, "allow") and got[9] == ("x.com", "", None, "allow")
    assert got[10] == ("example.com:80", "/en/", None, "allow") and got[12][2:] == ("net/es/", "block")
    some = urls.filter_urls(df, urls.rule_table(df.sparkSession, urls.RULES).limit(0), default="block")
    assert {r.verdict for r in some.collect()} == {"block"} and some.count() == len(rows)
    assert urls.filter_urls(df.limit(0), urls.rule_table(df.sparkSession, urls.RULES)).count() == 0
