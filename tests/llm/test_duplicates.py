"""Near duplicates, repeated bytes and passages against brute force on small tables."""

import random

import numpy as np
import pytest

from fathomframe.llm import graph, near, passages, substrings, suffixes

DOC = "doc_id long, text string, vertex string, component string"


def shingle_set(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def brute_components(rows, percent=85):
    ids = sorted({d if d is not None else 1 << 62 for d, _ in rows})
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(d if d is not None else 1 << 62, shingle_set(t)) for d, t in rows]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[r.choice(words) for _ in range(r.randrange(20, 160))] for _ in range(6)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, "one two"), (4, "ONE two"), (5, "one two three"), (6, "é É")]
    for i in range(7, 130):
        text = list(r.choice(base)) if r.random() < 0.8 else [r.choice(words) for _ in range(r.randrange(1, 90))]
        for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, " ".join(text)))
    return rows + [(8, rows[8][1]), (None, " ".join(base[0])), (500, rows[9][1].upper())]


@pytest.mark.parametrize("block", [4, 512])
def test_near_components(spark, frame, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rows = corpus(block)
    got = near.near_duplicates(frame([(*x, "v", "c") for x in rows], DOC)).collect()
    assert len(got) == len(rows)
    want = brute_components(rows)
    for x in got:
        c = want[x.doc_id if x.doc_id is not None else 1 << 62]
        assert x.component_id == (None if c == 1 << 62 else c)
        assert x.kept == (x.doc_id == x.component_id)
    assert sorted(x.n_shingles for x in got) == sorted(len(shingle_set(t)) for _, t in rows)


def test_index_keys_meet_within_the_distance():
    r = np.random.default_rng(3)
    for errors in range(near.KEYED_DISTANCE + 1):
        a = r.integers(0, 1 << 16, near.ELEMENTS).astype(np.uint16)
        b = a.copy()
        at = r.choice(near.KEYED, errors, replace=False)
        b[at] ^= np.uint16(1)
        shared = np.flatnonzero(near.index_keys(a) == near.index_keys(b))
        assert len(shared) and near.first_key(a[None], b[None])[0] == shared[0]


def test_near_group_apart_after_its_leaders_is_joined_by_few_links(frame, monkeypatch):
    r = random.Random(5)
    base = [f"w{i}" for i in range(400)]

    def changed(n):
        words = list(base)
        for at in r.sample(range(400), n):
            words[at] = f"x{r.random()}"
        return " ".join(words)

    # the smallest document of nearly all keys is like no other one
    rows = [(i, changed(14)) for i in range(40)] + [(100 + i, changed(2)) for i in range(90)]
    seen, real = [], near.components
    monkeypatch.setattr(near, "components", lambda edges: (seen.append(edges.count()), real(edges))[1])
    got = near.near_duplicates(frame([(*x, "v", "c") for x in rows], DOC)).collect()
    assert {x.doc_id: x.component_id for x in got} == brute_components(rows)
    assert max(seen) < 4 * len(rows)


@pytest.mark.parametrize("whole", [2000, 1_000_000])
def test_near_group_of_many_unlinked_pairs_makes_no_row_of_each(frame, monkeypatch, whole):
    monkeypatch.setattr(near, "WHOLE", whole, raising=False)
    monkeypatch.setattr(near, "TURNS", 0)
    r = random.Random(7)

    def changed():
        at = {16 * i + 4 for i in range(24) if r.random() < 0.5}
        return " ".join(f"x{i}" if i in at else f"w{i}" for i in range(400))

    rows = [(i, changed()) for i in range(240)]
    seen, real = [], near._confirm
    monkeypatch.setattr(near, "_confirm", lambda pairs, *more: (seen.append(pairs.count()), real(pairs, *more))[1])
    got = near.near_duplicates(frame([(*x, "v", "c") for x in rows], DOC)).collect()
    assert {x.doc_id: x.component_id for x in got} == brute_components(rows)
    assert sum(seen) < 20 * len(rows)


def test_near_empty_table(frame):
    assert near.near_duplicates(frame([], DOC)).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (205, 204), (204, 203)]
    got = {r.vertex: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 160))
    assert got[204] == got[205] == 203
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("most", [1, 3, 2048])
def test_suffix_array(monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_BUCKETS", most)
    r = np.random.default_rng(most)
    for k in range(200):
        n, s = int(r.integers(1, 70)), int(r.integers(1, 5))
        t = r.integers(0, s, n)
        if k % 3 == 0 and n > 4:
            t = np.tile(t[:3], 25)[:n]
        got = suffixes.suffix_array(t, s)
        assert got.tolist() == sorted(range(n), key=lambda i: t[i:].tolist())
        ok = got[got <= n - 9]
        shared = suffixes.common_prefixes(t.astype(np.uint8), ok, 9)
        for i in range(1, len(ok)):
            a, b = t[ok[i] : ok[i] + 9], t[ok[i - 1] : ok[i - 1] + 9]
            assert shared[i] == (np.flatnonzero(a != b)[0] if (a != b).any() else 9)


def byte_corpus():
    r = random.Random(3)
    words = ["".join(r.choice("abcdé") for _ in range(r.randrange(1, 8))) for _ in range(40)]
    parts = [" ".join(r.choice(words) for _ in range(30)) for _ in range(5)] + ["x" * 200, "ab" * 90, " " * 120]
    texts = [None, "", "short", parts[0], parts[0]]
    for _ in range(45):
        texts.append("".join(r.choice([
            r.choice(parts), r.choice(parts)[: r.randrange(20, 120)],
            " ".join(r.choice(words) for _ in range(r.randrange(1, 25)))]) for _ in range(r.randrange(1, 4))))
    return [*enumerate(texts), (None, parts[0] + "tail"), (7, texts[7]), (9, parts[1] + " other")]


def brute_bytes(rows, length=50):
    def key(d):
        return d if d is not None else 1 << 62

    low = {}
    for d, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            low[b[k : k + length]] = min(low.get(b[k : k + length], 1 << 63), key(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if low[b[k : k + length]] < key(d):
                gone[k : k + length] = [True] * length
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, y in zip(b, gone) if not y)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"limit": 0}, {"per_part": 2}])
def test_repeated_bytes(frame, limits):
    rows = byte_corpus()
    got = substrings.remove_repeats(frame([(*x, "v", "c") for x in rows], DOC), **limits).collect()
    assert sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in got), key=str) == brute_bytes(rows)


def test_repeated_bytes_across_pieces(frame):
    """Texts longer than the 64 KiB that are hashed at once, with repeats over the seams."""
    r = random.Random(8)
    first = "".join(r.choice("abcdé ") for _ in range(150_000))
    second = "".join(r.choice("xyz ") for _ in range(65_000)) + first[60_000:66_100] + "".join(r.choice("xyz ") for _ in range(300)) + first[:70_000]
    rows = [(1, first), (2, second), (3, first[65_400:65_600]), (4, second[65_000:65_060] * 3)]
    got = substrings.remove_repeats(frame([(*x, "v", "c") for x in rows], DOC)).collect()
    assert sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in got), key=str) == brute_bytes(rows)


def test_repeated_bytes_empty_table(frame):
    assert substrings.remove_repeats(frame([], DOC)).collect() == []


def test_compact_windows_cover_every_run_once():
    r = np.random.default_rng(5)
    for n in (46, 60, 300):
        tokens = r.integers(0, n // 2, n).astype(np.uint64)
        least = 12
        value, left, centre, right = passages.compact_windows(tokens, passages._SEEDS[0], least)
        at, h, key = passages.minima(tokens, passages._SEEDS[0], 1)
        assert at.tolist() == list(range(n))
        for s in range(n):
            for e in range(s + least - 1, n):
                own = [i for i in range(len(centre)) if left[i] <= s <= centre[i] <= e <= right[i]]
                assert len(own) == 1 and key[s : e + 1].min() == key[centre[own[0]]]


@pytest.mark.parametrize("limit", [0, passages.SHARED])
def test_shared_passages_are_found_and_clean_documents_left(frame, limit):
    r = random.Random(9)
    words = [f"w{i}" for i in range(3000)]

    def prose(n):
        return [r.choice(words) for _ in range(n)]

    shared, near_copy = prose(70), prose(120)
    changed = list(near_copy)
    for i in (20, 60, 100):
        changed[i] = "other"
    rows = [(0, None), (1, ""), (2, "few words"), (3, " ".join(prose(40) + shared + prose(50))), (4, " ".join(prose(300))),
            (5, " ".join(shared).upper()), (6, " ".join(near_copy)), (7, " ".join(prose(30) + changed)), (8, " ".join(prose(20) + shared)),
            (9, " ".join(["same"] * 400)), (10, " ".join(prose(20) + shared[:40])), (None, " ".join(near_copy)), (6, " ".join(near_copy))]
    got = passages.near_passages(frame([(*x, "v", "c") for x in rows], DOC), limit=limit).collect()
    pairs = {(x.doc_id, x.source_id) for x in got}
    assert pairs == {(5, 3), (8, 3), (7, 6), (None, 6)}
    for x in got:
        if (x.doc_id, x.source_id) == (5, 3):
            assert (x.start_word, x.n_words, x.source_start, x.source_words, x.similarity) == (0, 70, 40, 70, 1.0)
        assert x.n_words >= 50 and x.similarity >= 0.8
    assert passages.near_passages(frame([], DOC)).collect() == []


def test_passages_that_no_smallest_document_has(frame):
    """Smaller documents with variants lead the keys; the later copies have to meet each other."""
    r = random.Random(4)
    words = [f"w{i}" for i in range(5000)]

    def prose(n):
        return [r.choice(words) for _ in range(n)]

    rows, copies = [], []
    for k in range(12):
        passage = prose(60)
        for j in range(6):  # two changed words in whatever 50 one takes: too far from the passage and from one another
            variant = list(passage)
            for i in (15 + 2 * j, 44 - 2 * j):
                variant[i] = f"changed{k}_{j}_{i}"
            rows.append((100 * k + j, " ".join(prose(20) + variant + prose(20))))
        for j in (50, 51, 52):
            rows.append((100 * k + j, " ".join(prose(30) + passage + prose(10))))
        copies += [(100 * k + j, range(30, 90)) for j in (51, 52)]
    got = passages.near_passages(frame([(*x, "v", "c") for x in rows], DOC)).collect()
    text = dict(rows)
    for doc, span in copies:
        own = [x for x in got if x.doc_id == doc and x.start_word <= span.start + 5 and x.start_word + x.n_words >= span.stop - 5]
        assert own, doc
    for x in got:
        assert x.source_id < x.doc_id and x.n_words >= 50 and x.similarity >= 0.8
        a = shingle_set(" ".join(text[x.doc_id].split()[x.start_word : x.start_word + x.n_words]))
        b = shingle_set(" ".join(text[x.source_id].split()[x.source_start : x.source_start + x.source_words]))
        assert len(a & b) / len(a | b) == pytest.approx(x.similarity)
    assert len({(x.doc_id, x.start_word, x.n_words, x.source_id) for x in got}) == len(got)


def test_recall_by_passage_length(frame):
    """Passages of 50 words and more with changed words anywhere, their ends included, in pairs of documents."""
    r = random.Random(12)
    words = [f"w{i}" for i in range(20_000)]

    def prose(n):
        return [r.choice(words) for _ in range(n)]

    rows, planted = [], []
    for length, changes in ((50, 1), (60, 1), (80, 1), (120, 2)):
        done = 0
        while done < 60:
            passage = prose(length)
            changed = list(passage)
            for i in [done % length, *r.sample(range(length), changes - 1)]:
                changed[i] = "other"
            a, b = shingle_set(" ".join(passage)), shingle_set(" ".join(changed))
            done += 1
            if len(a & b) / len(a | b) < 0.8:
                continue
            n = len(rows)
            rows += [(n, " ".join(prose(r.randrange(60)) + passage + prose(r.randrange(60)))), (n + 1, " ".join(prose(r.randrange(60)) + changed + prose(r.randrange(60))))]
            planted.append((length, n + 1, n))
    got = {}
    for x in passages.near_passages(frame([(*x, "v", "c") for x in rows], DOC)).collect():
        assert x.n_words >= 50 and x.similarity >= 0.8 and x.source_id < x.doc_id
        got[x.doc_id, x.source_id] = x
    assert set(got) <= {(d, s) for _, d, s in planted}
    for length in (50, 60, 80, 120):
        own = [(d, s) in got for n, d, s in planted if n == length]
        assert len(own) >= 40 and sum(own) / len(own) >= 0.9, (length, sum(own), len(own))
    assert sum((d, s) in got for _, d, s in planted) / len(planted) >= 0.95
