"""Fingerprints, likeness and located edits against the same rules in Python."""

import hashlib
import random
import re

import pytest

from fathomframe.llm import merkle

SCHEMA = "doc_id long, text string, _id string, fingerprint string, edited string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(text):
    """Sections of paragraphs of leaves."""
    sections, paragraphs, leaves = [], [], []
    for x in re.findall(r"[^.!?\n]{1,240}[.!?\n]*|[.!?\n]+", text):
        leaves.append(f"{sha(x)[:16]}.{len(x)}")
        if x.endswith("\n") or sha(x)[0] in "01":
            paragraphs.append(leaves)
            leaves = []
            if x.endswith("\n\n") or sha(",".join([*paragraphs[-1], "/"]))[0] in "01":
                sections.append(paragraphs)
                paragraphs = []
    if leaves:
        paragraphs.append(leaves)
        if sha(",".join([*leaves, ""]))[0] in "01":
            sections.append(paragraphs)
            paragraphs = []
    return [*sections, paragraphs] if paragraphs else sections


def fingerprint(text):
    whole = tree(text)
    return sha("".join(sha("".join(sha("".join(f"{x}," for x in p)) for p in s)) for s in whole))


def leaves(text):
    return [x for s in tree(text) for p in s for x in p]


def likeness(a, b):
    if fingerprint(a) == fingerprint(b):
        return 1.0
    x, y = set(leaves(a)), set(leaves(b))
    size = lambda z: sum(int(i.split(".")[1]) for i in z)
    return 2 * size(x & y) / (size(x) + size(y))


def prose(rng, n):
    return "".join(rng.choice(["ab", "cé", "de", "f𝛼", " ", " ", ". ", "!\n", "\n\n", "?"]) for _ in range(n))


def fingers(frame, texts):
    df = frame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r.own for r in merkle.fingerprint(df, "text", "own").collect()}


def test_trees(frame):
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(400)) for _ in range(150)] + ["", None, ".", "\n\n\n", "x" * 1000, "a b. " * 20_000, "q" * 300_000 + ". z"]
    got = fingers(frame, texts)
    for i, t in enumerate(texts):
        head, body = got[i].split(" ", 1)
        assert head == fingerprint(t or "")
        assert [[p.strip(",").split(",") for p in s.split("/") if p] for s in body.split("#") if s] == tree(t or "")
    assert len(set(got.values())) == len({t or "" for t in texts})


def common(x, y, levels):
    n = 0
    for p, q in zip(x, y):
        if p != q:
            return n + (common(p, q, levels - 1) if levels else 0)
        n += sum(int(v.split(".")[1]) for v in flat(p))
    return n


def flat(x):
    return [x] if isinstance(x, str) else [v for y in x for v in flat(y)]


def backwards(x):
    return x if isinstance(x, str) else [backwards(y) for y in reversed(x)]


def test_likeness_and_located_edits(frame):
    rng = random.Random(4)
    pairs = [("", ""), ("", "a. b"), ("a. b", ""), ("same. text", "same. text"), ("x. x. ", "x. x. x. ")]
    for _ in range(120):
        t = prose(rng, 300)
        at, to = sorted(rng.randrange(len(t) + 1) for _ in range(2))
        pairs += [(t, t[:at] + prose(rng, 20) + t[to:]), (t, t[:at] + "new. " + t[at:]), (t, prose(rng, 300))]
    ids = range(len(pairs))
    a, b = fingers(frame, [p for p, _ in pairs]), fingers(frame, [q for _, q in pairs])
    df = frame([(i, a[i], b[i], "k") for i in ids], "doc_id long, a string, b string, _near_a string")
    got = merkle.edited(merkle.likeness(df, "a", "b", "near"), "a", "b")
    for r in got.collect():
        x, y = pairs[r.doc_id]
        assert r.near == pytest.approx(likeness(x, y)) and 0 <= r.near <= 1
        if x == y:
            assert (r.near, r.edit_start, r.edit_end) == (1.0, None, None)
            continue
        start = common(tree(x), tree(y), 2)
        assert r.edit_start == start and r.edit_end == max(start, len(x) - common(backwards(tree(x)), backwards(tree(y)), 2))
        assert x[: r.edit_start] == y[: r.edit_start]
        assert x[r.edit_end :] == "" or y.endswith(x[r.edit_end :])


def expected(rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    ids = sorted(texts, key=lambda i: (i is None, -(i or 0)))
    after = {i: min(texts[j], key=sha) for i, j in zip(ids, ids[1:] + ids[:1])}
    out = []
    for i, t in rows:
        t, k = t or "", len(t or "") // 3
        out.append((i, t, t[: len(t) - k] + after[i][:k], after[i]))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [], [(5, "one document only. It is its own neighbour")], [(i, prose(random.Random(i), 90)) for i in range(-20, 40)],
    [(1, None), (2, ""), (3, "abcdef"), (None, "nobody's text"), (None, None), (3, "abcxyz"), (3, "abcdef"), (9, "𝛼" * 5000)],
    [(7, "same")] * 50 + [(8, "later text")]])
def test_neighbours(frame, rows):
    df = frame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    out = merkle.with_edits(df)
    assert out.columns == ["doc_id", "text", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    got = sorted(out.collect(), key=lambda r: str((r.doc_id, r.text, r.edited)))
    assert sorted(((r.doc_id, r.text, r.edited) for r in got), key=str) == sorted((e[:3] for e in expected(rows)), key=str)
    follows = {str(e[:3]): e[3] for e in expected(rows)}
    for r in got:
        nxt = follows[str((r.doc_id, r.text, r.edited))]
        assert [f[:64] for f in r[3:]] == [fingerprint(x) for x in (r.text, r.edited, nxt)]


def test_main_path_is_native(frame):
    df = frame([(1, "a", "x", "y", "z")], SCHEMA)
    out = merkle.edited(merkle.likeness(merkle.with_edits(df), "fingerprint", "edited_fingerprint", "near"), "fingerprint", "edited_fingerprint")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
