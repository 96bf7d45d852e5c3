"""Clusters against a plain loop over all distances."""

import hashlib
import random

import numpy as np
import pytest

from fathomframe.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, v string, cluster string"


def brute(rows, clusters, rounds, dimensions):
    kept = []
    for i, x in rows:
        x = None if x is None else [None if c is None else float(np.float32(c)) for c in x]
        if x is not None and len(x) == dimensions and all(c is not None and abs(c) < float("inf") for c in x):
            kept.append((i, tuple(max(-centroids.BOUND, min(centroids.BOUND, int(np.floor(1024 * c)))) for c in x)))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(v) for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(middle))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, g in groups.items():
            middle[k] = [sum(c) // len(g) for c in zip(*g)]
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    total = {}
    for _, k, d in out:
        total[k] = total.get(k, 0) + d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    return sorted(((i, k, d, total[k], sum(total.values()), sha[k]) for i, k, d in out), key=str)


def run(frame, rows, clusters, rounds, dimensions):
    df = frame([(i, x, "a", "b") for i, x in rows], SCHEMA)
    placed, middle = centroids.cluster(df, clusters=clusters, rounds=rounds, dimensions=dimensions)
    out = centroids.with_inertia(placed, middle)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("spread", [1.0, 0.002, 60000.0])
def test_clusters(frame, spread):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) * spread for _ in range(6)]) for i in range(400)]
    assert run(frame, rows, 8, 10, 6) == brute(rows, 8, 10, 6)


def test_ties_repeats_and_odd_vectors(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 4), float(i % 3)]) for i in range(200)] + [(7, [1.0, 1.0]), (7, [0.0, 9.0]), (None, [2.0, 2.0])]
    rows += [(900, None), (901, []), (902, [1.0]), (903, [1.0, None]), (904, [nan, 1.0]), (905, [inf, 1.0]), (906, [1.0, -inf]),
             (907, [3e38, -3e38]), (908, [1.0, 2.0, 3.0])]
    assert run(frame, rows, 5, 4, 2) == brute(rows, 5, 4, 2)


def test_few_and_no_vectors(frame):
    assert run(frame, [], 8, 10, 2) == []
    rows = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-0.1, 0.0])]
    assert run(frame, rows, 8, 10, 2) == brute(rows, 8, 10, 2)


def test_sign_tests_agree_with_distances():
    rng = np.random.default_rng(2)
    for bound in (3, 1000, centroids.BOUND):
        middle, x = rng.integers(-bound, bound + 1, (8, 5)), rng.integers(-bound, bound + 1, (500, 5))
        gaps = ((x[:, None].astype(object) - middle[None].astype(object)) ** 2).sum(axis=2)
        planes = centroids.Bisectors.of(middle)
        won = planes.winners(x)
        assert (won == np.array([list(g).index(min(g)) for g in gaps])).all()
        assert planes.distances(x, won).tolist() == [int(g[w]) for g, w in zip(gaps, won)]
