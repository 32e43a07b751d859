"""Clusters against plain Python integers; bounds never exceed distances."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.llm import ptolemy_clusters as pt


def plain(rows, k=8, rounds=10, dim=64, scale=1024):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
              if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(usable, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, o)), j) for j, o in enumerate(c))
    for _ in range(rounds):
        members = [[] for _ in c]
        for _, v in usable:
            members[nearest(v)[1]].append(v)
        c = [[sum(col) // len(m) for col in zip(*m)] if m else o for m, o in zip(members, c)]
    return sorted(((repr(i), nearest(v)[1], nearest(v)[0]) for i, v in usable)), c


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], "vec_id long, embedding array<double>, v int, d int, cluster string").repartition(4)


def vectors(n, seed=0, dim=64):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 0.5) for _ in range(dim)] for _ in range(5)]
    return [[x + rng.gauss(0, 0.2) for x in rng.choice(middle)] for _ in range(n)]


def compare(spark, rows, **kw):
    got, centroids = pt.cluster(table(spark, rows), **kw)
    want, c = plain(rows, **kw)
    assert sorted((repr(r["id"]), r["cluster"], r["distance"]) for r in got.collect()) == want and centroids == c
    out = pt.with_inertia(got, centroids).collect()
    for r in out:
        assert r["cluster_inertia"] == sum(d for _, k, d in want if k == r["cluster"]) and r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()


def test_equals_plain_integers(spark):
    v = vectors(300)
    rows = list(enumerate(v)) + [(1000 + k, v[0]) for k in range(150)] + [(5, v[5]), (5, v[6]), (None, v[7]), (None, v[8])]
    rows += [(2000, None), (2001, []), (2002, v[0][:63]), (2003, [None, *v[0][1:]]), (2004, [float("nan"), *v[0][1:]]),
             (2005, [float("inf"), *v[0][1:]]), (2006, [0.0] * 64), (2007, [-0.0] * 64), (2008, [*v[0], 1.0])]
    compare(spark, rows)


def test_ties_and_few_vectors(spark):
    grid = [(i, [float(i % 3), float(i % 2)]) for i in range(40)]               # equal centroids, equal distances
    compare(spark, grid, k=8, rounds=3, dim=2, scale=1)
    compare(spark, [(1, [0.5, 1.5]), (2, [2.5, -1.0])], k=8, rounds=2, dim=2, scale=1024)
    compare(spark, [(1, [1e5, -1e5]), (2, [-1e5, 1e5]), (3, [1e5, 1e5])], k=2, rounds=4, dim=2, scale=1024)
    got, c = pt.cluster(table(spark, [(1, [1.0])]))
    assert got.count() == 0 and c == [] and pt.with_inertia(got, c).count() == 0
    with pytest.raises(Exception, match="exceeds"):
        pt.cluster(table(spark, [(1, [1e9, 0.0])]), dim=2)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 3, 1000, pt.LARGEST]))
def test_bounds_hold(seed, size):
    rng = np.random.default_rng(seed)
    x, c, p = (rng.integers(-size, size + 1, (n, 4)) for n in (30, 5, 4))
    p[1] = p[0]                                                                  # a pair of equal pivots bounds nothing
    low = pt.lower_bounds(pt.to_pivots(x, p), pt.to_pivots(c, p), pt.to_pivots(p, p))
    for k in range(5):
        exact = pt.squared(x, c[k])
        assert all(f * f <= int(d) for f, d in zip(low[:, k].tolist(), exact.tolist()))


def test_bounds_prune():
    v = np.floor(np.array(vectors(2000, 3)) * 1024).astype(np.int64)
    nearest = pt.Assigner(v[:8].tolist(), v[:8].tolist())
    to, d = nearest(v, pt.to_pivots(v, v[:8]))
    exact = np.stack([pt.squared(v, c) for c in v[:8]], axis=1)
    assert (to == exact.argmin(axis=1)).all() and (d == exact.min(axis=1)).all()
    assert nearest.looked < 0.7 * nearest.pairs
