"""SimHash trees, spherical-cap filters and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlake.llm.cap_neardup import embedding_near_duplicates, fitted_codes
from reviewlake.llm.common import dealt_cells, local_forest, meeting, split_groups
from reviewlake.llm.components import components
from reviewlake.llm.simhash_vp import fit_tree, linked_fingerprints, near_duplicates, route, shards, simhash_components, text_fingerprint


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@given(st.text(st.sampled_from(list("aAbÉé \n\t\x0b\x1c\x85.")), max_size=60))
def test_fingerprint(text):
    assert text_fingerprint(text) == slow_fingerprint(text)


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    edges += [(k, k + 1) for k in range(500, 620)]                     # a long path
    edges += [(700, k) for k in range(701, 1400)] + [(5, 5), (5, 5)]   # a hub, loops, repeats
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r[0]: r[1] for r in components(df, "a", "b").collect()}
    want = roots(1400, edges)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want[x] for x in nodes}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


@given(st.integers(1, 40), st.lists(st.tuples(st.integers(0, 39), st.integers(0, 39)), max_size=60))
def test_local_forest(n, links):
    links = [(a % n, b % n) for a, b in links]
    i, j = (np.array([x[k] for x in links], int) for k in (0, 1))
    assert local_forest(n, i, j).tolist() == roots(n, links)


def test_cells_let_each_pair_meet_once(spark):
    rows = spark.createDataFrame([(0, k) for k in range(50)] + [(1, k) for k in range(5)], "g int, m long")
    cells = dealt_cells(split_groups(rows, "g", "m", 8), "side", "m").toPandas()
    met = []
    for _, c in cells.groupby("cell"):
        c = c.sort_values(["side", "m"])
        r, k, same = meeting(c["side"].to_numpy())
        m, g = c["m"].to_numpy(), c["g"].iloc[0]
        met += [(g, *sorted((m[x], m[y]))) for x in r for y in k if not same or x < y]
    assert len(met) == len(set(met)) == 50 * 49 // 2 + 5 * 4 // 2


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 3))
def test_tree_brings_close_points_together(seed, radius):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**32, 60, dtype=np.uint32)
    near = base ^ (np.uint32(1) << rng.integers(0, 32, 60).astype(np.uint32))
    p = np.unique(np.concatenate([base, near]))
    tree = fit_tree(p[::2], 8, radius)
    i, leaf = route(tree, p, radius)
    shards = [set(leaf[i == k]) for k in range(len(p))]
    for a in range(len(p)):
        assert shards[a]
        for b in range(a):
            if int(p[a] ^ p[b]).bit_count() <= radius:
                assert shards[a] & shards[b]


def test_linked_fingerprints_are_exact(spark):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 2**63, 700, dtype=np.uint64)
    cloud = [centre[0] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))) for _ in range(900)]
    moved = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, d, replace=False))) for d in (1, 2, 3, 4) for c in centre[:150]]
    fp = np.unique(np.concatenate([centre, np.array(cloud + moved, np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
    at = {int(x): k for k, x in enumerate(fp.view(np.int64))}
    got = [(at[r[0]], at[r[1]]) for r in linked_fingerprints(df, "fp", 3).collect()]
    want = [(a, b) for a in range(len(fp)) for b in np.flatnonzero(np.bitwise_count(fp[:a] ^ fp[a]) <= 3)]
    assert roots(len(fp), got) == roots(len(fp), want)
    got = [(at[r[0]], at[r[1]]) for r in linked_fingerprints(df, "fp", 3, sample_rows=64, leaf_rows=16).collect()]    # subtrees of subtrees
    assert roots(len(fp), got) == roots(len(fp), want)


def test_shards_stay_small_when_the_table_grows(spark):
    """Random fingerprints: a first tree of few points, subtrees for the rest."""
    size = {}
    for n in (4_000, 32_000):
        df = spark.range(n).select(F.xxhash64("id").alias("fp"))
        rows = shards(df, "fp", 1, sample_rows=256, leaf_rows=64)
        per = rows.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n"), F.sum(F.col("n") * F.col("n"))).first()
        assert per[0] <= 128 and rows.select("x").distinct().count() == n
        size[n] = per[1] / n
    assert size[32_000] < 2.5 * size[4_000]                  # comparisons per row; eight times the rows
    same = spark.range(600).select(F.col("id").alias("fp"))  # one value in all upper halves: no ball splits it
    assert shards(same, "fp", 1, sample_rows=64, leaf_rows=16).where("shard % 2 = 0").select("x").distinct().count() == 600


def brute_components(rows):
    fp = [slow_fingerprint(t or "") for _, t in rows]
    root = roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 3])
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return [(i, f"{f:016x}", low.get(r)) for (i, _), f, r in zip(rows, fp, root)], root


def test_simhash_components(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    want, root = brute_components(rows)
    key = lambda x: str(x)
    assert sorted((tuple(r) for r in simhash_components(odd_docs).collect()), key=key) == sorted(want, key=key)
    kept = near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(kept) == len(set(root))
    assert sorted(str(want[rows.index(k)][2]) for k in kept) == sorted(str(want[k][2]) for k in set(root))


def test_simhash_empty(no_docs):
    assert simhash_components(no_docs).count() == 0 and near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("n", [100, 20_000])
def test_cap_code_meets_pairs_at_the_threshold(n):
    codes = fitted_codes(n, 32, 0.95)
    rng = np.random.default_rng(99)
    x = rng.standard_normal((600, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((600, 32))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    assert codes.share_filter(x, 0.95 * x + np.sqrt(1 - 0.95**2) * z).mean() >= 0.98
    row, cap = codes.decode(x[:5])
    want = [[] for _ in range(5)]                        # list decoding finds exactly the exceeding directions
    for k, (a, b) in enumerate(codes.products(x[:5])):
        for v in range(5):
            want[v] += (k * codes.words**2 + np.flatnonzero((a[v][:, None] + b[v][None, :]).ravel() >= codes.cap)).tolist()
    for v in range(5):
        assert not want[v] and (row == v).sum() == 1 or cap[row == v].tolist() == want[v]


def brute_vectors(rows, threshold=0.95):
    dim = max([len(v) for _, v in rows if v] or [0])
    good = [k for k, (_, v) in enumerate(rows) if v and len(v) == dim and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([rows[k][1] for k in good], float).reshape(len(good), -1)
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if len(good) else x
    near = x @ x.T >= threshold
    links = [(good[a], good[b]) for a, b in zip(*np.nonzero(near)) if a != b]
    root, n = roots(len(rows), links), np.zeros(len(rows), int)
    for a, _ in links:
        n[a] += 1
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return sorted((str(i), int(c), str(low.get(r)), i == low.get(r)) for (i, _), c, r in zip(rows, n, root))


def test_embedding_near_duplicates(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal((60, 16))
    rows = [(k, c.tolist()) for k, c in enumerate(centre)]
    rows += [(100 + k, (c + rng.standard_normal(16) * s).tolist()) for k, (c, s) in enumerate((c, s) for c in centre[:20] for s in (0.05, 0.1, 0.2, 0.3))]
    rows += [(300 + k, (centre[0] + rng.standard_normal(16) * 0.02).tolist()) for k in range(400)]     # a dense group
    rows += [(800 + k, centre[1].tolist()) for k in range(300)] + [(800, centre[2].tolist()), (None, centre[2].tolist())]
    rows += [(1200, (centre[3] * 1e-3).tolist()), (1201, (-centre[3]).tolist()), (1202, None), (1203, []), (1204, [0.0] * 16),
             (1205, [float("nan")] * 16), (1206, [float("inf")] + [0.0] * 15), (1207, [None] + [1.0] * 15), (1208, [1.0] * 15), (1209, [-0.0] * 16)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, 1, i, "k") for i, v in rows], "vec_id long, embedding array<float>, label int, id long, key string")
    got = embedding_near_duplicates(df).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == brute_vectors(rows)


def test_one_long_vector_silences_no_other(spark):
    rng = np.random.default_rng(8)
    rows = []
    for dim, n in ((16, 700), (17, 40), (3, 25), (40, 1)):
        base = rng.standard_normal((n, dim))
        rows += [v.tolist() for v in base] + [(v + rng.standard_normal(dim) * 0.02).tolist() for v in base[:n // 3]] + [v.tolist() for v in base[:n // 4]]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in enumerate(rows)]
    got = embedding_near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    got = {str(r["vec_id"]): (str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got}
    for dim in (16, 17, 3, 40):
        want = brute_vectors([r for r in rows if len(r[1]) == dim])
        links = sum(w[1] for w in want)                  # every length has codes, which miss few pairs
        assert links * 0.99 <= sum(got[w[0]][1] for w in want) <= links
        if dim == 16:
            assert links > 500
    exact = embedding_near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), all_pairs_up_to=10_000)
    exact = {str(r["vec_id"]): (str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in exact.collect()}
    for dim in (16, 17, 3, 40):
        want = brute_vectors([r for r in rows if len(r[1]) == dim])
        assert sorted(exact[w[0]] for w in want) == want
    assert len(got) == len(rows)


def test_recall_of_pairs_between_the_threshold_and_one(spark):
    rng = np.random.default_rng(21)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((1500, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    c = rng.uniform(0.9502, 1, (1500, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, c * x + np.sqrt(1 - c * c) * z]))]
    got = embedding_near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sum(r["n_links"] for r in got) >= 0.995 * 3000 and all(r["component_id"] == r["vec_id"] % 1500 for r in got if r["n_links"])


def test_embeddings_empty_or_useless(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = embedding_near_duplicates(spark.createDataFrame([(1, None), (2, [0.0])], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]
