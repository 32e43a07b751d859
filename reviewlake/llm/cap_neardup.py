"""Embedding near-dedup with spherical-cap filters.

Filters are directions on the sphere; a vector passes a filter if its inner
product with the direction reaches the cap height.  Directions form random
product codes: the (randomly rotated) space is split into two blocks, each
with a random code of unit vectors, and a direction is a pair of code words.
A few independent codes (``CODES``, each with a split of its own) are used,
as directions of one code share words and so hit or miss together.  All
directions that a vector exceeds are list-decoded: first words that cannot
reach the cap with the best second word are dropped, the others are
completed.  Vectors are joined on filters and every candidate pair is
verified by its cosine in double precision.

The code size and cap height follow from the number of vectors, by a
simulation with fixed seeds that is independent of the data: caps hold
about ``BUCKET`` vectors if these are spread evenly, and two vectors
exactly at the threshold share a filter with a probability of at least
``RECALL`` (closer ones more).  Every vector passes at least one filter:
one that exceeds none goes to its best direction.

What moves per vector is its bytes once for each filter it passes (about
ten).

Equal vectors are first merged into one with a weight.  A filter that many
vectors pass is dealt into cells of bounded size, and nothing but a count
per vector and a spanning forest leaves a cell, never all pairs.  A pair
that shares several filters counts in the first one only.

Vectors are compared within each length: filters are numbered by length,
and each length has codes of its own.  (``all_pairs_up_to``, 0 unless given,
makes a length of at most so many vectors a single filter, which is exact.)

Cases: a vector that is null, empty, zero, or holds a null or non-finite
component links with nothing, nor do vectors of different lengths; rows
with equal ids are separate vectors; a null id is no component's name
unless all its members are null; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from reviewlake.llm.common import cell_rows, dealt_cells, local_forest, map_arrow, meeting, sorted_groups, split_groups, stage
from reviewlake.llm.components import components

BUCKET = 512             # vectors in a cap, about, if evenly spread
RECALL = 0.995           # of pairs exactly at the threshold
CELL = 512               # rows that one cell compares with each other, at least
CODES = 12               # independent product codes
MAX_CODE = 4096          # code words of a block at most; a larger table has more codes
_CAP_BITS = 40           # of a filter's number within its length: codes * MAX_CODE ** 2 < 2 ** 40


class ProductCodes:
    """Random product codes in ``dim`` dimensions with cap height ``cap``."""

    def __init__(self, dim: int, words: int, cap: float, codes: int = CODES, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.dim, self.words, self.cap, self.codes = dim, words, cap, codes
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.split = [rng.permutation(dim) for _ in range(codes)]
        half = max(1, dim // 2)
        self.blocks = [tuple(c / np.linalg.norm(c, axis=1, keepdims=True) / math.sqrt(2) for c in
                             (rng.standard_normal((words, half)), rng.standard_normal((words, max(1, dim - half))))) for _ in range(codes)]

    def products(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Inner products with the words of both blocks, code by code."""
        y, half = x @ self.rotation, max(1, self.dim // 2)
        for order, (first, second) in zip(self.split, self.blocks):
            yield y[:, order[:half]] @ first.T, y[:, order[half:] if self.dim > 1 else order] @ second.T

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, filter) of all filters that each unit vector exceeds, by
        vector and ascending filter number."""
        rows, filters = [], []
        best, best_at = np.full(len(x), -np.inf), np.zeros(len(x), np.int64)
        for k, (a, b) in enumerate(self.products(x)):
            base = k * self.words * self.words
            top = a.max(axis=1) + b.max(axis=1)
            better = top > best
            best[better] = top[better]
            best_at[better] = (base + a.argmax(axis=1) * self.words + b.argmax(axis=1))[better]
            v, i = np.nonzero(a + b.max(axis=1, keepdims=True) >= self.cap)      # first words that some second word completes
            for at in range(0, len(v), 65_536):
                r, f = v[at:at + 65_536], i[at:at + 65_536]
                m, j = np.nonzero(b[r] >= self.cap - a[r, f][:, None])
                rows.append(r[m])
                filters.append(base + f[m] * self.words + j)
        rows, filters = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (rows, filters))
        none = np.flatnonzero(np.bincount(rows, minlength=len(x)) == 0)
        rows, filters = np.concatenate([rows, none]), np.concatenate([filters, best_at[none]])
        order = np.lexsort((filters, rows))
        return rows[order], filters[order]

    def share_filter(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether x[k] and y[k] pass a common filter."""
        size = self.codes * self.words * self.words
        both = np.intersect1d(*(r * size + f for r, f in (self.decode(x), self.decode(y))), assume_unique=True)
        return np.isin(np.arange(len(x)), both // size)


def cap_height(dim: int, share: float) -> float:
    """Height of the cap that covers ``share`` of the unit sphere."""
    angle = np.linspace(-np.pi / 2, np.pi / 2, 400_001)[1:-1]
    weight = np.cos(angle) ** (dim - 2) if dim > 1 else np.ones(len(angle))
    above = np.cumsum(weight[::-1])
    return float(np.sin(angle[::-1][np.searchsorted(above, share * above[-1])]))


@lru_cache(maxsize=64)
def fitted_codes(n: int, dim: int, threshold: float) -> ProductCodes:
    """The codes for ``n`` vectors (see the module text)."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((2000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((2000, dim))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-30)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * z
    share = min(0.06, BUCKET / max(n, 1))                   # of the sphere that a cap covers
    cap, lists = cap_height(dim, share), 5.0
    while True:
        many = max(CODES, math.ceil(lists / share / MAX_CODE ** 2))
        codes = ProductCodes(dim, min(MAX_CODE, max(2, math.ceil(math.sqrt(lists / share / many)))), cap, many)
        if np.mean(codes.share_filter(x, y)) >= RECALL:
            return codes
        lists *= 1.2
        if lists > 60:                                      # few dimensions: pairs of words leave parts of the sphere out
            cap, lists = cap - 0.1, 5.0


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Unit vectors in double precision."""
    v = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)         # so that squares neither overflow nor vanish
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _keyed(vectors: DataFrame, id_col: str, vec_col: str, kind: str) -> DataFrame:
    """(id, key, dim): the vector's bytes, null where it can link with nothing."""
    spread = F.col(vec_col).cast("array<float>" if kind == "<f4" else "array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, dims = [], []
            for v in b.column(1):
                a = np.asarray(v.values.to_numpy(zero_copy_only=False), kind) if v.is_valid else np.zeros(0, kind)
                good = len(a) > 0 and np.isfinite(a).all() and a.any()
                keys.append((a + a.dtype.type(0)).tobytes() if good else None)      # + 0: no negative zero
                dims.append(len(a) if good else None)
            yield pa.record_batch([b.column(0).cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(dims, pa.int32())],
                                  names=["id", "key", "dim"])

    return map_arrow(vectors.select(F.col(id_col).cast("long").alias("id"), spread.alias("v")), run,
                     "id long, key binary, dim int")


def linked_vectors(distinct: DataFrame, threshold: float, kind: str, all_pairs_up_to: int = 0) -> tuple[DataFrame, DataFrame]:
    """Of staged (vid, key, dim, weight): (vid, n_links) and spanning links (x, y)."""
    sizes = dict(distinct.groupBy("dim").agg(F.count(F.lit(1))).where(F.col("count(1)") > all_pairs_up_to).collect())   # a row per length

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim in sizes:
                    row, cap = fitted_codes(sizes[dim], dim, threshold).decode(_unit(b.column("key").take(pa.array(at)).to_pylist(), kind))
                else:
                    row, cap = np.arange(len(at)), np.zeros(len(at), np.int64)
                yield pa.record_batch([pa.array((dim << _CAP_BITS) + cap, pa.int64()), b.column("vid").take(pa.array(at[row]))], names=["cap", "vid"])

    passed = stage(map_arrow(distinct.select("vid", "key", "dim"), listed, "cap long, vid long"), "caps")
    lists = passed.groupBy("vid").agg(F.array_sort(F.collect_list("cap")).alias("caps"))           # a list per vector is short
    rows = split_groups(passed, "cap", "vid", cell_rows(passed, CELL)).join(distinct.drop("dim").join(lists, "vid"), "vid")
    cells = dealt_cells(rows.select("cell", "side", "cap", "vid", "key", "weight", "caps"), "side", "vid")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in sorted_groups(batches, "cell"):
            u = _unit(t.column("key").to_pylist(), kind)
            rows, cols, same = meeting(t.column("side").to_numpy())
            if not len(rows) or not len(cols):
                continue
            i, j = np.nonzero(u[rows] @ u[cols].T >= threshold)
            i, j = rows[i], cols[j]
            if same:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            first = _first_shared(t, i, j)
            i, j = i[first], j[first]
            weight, links = t.column("weight").to_numpy(), np.zeros(len(u), np.int64)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            root = local_forest(len(u), i, j)
            out = np.flatnonzero(links)
            vid = t.column("vid").to_numpy()
            yield pa.record_batch([pa.array(vid[out]), pa.array(links[out]), pa.array(vid[root[out]])], names=["vid", "n", "root"])

    found = stage(map_arrow(cells, verify, "vid long, n long, root long"), "cap-links")
    return found.groupBy("vid").agg(F.sum("n").alias("n")), found.select(F.col("vid").alias("x"), F.col("root").alias("y"))


def _first_shared(t: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether this cap is the smallest that both vectors of a pair passed."""
    cap = t.column("cap")[0].as_py()
    used = np.unique(np.concatenate([i, j]))
    at = np.zeros(t.num_rows, np.int64)
    at[used] = np.arange(len(used))
    lists = [np.array(c) for c in t.column("caps").take(pa.array(used)).to_pylist()]
    lower = [c[c < cap] for c in lists]
    names, column = np.unique(np.concatenate(lower), return_inverse=True)
    has = np.zeros((len(used), len(names)), np.float32)
    has[np.repeat(np.arange(len(used)), [len(c) for c in lower]), column] = 1
    shared = has @ has.T
    return shared[at[i], at[j]] == 0


def embedding_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                              threshold: float = 0.95, all_pairs_up_to: int = 0) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``vectors``."""
    kind = "<f4" if vectors.schema[vec_col].dataType == ArrayType(FloatType()) else "<f8"
    keyed = stage(_keyed(vectors, id_col, vec_col, kind), "vectors")
    distinct = stage(keyed.where("key is not null").groupBy("key").agg(F.first("dim").alias("dim"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
                     .withColumn("vid", F.monotonically_increasing_id()), "distinct-vectors")
    own = F.col("id")
    if distinct.isEmpty():
        return keyed.select(own.alias(id_col), F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))
    counts, links = linked_vectors(distinct.select("vid", "key", "dim", "weight"), threshold, kind, all_pairs_up_to)
    comp = components(links, "x", "y").withColumnRenamed("node", "vid")
    named = distinct.join(comp, "vid", "left").join(counts, "vid", "left") \
                    .withColumn("component", F.coalesce("component", "vid")) \
                    .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("weight") - 1)
    low = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.select("key", "n_links", "component").join(low, "component").select("key", "n_links", "component_id")
    out = keyed.join(named, "key", "left")
    linked = F.col("n_links").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(own)
    return out.select(own.alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), own.eqNullSafe(component).alias("kept"))
