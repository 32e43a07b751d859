"""SimHash near-dedup over vantage-point trees.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word
shingles.  Two fingerprints within ``max_distance`` bits are linked; links
are found exactly:

* a fingerprint is split into two halves; of two fingerprints within D bits
  one half differs in at most D // 2 bits, so each half has its own tree
  with that query radius;
* a vantage-point tree partitions half-fingerprints by their Hamming
  distance to vantage points.  A point beyond a ball's boundary by at most
  the radius also visits the inside; by the triangle inequality no closer
  pair can be apart then, so all other branches are pruned;
* each leaf is a shard.  A first tree is fitted on a bounded sample of all
  fingerprints; every shard that still holds more than ``2 * LEAF`` rows,
  visitors included, gets a subtree of its own, fitted in a task on a bounded
  sample of that shard, level by level, so that shards hold a bounded number
  of rows however many fingerprints there are;
* a shard that no ball can split (its half-fingerprints are nearly the same)
  is dealt into chunks, and each two chunks meet in a task of their own;
* within a task all fingerprints are compared over all 64 bits, and a
  spanning forest of the links is sent on instead of all pairs.

Samples (``SAMPLE`` rows of the table, ``SUBSAMPLE`` of a shard) only steer the
partitioning: every fingerprint passes through the trees, so the links do not
depend on them.  Subtrees are rows of a table beside the points that they
route; only the first trees are seen by the driver.

Cases: a null or wordless text has fingerprint zero and is linked like any
other; texts with fewer words than a shingle are one shingle; rows with
equal ids are kept apart (the smallest id counts); a null id is no
component's name unless all its members are null; an empty table gives an
empty result; extra columns are kept by ``near_duplicates`` and renamed by
nobody.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import (dealt_cells, free_name, local_forest, map_arrow, meeting, mix, prepare, shuffle_partitions,
                                   sorted_groups, split_groups, stage, texts)
from reviewlake.llm.components import components

SEED = 42                # of the shingle hash
SAMPLE = 65_536          # distinct fingerprints that the first trees are fitted on, about
SUBSAMPLE = 8_192        # rows of a shard that its subtree is fitted on, about
LEAF = 1_024             # rows of a leaf to aim for, visitors included
ROUTED = 1 << 20         # rows of a shard that one task routes, about
GATHER = 65_536          # rows that go through a tree at once
HALVES = 2


# --- fingerprints -----------------------------------------------------------

def text_fingerprint(text: str, words: int = 3) -> int:
    """Fingerprint of one text (A-Z lower-cased, split at ASCII white space)."""
    import xxhash
    token = text.encode("utf-8", "surrogatepass").lower().split()
    if not token:
        return 0
    f, k = xxhash.xxh64_intdigest, min(words, len(token))
    line = b" ".join(token)
    size = np.fromiter(map(len, token), np.int64, len(token))
    end = np.cumsum(size + 1) - 1
    lo, hi = (end - size)[:len(token) - k + 1].tolist(), end[k - 1:].tolist()
    h = np.fromiter((f(line[x:y], SEED) for x, y in zip(lo, hi)), np.uint64, len(lo))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 32_768):
        part = h[at:at + 32_768].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, out: str, text_col: str = "text", words: int = 3) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in column ``out``."""
    schema = docs.select("*").schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((text_fingerprint(t, words) for t in texts(b.column(text_col)).to_pylist()), np.uint64, b.num_rows)
            yield pa.record_batch([*b.columns, pa.array(fp.view(np.int64))], names=[*b.schema.names, out])

    return map_arrow(docs, run, schema)


# --- vantage-point tree -----------------------------------------------------

def fit_tree(points: np.ndarray, leaf: int, radius: int) -> list[tuple]:
    """Nodes (vantage, boundary, inside, outside); a child below zero is the
    leaf -child - 1.  Of a few vantage points and their middle distances it
    takes the pair that leaves the fewest comparisons.  Points that visit the
    inside from beyond its boundary count there, so a leaf holds them too."""
    nodes: list = []
    leaves = 0

    def grow(p: np.ndarray) -> int:
        nonlocal leaves
        best = None
        if len(p) > leaf:
            for v in p[np.linspace(0, len(p) - 1, 7).astype(int)]:
                upto = np.cumsum(np.bincount(np.bitwise_count(p ^ v), minlength=66))        # points within each distance
                for t in set(np.searchsorted(upto, np.array([0.3, 0.5, 0.7]) * len(p)).tolist()):
                    inside, outside = int(upto[min(t + radius, 65)]), len(p) - int(upto[t])
                    score = inside * inside + outside * outside
                    if outside and (best is None or score < best[0]):
                        best = (score, v, t)
        if best is None or best[0] >= 0.95 * len(p) ** 2:
            leaves += 1
            return -leaves
        _, v, t = best
        at = len(nodes)
        nodes.append(None)
        d = np.bitwise_count(p ^ v)
        nodes[at] = (int(v), t, grow(p[d <= t + radius]), grow(p[d > t]))
        return at

    grow(np.sort(points))
    return nodes


def route(nodes: list[tuple], points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of point, leaf) of every visit."""
    index, leaf = [], []
    todo = [(0 if nodes else -1, np.arange(len(points)))]
    while todo:
        at, i = todo.pop()
        if not len(i):
            continue
        if at < 0:
            index.append(i)
            leaf.append(np.full(len(i), -at - 1))
            continue
        v, t, inside, outside = nodes[at]
        d = np.bitwise_count(points[i] ^ points.dtype.type(v))
        todo.append((inside, i[d <= t + radius]))
        todo.append((outside, i[d > t]))
    if not index:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(index), np.concatenate(leaf)


def halves(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [(u >> np.uint64(32)).astype(np.uint32), (u & np.uint64(0xFFFFFFFF)).astype(np.uint32)]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of small rows put together, so that a tree is walked seldom."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _subtrees(big: DataFrame, radius: int, leaf: int) -> DataFrame:
    """(shard, _n, nodes) of every shard of the rows (x, shard, _n): a tree
    fitted on a sample of the shard's own rows; no nodes if none splits it."""
    share = F.least(F.lit(1.0), F.lit(SUBSAMPLE) / F.col("_n"))
    sample = big.where(F.pmod(F.xxhash64("x", "shard", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30))
    whole = sample.repartition(shuffle_partitions(big.sparkSession), "shard").sortWithinPartitions("shard")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, t in sorted_groups(batches, "shard"):
            n, p = t.column("_n")[0].as_py(), halves(t.column("x").to_numpy())[shard % HALVES]
            nodes = np.array(fit_tree(p, max(16, leaf * len(p) // n), radius), np.int64)
            yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([n], pa.int64()), pa.array([nodes.tobytes()], pa.binary())],
                                  names=["shard", "_n", "nodes"])

    return map_arrow(whole, fit, "shard long, _n long, nodes binary")


def _descended(big: DataFrame, trees: DataFrame, radius: int) -> DataFrame:
    """The rows (x, shard, _n) routed through the subtrees of their shards.
    A large shard is routed by several tasks, each with a copy of its tree."""
    tasks = F.ceil(F.col("_n") / F.lit(ROUTED)).cast("int")
    points = big.select("shard", F.pmod(F.xxhash64("x", F.lit(13)), tasks).cast("int").alias("task"), "x", F.lit(None).cast("binary").alias("nodes"))
    roots = trees.select("shard", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("task"), F.lit(None).cast("long").alias("x"), "nodes")
    beside = points.unionByName(roots).repartition(shuffle_partitions(big.sparkSession), "shard", "task") \
                   .sortWithinPartitions("shard", "task", F.col("nodes").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[tuple] = []
        for b in _gathered(batches, GATHER):
            shard, x = b.column("shard").to_numpy(), b.column("x").fill_null(0).to_numpy()
            root = b.column("nodes").is_valid().to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(root).tolist()
            for lo, hi in zip([0, *starts], [*starts, b.num_rows]):
                if lo < hi and root[lo]:
                    nodes = [tuple(r) for r in np.frombuffer(b.column("nodes")[lo].as_py(), np.int64).reshape(-1, 4).tolist()]
                    lo += 1
                if lo < hi:
                    half = int(shard[lo]) % HALVES
                    i, at = route(nodes, halves(x[lo:hi])[half], radius)
                    deeper = mix(mix(np.full(len(at), shard[lo]).view(np.uint64)) + at.astype(np.uint64))    # equal names would only join two shards
                    deeper = (deeper & ~np.uint64(1) | np.uint64(half)).view(np.int64)
                    yield pa.record_batch([pa.array(x[lo:hi][i]), pa.array(deeper)], names=["x", "shard"])

    return map_arrow(beside, run, "x long, shard long")


def shards(distinct: DataFrame, fp: str, radius: int, sample_rows: int = SAMPLE, leaf_rows: int = LEAF) -> DataFrame:
    """(x, shard) of the distinct long fingerprints in ``fp``: two that differ
    in at most ``radius`` bits of a half share a shard.  The last bit of a
    shard's name is the half that it is for.  A shard holds ``2 * leaf_rows``
    rows at most, unless no ball splits it."""
    spark = distinct.sparkSession
    n = distinct.count()
    share = min(1.0, sample_rows / max(n, 1))
    sample = distinct.where(F.pmod(F.xxhash64(fp, F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample_rows)
    seen = sample.select(fp).toPandas()[fp].to_numpy(np.int64)
    leaf = max(16, int(leaf_rows * len(seen) / max(n, 1)))
    trees = spark.sparkContext.broadcast([fit_tree(p, leaf, radius) for p in halves(seen)])   # a few times SAMPLE / 16 nodes at most

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _gathered(batches, GATHER):
            x = b.column(0).to_numpy()
            for k, p in enumerate(halves(x)):
                i, at = route(trees.value[k], p, radius)
                yield pa.record_batch([pa.array(x[i]), pa.array(at * HALVES + k, pa.int64())], names=["x", "shard"])

    rows = stage(map_arrow(distinct.select(fp), visit, "x long, shard long"), "vp-visits")
    done = None
    while True:
        large = stage(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 2 * leaf_rows), "vp-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        big = rows.join(large, "shard")
        found = stage(_subtrees(big, radius, leaf_rows), "vp-subtrees")
        splits = found.where(F.length("nodes") > 0)
        if splits.isEmpty():
            return rows if done is None else done.unionByName(rows)
        ended = rows.join(splits.select("shard"), "shard", "left_anti")
        done = ended if done is None else done.unionByName(ended)
        rows = stage(_descended(big.join(splits.select("shard"), "shard", "left_semi"), splits, radius), "vp-visits")


def linked_fingerprints(distinct: DataFrame, fp: str, max_distance: int = 3, sample_rows: int = SAMPLE, leaf_rows: int = LEAF) -> DataFrame:
    """Spanning links (x, y) of the distinct long fingerprints in ``fp``."""
    visits = shards(distinct, fp, max_distance // HALVES, sample_rows, leaf_rows)
    cells = dealt_cells(split_groups(visits, "shard", "x", 2 * leaf_rows).select("cell", "side", "x"), "side", "x")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in sorted_groups(batches, "cell"):
            x = t.column("x").to_numpy()
            u = x.view(np.uint64)
            i, j = close_pairs(u, t.column("side").to_numpy(), max_distance)
            root = local_forest(len(x), i, j)
            child = np.flatnonzero(root != np.arange(len(x)))
            if len(child):
                yield pa.record_batch([pa.array(x[child]), pa.array(x[root[child]])], names=["x", "y"])

    return map_arrow(cells, link, "x long, y long")


def close_pairs(u: np.ndarray, side: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell within the distance, compared in blocks."""
    rows, cols, same = meeting(side)
    out_i, out_j = [], []
    for at in range(0, len(rows), 1024):
        r = rows[at:at + 1024]
        a, b = np.nonzero(np.bitwise_count(u[r][:, None] ^ u[cols][None, :]) <= max_distance)
        a, b = r[a], cols[b]
        keep = (a < b) | (not same)
        out_i.append(a[keep])
        out_j.append(b[keep])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, int),) * 2


def fingerprint_components(fps: DataFrame, fp: str, id_col: str, max_distance: int = 3) -> DataFrame:
    """(fp, component, component_id) of every distinct fingerprint of a
    staged table: a label, and the smallest id of all documents linked."""
    distinct = stage(fps.groupBy(fp).agg(F.min(id_col).alias("_rep")), "fingerprints")
    comp = components(linked_fingerprints(distinct, fp, max_distance), "x", "y").withColumnRenamed("node", fp)
    named = distinct.join(comp, fp, "left").withColumn("component", F.coalesce("component", fp))
    low = named.groupBy("component").agg(F.min("_rep").alias("component_id"))
    return named.select(fp, "component").join(low, "component")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       max_distance: int = 3) -> DataFrame:
    """(id, fingerprint, component_id), one row per row of ``docs``."""
    fps = stage(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "fp", "text", words)
                .select("id", "fp"), "simhash")
    found = fps.join(fingerprint_components(fps, "fp", "id", max_distance), "fp")
    return found.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_distance: int = 3) -> DataFrame:
    """``docs`` less all but one row of each component: the row with the
    smallest id (of rows that share it, one) stays.  Columns are unchanged."""
    fp, row, keep = free_name(docs, "_fp"), free_name(docs, "_row"), free_name(docs, "_keep")
    fps = stage(with_fingerprint(docs, fp, text_col, words).withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    slim = fps.select(fp, row, F.col(id_col).alias("_id"))
    named = slim.join(fingerprint_components(slim, fp, "_id", max_distance), fp)
    best = named.groupBy("component").agg(F.min(F.struct(F.col("_id").isNull(), "_id", row))[row].alias(keep))
    prepare(docs.sparkSession)
    return fps.join(best.select(F.col(keep).alias(row)), row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
