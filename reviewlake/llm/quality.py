"""Quality classifier: random indexing, pooling, a two-layer network.

1. Random indexing.  Every token is hashed into one of ``BUCKETS`` buckets,
   and every bucket has a sparse ternary index vector.  A bucket's word
   vector is the sum of the index vectors around its occurrences (two
   tokens on either side, and its own), taken over *all* documents: each
   task sums its share and sends packed blocks of the table, which are
   added up by block.  The table's size is fixed by ``BUCKETS`` and ``DIMS``
   (about 8 MB), however large the corpus.
2. Pooling.  A document is the frequency-damped mean and spread of its
   tokens' vectors, over its whole text.
3. Network.  Two numpy layers are trained on at most ``sample`` labelled
   rows (those with the smallest hash of id and text; the bound is a
   parameter), and a temperature fitted on the part of them that the
   training did not see calibrates the probabilities.

Tokens are words, numbers and runs of symbols; a token that repeats the one
before it is followed by a mark, so that repetition has a vector too.  Only
the text is an input of a score.

Cases: a null or empty text pools to zeros and gets the score of that
point; rows that repeat an id each give a row; labels that are null, other
than 0 or 1, or contradict each other for one id are not trained on; with no
usable label every score is 0.5; an empty table gives an empty result;
``filter_quality`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import hash_values, map_arrow, prepare, shuffle_partitions, texts

BUCKETS = 1 << 15        # word buckets of the vector table
DIMS = 64                # dimensions of a word vector
NONZERO = 4              # entries of an index vector
WINDOW = 2               # tokens on either side that make up a context
BLOCK = 64               # buckets that travel together when tables are added
SAMPLE = 20_000          # labelled rows that the network is trained on at most
DAMPING = 1e-3           # token frequency at which a token's weight is a half


def tokens_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per text, bucket of every token)."""
    t = pc.utf8_lower(texts(col))
    t = pc.replace_substring_regex(t, r"([^\s\pL\pN]+|\pN+)", r" \1 ")
    cut = pc.utf8_split_whitespace(t)
    flat, offsets = cut.flatten(), cut.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if not len(flat):
        return np.diff(offsets), np.zeros(0, np.int64)
    keep = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(keep)])
    counts = before[offsets[1:]] - before[offsets[:-1]]
    enc = flat.filter(pa.array(keep)).dictionary_encode()
    if not len(enc):
        return counts, np.zeros(0, np.int64)
    own = (hash_values(enc.dictionary) % np.uint64(BUCKETS - 1)).astype(np.int64)
    index = enc.indices.to_numpy()
    ids = own[index]
    # mark repeats: bucket BUCKETS - 1 after a token equal to the one before it
    doc = np.repeat(np.arange(len(counts)), counts)
    again = np.flatnonzero((index[1:] == index[:-1]) & (doc[1:] == doc[:-1])) + 1
    return counts + np.bincount(doc[again], minlength=len(counts)), np.insert(ids, again + 1, BUCKETS - 1)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(positions, signs) of every bucket's index vector."""
    rng = np.random.default_rng(11)
    return rng.integers(0, DIMS, (BUCKETS, NONZERO)), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def add_contexts(table: np.ndarray, counts: np.ndarray, ids: np.ndarray, at: np.ndarray, sign: np.ndarray) -> None:
    """Add the contexts of a batch to ``table`` (BUCKETS, DIMS + 1); the last
    column counts tokens."""
    doc = np.repeat(np.arange(len(counts)), counts)
    vectors = np.zeros(BUCKETS * DIMS)
    for o in range(WINDOW + 1):
        near = doc[o:] == doc[:len(doc) - o]
        a, b = ids[:len(ids) - o][near], ids[o:][near]
        for x, y in ((a, b), (b, a))[:1 if o == 0 else 2]:
            for k in range(NONZERO):
                vectors += np.bincount(x * DIMS + at[y, k], sign[y, k], minlength=len(vectors))
    table[:, :DIMS] += vectors.reshape(BUCKETS, DIMS)
    table[:, DIMS] += np.bincount(ids, minlength=BUCKETS)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Weighted unit vectors (float32) of the summed table: directions of the
    contexts less their common direction, weighted by rarity."""
    n = table[:, DIMS]
    v = table[:, :DIMS] / np.maximum(n, 1)[:, None]
    v -= (n @ v) / max(n.sum(), 1)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    weight = DAMPING / (DAMPING + n / max(n.sum(), 1))
    return (v * np.sqrt(weight)[:, None] * (n > 0)[:, None]).astype(np.float32)


def pooled(counts: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """(texts, 2 * DIMS + 1): mean and spread of the token vectors, and the
    share of distinct neighbours."""
    out = np.zeros((len(counts), 2 * DIMS + 1), np.float32)
    ends = np.cumsum(counts)
    for r, (lo, hi) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        if hi > lo:
            word, n = np.unique(ids[lo:hi], return_counts=True)
            v, w = vectors[word], (n / (hi - lo)).astype(np.float32)
            mean = w @ v
            out[r, :DIMS] = mean
            out[r, DIMS:-1] = np.sqrt(np.maximum(w @ (v * v) - mean * mean, 0))
            out[r, -1] = len(word) / (hi - lo)
    return out


@dataclass
class Network:
    """Two layers over standardised inputs, with a calibration temperature."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -50, 50)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 48, epochs: int = 60, seed: int = 3) -> Network:
    """Adam on the logistic loss; the epoch with the least loss on a fifth of
    the rows is kept, and the temperature is fitted on that fifth."""
    rng = np.random.default_rng(seed)
    if len(y) < 10 or len(np.unique(y)) < 2:
        p = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
        d = x.shape[1]
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))
    order = rng.permutation(len(y))
    hold, fit = order[:len(y) // 5], order[len(y) // 5:]
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-3
    d = x.shape[1]
    net = Network(mean, scale, rng.standard_normal((d, hidden)) * np.sqrt(2 / d), np.zeros(hidden),
                  rng.standard_normal(hidden) * np.sqrt(1 / hidden), 0.0)
    p = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    z = np.clip((x - mean) / scale, -8, 8)
    best = (np.inf, None)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
            a, t = z[part], y[part]
            pre = a @ p[0] + p[1]
            h = np.maximum(pre, 0)
            e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t) / len(t)
            back = np.outer(e, p[2]) * (pre > 0)
            step += 1
            for k, g in enumerate((a.T @ back + 1e-4 * p[0], back.sum(0), h.T @ e + 1e-4 * p[2], e.sum(keepdims=True))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 2e-3 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        out = np.maximum(z[hold] @ p[0] + p[1], 0) @ p[2] + p[3]
        loss = _loss(out, y[hold])
        if loss < best[0]:
            best = (loss, [a.copy() for a in p])
    p = best[1]
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    out = net.logit(x[hold])
    grid = np.geomspace(0.2, 10, 80)
    net.temperature = float(grid[np.argmin([_loss(out / t, y[hold]) for t in grid])])
    return net


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit))


# --- Spark ------------------------------------------------------------------

def corpus_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The summed context table over all documents (BUCKETS, DIMS + 1)."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        table, (at, sign), zc = np.zeros((BUCKETS, DIMS + 1)), index_vectors(), zstandard.ZstdCompressor(level=1)
        for b in batches:
            add_contexts(table, *tokens_of(b.column(0)), at, sign)
        blocks = table.reshape(-1, BLOCK, DIMS + 1)
        seen = np.flatnonzero(blocks[:, :, DIMS].any(axis=1))
        packed = [zc.compress(blocks[k].astype("<i4").tobytes()) for k in seen]
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(packed, pa.binary())], names=["block", "z"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        dc, held, total = zstandard.ZstdDecompressor(), None, np.zeros((BLOCK, DIMS + 1))

        def row():
            return pa.record_batch([pa.array([held], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["block", "z"])

        for b in batches:
            for block, z in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if block != held:
                    if held is not None:
                        yield row()
                    held, total = block, np.zeros((BLOCK, DIMS + 1))
                total = total + np.frombuffer(dc.decompress(z), "<i4").reshape(BLOCK, DIMS + 1)
        if held is not None:
            yield row()

    spark = docs.sparkSession
    parts = map_arrow(docs.select(F.col(text_col).cast("string").alias("text")), sums, "block long, z binary")
    by_block = parts.repartition(min(BUCKETS // BLOCK, shuffle_partitions(spark)), "block").sortWithinPartitions("block")
    table = np.zeros((BUCKETS // BLOCK, BLOCK, DIMS + 1))
    for r in map_arrow(by_block, added, "block long, z binary").toLocalIterator():      # BUCKETS / BLOCK rows
        table[r["block"]] = np.frombuffer(r["z"], "<f8").reshape(BLOCK, DIMS + 1)
    return table.reshape(BUCKETS, DIMS + 1)


def held_out(id_col: Column) -> Column:
    """Rows that are never trained on: CRC-32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class QualityModel:
    """Word vectors and network; what a scoring task needs."""
    vectors: np.ndarray
    net: Network

    def scores(self, col: pa.Array) -> np.ndarray:
        return self.net.score(pooled(*tokens_of(col), self.vectors).astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> QualityModel:
    """Word vectors from all ``docs``; network from labelled rows that are not
    held out."""
    spark = docs.sparkSession
    prepare(spark)
    vectors = word_vectors(corpus_table(docs, text_col))
    y = F.col(label_col)
    known = labels.where(~held_out(F.col(id_col)) & y.isin(0, 1)).groupBy(F.col(id_col).alias("id")) \
                  .agg(F.min(y).alias("y"), F.max(y).alias("most")).where("y = most and id is not null")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "y")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
               .join(F.broadcast(chosen), "id").select("id", "text", F.col("y").cast("double").alias("y"))   # at most `sample` rows
    shared = spark.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pooled(*tokens_of(b.column("text")), shared.value)
            crc = [zlib.crc32((t or "").encode("utf-8", "surrogatepass")) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("id").cast(pa.int64()), pa.array(crc, pa.int64()), b.column("y"),
                                   pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "crc", "y", "x"])

    got = map_arrow(rows, pool, "id long, crc long, y double, x binary").orderBy("crc", "id").limit(sample).toPandas()
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), -1).astype(np.float64) if len(got) else np.zeros((0, 2 * DIMS + 1))
    return QualityModel(vectors, train(x, got["y"].to_numpy(float)))


def score_documents(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted), one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array(shared.value.scores(b.column(1)), pa.float64())], names=["id", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = map_arrow(source, run, f"id {docs.select(F.col(id_col)).dtypes[0][1]}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def filter_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(shared.value.scores(b.column(at)) >= threshold))

    return map_arrow(docs, run, docs.schema)
