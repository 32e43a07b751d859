"""Benchmark decontamination: MinHash containment search by size partition.

Finds short test items inside long documents.  A whole document's MinHash
says nothing about an item that is a thousandth of it, so the search is
partitioned by size: items fall into classes of s to 2s shingles, and for
each class a document is a row of windows of 3s shingles, one every s (any
run of up to 2s shingles lies whole in one of them).  An item of which 80 %
lie in a window is then similar enough (Jaccard 0.25 or more) for its
MinHash to meet the window's in at least one of ``HASHES`` functions
(missed with a probability below 1e-4 even at the edge of a class).  Items
of fewer than ``SMALLEST`` shingles are looked up by every shingle instead,
so none is missed.  Where they meet, the item is verified exactly: the share of its distinct shingles
that the whole document holds must reach the threshold.

Items are worked through in blocks of at most ``ITEM_BLOCK``, each of which
is sent to all tasks; a larger benchmark means more blocks, not a larger
broadcast.  Documents are never shuffled, so no source, copy or passage can
make a hot task.

Words are runs of letters and digits, lower-cased; shingles are five words.
Cases: items with fewer than five words (or null) have no shingle and are
never found; a null text contains nothing; rows that repeat an id each give
rows; items with equal texts are each reported, equal rows once; an empty table on either side gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import map_arrow, prepare, run_hashes, word_hashes

WORDS = 5                # words of a shingle
HASHES = 32              # MinHash functions
ITEM_BLOCK = 20_000      # items that are sent to the tasks at a time
SMALLEST = 4             # shingles of an item that MinHash looks for, at least
_BITS = 18               # of the filter in front of the exact look-up


def shingles(counts: np.ndarray, words: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingles per text, all shingle hashes) of consecutive texts."""
    n = np.maximum(counts - k + 1, 0)
    every = run_hashes(words, k)
    starts = np.cumsum(counts) - counts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return n, every[at] if len(at) else np.zeros(0, np.uint64)


def salts(n: int = HASHES) -> np.ndarray:
    return np.random.default_rng(17).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(h: np.ndarray, salt: np.uint64) -> np.ndarray:
    """One MinHash function over all shingle hashes (32 bits)."""
    with np.errstate(over="ignore"):
        return ((h * salt) >> np.uint64(32)).astype(np.uint32)


@dataclass
class ItemIndex:
    """Items of one block: their distinct shingles and, for each size class,
    the MinHash values of its items."""
    ids: list
    sets: list[np.ndarray]
    classes: dict[int, list] = field(default_factory=dict)
    few: tuple | None = None                 # filter, shingles and items of those with fewer than SMALLEST

    @classmethod
    def build(cls, ids: list, texts: pa.Array) -> ItemIndex:
        n, h = shingles(*word_hashes(texts))
        ends = np.cumsum(n)
        sets = [np.unique(h[lo:hi]) for lo, hi in zip(ends - n, ends)]
        index = cls(ids, sets)
        size = np.array([len(s) for s in sets])
        short = np.flatnonzero((size > 0) & (size < SMALLEST))
        if len(short):
            v, of = np.concatenate([sets[i] for i in short]), np.repeat(short, size[short])
            order = np.argsort(v, kind="stable")
            seen = np.zeros(1 << _BITS, bool)
            seen[v >> np.uint64(64 - _BITS)] = True
            index.few = seen, v[order], of[order]
        low = SMALLEST
        while low <= (size.max() if len(size) else 0):
            members = np.flatnonzero((size >= low) & (size < 2 * low))
            if len(members):
                tables = []
                for salt in salts():
                    v = np.array([minhash(sets[i], salt).min() for i in members], np.uint32)
                    order = np.argsort(v, kind="stable")
                    seen = np.zeros(1 << _BITS, bool)
                    seen[v >> np.uint32(32 - _BITS)] = True
                    tables.append((seen, v[order], members[order]))
                index.classes[low] = tables
            low *= 2
        return index

    def candidates(self, n: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) pairs of which a window's MinHash meets the item's, or
        a shingle is that of a short item."""
        if not len(h) or not (self.classes or self.few):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = [self.short(n, h)] if self.few else []
        out += self.by_class(n, h) if self.classes else []
        pairs = np.unique(np.concatenate(out, axis=1), axis=1)
        return pairs[0], pairs[1]

    def short(self, n: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Pairs of a text and a short item that share a shingle."""
        seen, values, members = self.few
        hit = np.flatnonzero(seen[h >> np.uint64(64 - _BITS)])
        return _met(np.searchsorted(np.cumsum(n), hit, "right"), h[hit], values, members)

    def by_class(self, n: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        """Pairs of which a window's MinHash meets the item's, by class and function."""
        base = min(self.classes)
        full = np.flatnonzero(n)
        blocks = -(-n[full] // base)                       # windows of the smallest class share its blocks
        starts = np.cumsum(n[full]) - n[full]
        cut = np.repeat(starts - (np.cumsum(blocks) - blocks) * base, blocks) + np.arange(blocks.sum()) * base
        text = np.repeat(full, blocks)
        levels = sorted(self.classes)
        out = []
        for k, salt in enumerate(salts()):
            low = np.minimum.reduceat(minhash(h, salt), cut)
            of, at = text, base
            for size in levels:
                while at < size:                           # halve the blocks, text by text
                    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
                    place = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
                    heads = np.flatnonzero(place % 2 == 0)
                    low, of, at = np.minimum.reduceat(low, heads), of[heads], at * 2
                window = low.copy()
                for step in (1, 2):
                    if len(low) > step:
                        same = of[step:] == of[:-step]
                        window[:-step][same] = np.minimum(window[:-step][same], low[step:][same])
                seen, values, members = self.classes[size][k]
                hit = np.flatnonzero(seen[window >> np.uint32(32 - _BITS)])
                out.append(_met(of[hit], window[hit], values, members))
        return out


def _met(text: np.ndarray, found: np.ndarray, values: np.ndarray, members: np.ndarray) -> np.ndarray:
    """(text, member) of every value found among the sorted ``values``."""
    lo, hi = np.searchsorted(values, found, "left"), np.searchsorted(values, found, "right")
    met = hi - lo
    which = np.repeat(lo - (np.cumsum(met) - met), met) + np.arange(met.sum())
    return np.stack([np.repeat(text, met), members[which]])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc id, item id, n_item, n_shared, containment) of every document and
    every item of which the document holds ``threshold`` or more."""
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    names = [id_col, item_col, "n_item", "n_shared", "containment"]
    schema = f"`{id_col}` long, `{item_col}` long, n_item long, n_shared long, containment double"
    found = spark.createDataFrame([], schema)
    for index in item_blocks(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = verified(shared.value, b.column(1), threshold)
                yield pa.record_batch([b.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                                       pa.array([shared.value.ids[r[1]] for r in rows], pa.int64()),
                                       *(pa.array([r[k] for r in rows], t) for k, t in ((2, pa.int64()), (3, pa.int64()), (4, pa.float64())))],
                                      names=names)

        found = found.union(map_arrow(source, run, schema))
    return found


def verified(index: ItemIndex, texts: pa.Array, threshold: float) -> list[tuple]:
    """(text, item, shingles of the item, shared ones, containment)."""
    n, h = shingles(*word_hashes(texts))
    text, item = index.candidates(n, h)
    ends, rows = np.cumsum(n), []
    for t in np.unique(text):
        own = np.unique(h[ends[t] - n[t]:ends[t]])
        for i in item[text == t]:
            want = index.sets[i]
            shared = int(np.isin(want, own, assume_unique=True).sum())
            if shared >= threshold * len(want) - 1e-9:
                rows.append((int(t), int(i), len(want), shared, shared / len(want)))
    return rows


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[ItemIndex]:
    """The items in blocks of about ``ITEM_BLOCK`` rows; equal rows count once."""
    slim = items.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).distinct()
    n = slim.count()
    blocks = max(1, -(-n // ITEM_BLOCK)) if n else 0
    for k in range(blocks):
        part = slim.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else slim
        rows = part.orderBy("id", "text").collect()
        yield ItemIndex.build([r["id"] for r in rows], pa.array([r["text"] or "" for r in rows], pa.string()))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item; columns are unchanged."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    prepare(spark)
    clean = docs
    for index in item_blocks(items, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[r[0] for r in verified(shared.value, b.column(at), threshold)]] = False
                yield b.filter(pa.array(keep))

        clean = map_arrow(clean, run, docs.schema)
    return clean
