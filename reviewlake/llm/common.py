"""Helpers shared by the operators: session settings, staged tables, and
Arrow-batch text helpers that run inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.session import scratch_path, ship_package

# Bytes and rows of text that one Arrow batch may carry into a Python task:
# bounds a task's memory whatever the length of the documents.
BATCH_BYTES = "4m"
BATCH_ROWS = "4096"


def prepare(spark: SparkSession) -> None:
    """Session settings every operator with a Python stage relies on."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    ship_package(spark)


def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the table, and several
    consumers share one computation (also of non-deterministic ids)."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, base: str) -> str:
    """A column name like ``base`` that ``df`` does not use (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def bounded(batches: Iterator[pa.RecordBatch], text: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes of column ``text``,
    for work that needs several times the text's memory."""
    for b in batches:
        total = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy())])
        cuts = np.flatnonzero(np.diff(total // most)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if hi > lo or not b.num_rows:
                yield b.slice(lo, hi - lo)


def texts(col: pa.Array) -> pa.Array:
    """A string array without nulls (null: empty)."""
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "")


def words_of(col: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Lower-cased letter-and-digit words of each text.

    Returns the word count of each text and all words, dictionary-encoded
    (so that per-word work is done once per distinct word of the batch)."""
    flat = pc.split_pattern_regex(pc.utf8_lower(texts(col)), pattern=r"[^\pL\pN]+")
    values, offsets = flat.flatten(), flat.offsets.to_numpy()
    keep = pc.not_equal(values, "")
    kept = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    counts = kept[offsets[1:] - offsets[0]] - kept[offsets[:-1] - offsets[0]]
    return counts.astype(np.int64), values.filter(keep).dictionary_encode()


def hash_values(values: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each string of a (small) dictionary, as uint64."""
    import xxhash
    f = xxhash.xxh64_intdigest
    return np.fromiter((f(v, seed) for v in values.to_pylist()), np.uint64, len(values))


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words per text, 64-bit hash of every word in order)."""
    counts, enc = words_of(col)
    return counts, hash_values(enc.dictionary)[enc.indices.to_numpy()] if len(enc) else np.zeros(0, np.uint64)


_MULT = np.uint64(0x9E3779B97F4A7C15)   # odd 64-bit multiplier (golden ratio)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def run_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (len(h) - k + 1).

    Built by doubling, so a run of k costs log2(k) passes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc, have, power, size, at = None, 0, h.copy(), 1, k
        base = int(_MULT)
        while at:
            if at & 1:
                part = power[have:have + n]
                if acc is None:
                    acc = part.copy()
                else:
                    acc = acc * np.uint64(pow(base, size, 1 << 64)) + part
                have += size
            at >>= 1
            if at:
                power = power[:len(power) - size] * np.uint64(pow(base, size, 1 << 64)) + power[size:]
                size *= 2
        return mix(acc)


def sliding(h: np.ndarray, width: int, pick) -> np.ndarray:
    """Extreme (``pick``: np.minimum or np.maximum) of every ``width`` consecutive values, by doubling."""
    have, out = 1, h
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Runs of equal ``key`` (a non-null integer column) in sorted batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if held and k[lo] != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = int(k[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield held_key, pa.Table.from_batches(held)


def split_groups(rows: DataFrame, group: str, member: str, size: int) -> DataFrame:
    """Deal groups out so that every two members of a group still meet.

    Adds ``cell`` (long) and ``side`` (int).  A group of up to ``size`` rows
    is one cell.  A larger group is dealt by a hash of ``member`` into k
    chunks; each chunk is a cell (``side`` 2: all its rows meet) and so are
    each two chunks (rows of ``side`` 0 meet those of side 1).  A pair of
    rows meets in exactly one cell."""
    k = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")) \
            .select(group, F.ceil(F.col("_n") / F.lit(size)).cast("int").alias("_k")).where("_k > 1")
    own = F.pmod(F.xxhash64(F.col(member), F.lit(11)), F.col("_k")).cast("int")
    cut = rows.join(k, group, "left").withColumn("_k", F.coalesce("_k", F.lit(1))).withColumn("_c", own)
    dealt = cut.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    return dealt.withColumn("side", F.when(F.col("_c") == F.col("_o"), 2).otherwise((F.col("_c") > F.col("_o")).cast("int"))) \
                .withColumn("cell", F.xxhash64(group, F.least("_c", "_o"), F.greatest("_c", "_o"))) \
                .drop("_k", "_c", "_o")


def cell_rows(rows: DataFrame, least: int, most: int = 4096) -> int:
    """Rows that a cell of the staged ``rows`` should hold at most: enough
    cells for all tasks, but no more copies of rows than that takes."""
    return int(min(most, max(least, rows.count() // (4 * shuffle_partitions(rows.sparkSession)))))


def dealt_cells(rows: DataFrame, *also: str) -> DataFrame:
    """``rows`` of ``split_groups`` with whole cells in one task, in order."""
    n = shuffle_partitions(rows.sparkSession)
    return rows.repartition(n, "cell").sortWithinPartitions("cell", *also)


def meeting(side: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """(rows, columns, both the same) of the comparisons that a cell makes."""
    if len(side) and side[0] == 2:
        every = np.arange(len(side))
        return every, every, True
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1), False


def local_forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member index reachable from each of n members over links i-j."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]
    return label
