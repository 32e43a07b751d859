"""Filter interaction audit: what each of several filters removes, in every
order in which they can be applied.

* Every document gets a bit mask of the filters that it fails.  Masks do not
  depend on the order, so they are counted once per part (``mask_counts``).
* All coalitions of filters are tabulated from these counts: v(S) is the
  number of documents that at least one filter of S fails (``coalitions``).
* Step counts are differences of coalitions: after the filters P, filter f
  removes v(P + f) - v(P), and so on (``step_counts``).
* Shapley values are the exact solution of the least squares problem
  ``min sum_S w(S) (v(S) - sum of phi over S)^2`` with the Shapley kernel w
  under the constraint that phi adds up to v(all).  Its normal equations do
  not depend on the data; they are solved in rationals once for each
  coalition on the right-hand side (``shapley_weights``), and Spark applies
  the solution to each part's table.  Times n! they are integers.

What moves is one slim row per document (id, digest) and then counts: no
text is shuffled.  Equal texts are found by SHA-256; copies collapse before
the shuffle, so a text in a third of all rows is a row per task.

Cases: a null text counts as empty; a null part is the part of the empty
string; a row with a null id is neither a copy nor an original, and has no
label; rows with equal id and text are no copies of each other; of several
labels of an id the largest counts; documents without label are neither
good nor toxic; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import bounded, map_arrow, stage, texts

FILTERS = "ABCDE"        # short, repetitive, upper case, symbols, copy
MOST_FILTERS = 6         # 720 orders: the table of steps stays under 4,320 rows


# --- conditions -------------------------------------------------------------

def text_masks(col: pa.Array, words: int = 200, distinct: int = 50, upper: int = 3, symbols: str = "#$%&*|") -> np.ndarray:
    """Bits A (1), B (2), C (4), D (8) that each text fails."""
    t = texts(col)
    split = pc.ascii_split_whitespace(t)
    values, offsets = split.flatten(), split.offsets.to_numpy()
    real = pc.not_equal(values, "")
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    n = np.diff(kept[offsets - offsets[0]])
    enc = values.filter(real).dictionary_encode()
    pairs = np.unique(np.repeat(np.arange(len(t)), n) * max(len(enc.dictionary), 1) + enc.indices.to_numpy())
    kinds = np.bincount(pairs // max(len(enc.dictionary), 1), minlength=len(t))
    capital = pc.count_substring_regex(t, "[A-Z]").to_numpy().astype(np.int64)
    length = pc.utf8_length(t).to_numpy().astype(np.int64)
    marked = np.zeros(len(t), bool)
    for s in symbols:
        marked |= pc.match_substring(t, s).to_numpy(zero_copy_only=False)
    fails = [n < words, 100 * kinds < distinct * n, 100 * capital > upper * length, marked]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def with_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, digest of the text, mask of A to D) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, 1):
            digest = [hashlib.sha256(t.as_buffer() if t.is_valid else b"").digest() for t in b.column(1)]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(digest, pa.binary()), pa.array(text_masks(b.column(1)), pa.int32())],
                                  names=["id", "part", "digest", "mask"])

    return map_arrow(rows, run, f"id {id_type}, part string, digest binary, mask int")


def mask_counts(rows: DataFrame, copy_bit: int) -> DataFrame:
    """(part, mask, n, good, toxic): documents per mask, with ``copy_bit``
    for those whose text a smaller id has anywhere in the table.

    ``rows``: id, part, digest, mask, is_good, is_toxic."""
    alike = ["digest", "part", "mask", "is_good", "is_toxic"]
    one = rows.groupBy("id", *alike).agg(F.count(F.lit(1)).alias("n"))
    grouped = one.groupBy(*alike).agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("at_low"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    grouped = stage(grouped, "audit-texts")
    first = grouped.groupBy("digest").agg(F.min("low").alias("first"))
    originals = F.col("nameless") + F.coalesce(F.when(F.col("low") == F.col("first"), F.col("at_low")), F.lit(0))
    both = F.array(F.struct(F.col("mask"), originals.alias("n")),
                   F.struct(F.col("mask").bitwiseOR(copy_bit).alias("mask"), (F.col("n") - originals).alias("n")))
    split = grouped.join(first, "digest").select("part", "is_good", "is_toxic", F.explode(both).alias("m"))
    n = F.col("m.n")
    return split.where(n > 0).groupBy("part", F.col("m.mask").alias("mask")).agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("is_good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), n).otherwise(0)).alias("toxic"))


# --- coalitions and Shapley values ------------------------------------------

def coalitions(counts: DataFrame, n_filters: int) -> DataFrame:
    """(part, total, table): one row per part.  ``table`` has, in the order
    of the coalitions' bit masks, what each of them removes: all documents,
    good ones and toxic ones."""
    every = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << n_filters) - 1))))
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    summed = every.groupBy("part", "coalition").agg(
        F.sum("n").alias("total"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")])
    return summed.groupBy("part").agg(F.max("total").alias("total"),
                                      F.array_sort(F.collect_list(F.struct("coalition", "n", "good", "toxic"))).alias("table"))


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix`` X = ``right`` by elimination in rationals."""
    n = len(matrix)
    rows = [[*m, *r] for m, r in zip(matrix, right)]
    for k in range(n):
        p = next(i for i in range(k, n) if rows[i][k])
        rows[k], rows[p] = rows[p], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(n):
            if i != k and rows[i][k]:
                by = rows[i][k]
                rows[i] = [x - by * y for x, y in zip(rows[i], rows[k])]
    return [r[n:] for r in rows]


def shapley_weights(n: int) -> list[list[int]]:
    """Integers c with n! phi_f = sum over coalitions S of c[f][S] v(S).

    The stationary point of the constrained least squares is linear in v:
    the kernel-weighted normal equations, bordered by the efficiency
    constraint, are solved for one unit right-hand side per coalition."""
    full = (1 << n) - 1
    inner = [s for s in range(1, full)]
    z = {s: [s >> i & 1 for i in range(n)] for s in inner}
    w = {s: Fraction(n - 1, comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in inner}
    border = [[sum(w[s] * z[s][i] * z[s][j] for s in inner) for j in range(n)] + [Fraction(1)] for i in range(n)]
    border.append([Fraction(1)] * n + [Fraction(0)])
    right = [[Fraction(0)] * (full + 1) for _ in range(n + 1)]
    for s in inner:
        for i in range(n):
            right[i][s] = w[s] * z[s][i]
    right[n][full] = Fraction(1)
    scaled = [[x * factorial(n) for x in row] for row in solve(border, right)[:n]]
    assert all(x.denominator == 1 for row in scaled for x in row)
    return [[int(x) for x in row] for row in scaled]


def steps_table(names: str) -> list[tuple]:
    """(filter_order, step, bit, before, after, weights) of all orders."""
    weights = shapley_weights(len(names))
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(names[k] for k in order), step, 1 << f, before, before | 1 << f, weights[f]))
            before |= 1 << f
    return out


def step_counts(table: DataFrame, names: str) -> DataFrame:
    """A row per part, order and step, from the rows of ``coalitions``."""
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}")
    steps = table.sparkSession.createDataFrame(
        steps_table(names), "filter_order string, step int, bit int, before int, after int, weights array<long>")
    at = F.broadcast(steps)                                    # n! n rows: 600 for five filters
    each = table.select("part", "total", "table", F.posexplode("table").alias("after", "now"))
    j = each.join(at, "after").withColumn("was", F.col("table")[F.col("before")])
    full = (1 << len(names)) - 1
    alone, rest = F.col("table")[F.col("bit")]["n"], F.col("table")[F.lit(full) - F.col("bit")]["n"]
    removed = F.col("now.n") - F.col("was.n")
    shapley = F.aggregate(F.zip_with("table", "weights", lambda t, w: t["n"] * w), F.lit(0).cast("long"), lambda a, x: a + x)
    return j.select("part", "filter_order", "step", (F.col("total") - F.col("now.n")).alias("kept"), removed.alias("removed"),
                    (alone - removed).alias("redundant"), (F.col("table")[full]["n"] - rest).alias("unique_fails"),
                    (F.col("now.good") - F.col("was.good")).alias("good_lost"),
                    (F.col("now.toxic") - F.col("was.toxic")).alias("toxic_lost"), shapley.alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """The audit of filters A to E over ``docs``; see the module's text."""
    known = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"))
    rows = with_masks(docs, id_col, text_col, part_col).join(known, "id", "left").fillna(False, ["is_good", "is_toxic"])
    counts = mask_counts(rows, copy_bit=1 << FILTERS.index("E"))
    return step_counts(coalitions(counts, len(FILTERS)), FILTERS)
