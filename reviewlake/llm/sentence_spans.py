"""Substring dedup over sliding sentence spans.

From every sentence on, the shortest run of at least ``SPAN`` consecutive
sentences and ``LEAST`` words is hashed; a run that occurs more than once
in the corpus, in whatever documents, is repeated.  Its first
occurrence (by document id, then place) stays; sentences covered by any
other occurrence are removed from their documents.

Sentences end at ``.``, ``!`` or ``?`` before white space, behind a
full-width stop, and at a line break.  A sentence of more than ``LONGEST``
words is cut where its words say so: before each word whose hash is the
smallest of some ``LONGEST`` neighbours.  So a passage without punctuation is
cut alike behind any lead, save within ``LONGEST`` words of its ends.  Words
are what white space separates; a sign of a script that is written without
spaces is a word, and so is each sign of a run of more than ``WORD`` signs
(two words of one sign count as one towards ``LEAST``).  Sentences are
compared word by word, lower-cased.

The rows that move are 128-bit hashes with their place; first occurrences
are a minimum with map-side combine, joined back on the hash, so a passage
that a third of all documents share is split by the skew join.  Texts move
once, joined with the places to cut.

Cases: null and empty texts have no sentences; a text with fewer than
``SPAN`` sentences or ``LEAST`` words has no run; rows with one id and different texts are
separate documents (the CRC-32 of the text tells them apart), rows equal in
both are one document and cut alike; a null id sorts first; an empty table
gives an empty result; ``remove_repeats`` keeps all columns, whatever
their names (its own get another name where one is taken).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import free_name, hash_values, map_arrow, mix, sliding, stage, texts

SPAN = 3                 # sentences of a run at least
LONGEST = 16             # words of a sentence at most
LEAST = 20               # words of a run at least
WORD = 32                # signs of a word at most
#: Columns that tell what was removed.
REMOVED = T.StructType([
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("first_ids", T.ArrayType(T.LongType())),
])
_END = re.compile(r"[.!?]+(?=\s)|[\u3002\uff01\uff1f\uff0e]+|\n")
#: Scripts written without spaces: Thai and Lao, Burmese, Khmer, kana, Han.
_UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(f"[{_UNSPACED}]|[^\\s{_UNSPACED}]+")


def _parts(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what lies between two stops."""
    at = 0
    for m in _END.finditer(text):
        yield at, m.end()
        at = m.end()
    yield at, len(text)


def word_spans(part: str) -> list[tuple[int, int]]:
    """(start, end) of every word."""
    out = []
    for m in _WORD.finditer(part):
        lo, hi = m.span()
        out += [(lo, hi)] if hi - lo <= WORD else [(k, k + 1) for k in range(lo, hi)]
    return out


def words_in(part: str, unspaced: bool) -> list[str]:
    """The words; ``unspaced``: the text has signs of unspaced scripts."""
    plain = part.split()
    if unspaced or max(map(len, plain), default=0) > WORD:
        return [part[lo:hi] for lo, hi in word_spans(part)]
    return plain


def has_unspaced(text: str) -> bool:
    return not text.isascii() and _HAS_UNSPACED.search(text) is not None


def word_count(words: list[str]) -> int:
    """Words of a sentence, two words of one sign as one."""
    return len(words) - list(map(len, words)).count(1) // 2


def _cuts(long: list[list[str]]) -> list[list[int]]:
    """For each long sentence the words before which it is cut: those whose
    hash is the smallest of LONGEST neighbours, all in the sentence."""
    if not long:
        return []
    size = np.array([len(w) for w in long])
    enc = pa.array([x for w in long for x in " ".join(w).lower().split(" ")], pa.large_string()).dictionary_encode()
    h, owner = hash_values(enc.dictionary, 1)[enc.indices.to_numpy()], np.repeat(np.arange(len(long)), size)
    low = sliding(h, LONGEST, np.minimum)
    low[owner[LONGEST - 1:] != owner[:len(low)]] = 0        # a window that leaves the sentence selects nothing
    pad = np.zeros(LONGEST - 1, np.uint64)
    first = np.cumsum(size) - size
    at = np.flatnonzero(sliding(np.concatenate([pad, low, pad]), LONGEST, np.maximum) == h)
    at = np.setdiff1d(at, first)
    edge = np.searchsorted(at, np.concatenate([first, [len(h)]]))
    return [(at[lo:hi] - f).tolist() for lo, hi, f in zip(edge[:-1], edge[1:], first)]


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of every sentence, white space around it left out."""
    unspaced, parts = has_unspaced(text), []
    for lo, hi in _parts(text):
        words = words_in(text[lo:hi], unspaced)
        if words:
            parts.append((lo, hi, words))
    cuts, out = iter(_cuts([w for _, _, w in parts if len(w) > LONGEST])), []
    for lo, hi, words in parts:
        if len(words) > LONGEST:
            at = word_spans(text[lo:hi])
            edges = [0, *next(cuts), len(words)]
            out += [(lo + at[x][0], lo + at[y - 1][1]) for x, y in zip(edges, edges[1:])]
        else:
            part = text[lo:hi]
            out.append((lo + len(part) - len(part.lstrip()), lo + len(part.rstrip())))
    return out


def run_ends(words: np.ndarray) -> np.ndarray:
    """For each sentence (given its words) the end of the run that starts
    there: the shortest with SPAN sentences and LEAST words.  It may lie
    beyond the last sentence."""
    total = np.concatenate([[0], np.cumsum(words)])
    return np.maximum(np.searchsorted(total, total[:-1] + LEAST), np.arange(len(words)) + SPAN)


def run_keys(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, two 64-bit hashes) of each run of the texts; a run's
    place is the number of the sentence that it starts with."""
    import xxhash
    parts, count = [], []
    for text in batch:
        unspaced, before = has_unspaced(text), len(parts)
        parts += [w for lo, hi in _parts(text) if (w := words_in(text[lo:hi], unspaced))]
        count.append(len(parts) - before)
    cuts, h, n, per_part = iter(_cuts([w for w in parts if len(w) > LONGEST])), [], [], []
    for words in parts:
        edges = [0, *next(cuts), len(words)] if len(words) > LONGEST else [0, len(words)]
        per_part.append(len(edges) - 1)
        for x, y in zip(edges, edges[1:]):
            some = words[x:y]
            n.append(word_count(some))
            h.append(xxhash.xxh128_digest(" ".join(some).lower().encode("utf-8", "surrogatepass")))
    owner = np.repeat(np.repeat(np.arange(len(batch)), count), per_part)
    last = np.searchsorted(owner, np.arange(len(batch)), "right")
    end = run_ends(np.array(n, np.int64))
    start = np.flatnonzero(end <= last[owner]) if len(owner) else np.zeros(0, np.int64)
    h, size = np.frombuffer(b"".join(h), "<u8").reshape(-1, 2), end[start] - start
    keys = np.zeros((len(start), 2), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(int(size.max(initial=0))):     # the k-th sentence of all runs that have one
            more = np.flatnonzero(size > k)
            keys[more] = mix(keys[more] + h[start[more] + k] + np.uint64(k))
    text = owner[start] if len(start) else start
    return text, start - np.searchsorted(owner, text), keys.view(np.int64)


def without(text: str, runs: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the sentences of the numbered runs, and the character
    ranges taken out of it (each with the white space behind it)."""
    spans, unspaced = sentences(text), has_unspaced(text)
    end = run_ends(np.array([word_count(words_in(text[lo:hi], unspaced)) for lo, hi in spans], np.int64))
    cut = np.zeros(len(spans), bool)
    for k in runs:
        cut[k:end[k]] = True
    ranges: list[tuple[int, int]] = []
    for k in np.flatnonzero(cut).tolist():
        lo, hi = spans[k][0], spans[k + 1][0] if k + 1 < len(spans) else len(text)
        if ranges and ranges[-1][1] == lo:
            ranges[-1] = (ranges[-1][0], hi)
        else:
            ranges.append((lo, hi))
    out, at = [], 0
    for lo, hi in ranges:
        out.append(text[at:lo])
        at = hi
    return "".join([*out, text[at:]]), ranges


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, crc, place, first_id) of every run that is not the first of its kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, place, key = run_keys(texts(b.column(1)).to_pylist())
            if len(row):
                row = pa.array(row)
                yield pa.record_batch([pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()), b.column(0).take(row), b.column(2).take(row),
                                       pa.array(place, pa.int32())], names=["h", "g", "id", "crc", "place"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
                 .withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    rows = stage(map_arrow(source, run, "h long, g long, id long, crc long, place int"), "sentence-runs")
    first = rows.groupBy("h", "g").agg(F.min(F.struct("id", "crc", "place")).alias("f"), F.max(F.struct("id", "crc", "place")).alias("l")) \
                .where(~F.col("f").eqNullSafe(F.col("l"))).select("h", "g", "f")
    first = stage(first, "repeated-runs")          # joined as a table of its own, a hot hash can be split
    return rows.join(first, ["h", "g"]).where(~F.struct("id", "crc", "place").eqNullSafe(F.col("f"))) \
               .select("id", "crc", "place", F.col("f.id").alias("first_id")).distinct()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", changed_only: bool = False) -> DataFrame:
    """``docs`` with repeated sentences removed from ``text_col``, and columns
    ``removed`` (array of start, end in the old text, in code points) and
    ``first_ids`` (documents that keep what was removed); a name that ``docs``
    has already gets underscores."""
    cuts = repeated_runs(docs, id_col, text_col).groupBy("id", "crc") \
        .agg(F.collect_list("place").alias("places"), F.array_sort(F.collect_set("first_id")).alias("first_ids"))
    i, c, p, f = (free_name(docs, x) for x in ("_id", "_crc", "_places", "_firsts"))
    cuts = cuts.select(F.col("id").alias(i), F.col("crc").alias(c), F.col("places").alias(p), F.col("first_ids").alias(f))
    on = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")) == F.col(c))
    joined = docs.join(cuts, on, "inner" if changed_only else "left").drop(i, c)
    names, at, n = docs.columns, docs.columns.index(text_col), len(docs.columns)
    added = [free_name(docs, x.name) for x in REMOVED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = list(b.columns[:n])
            new, gone = [], []
            for text, places in zip(cols[at].to_pylist(), b.column(n).to_pylist()):
                t, ranges = without(text, places) if places else (text, [])
                new.append(t)
                gone.append([{"start": lo, "end": hi} for lo, hi in ranges])
            cols[at] = pa.array(new, pa.string())
            yield pa.record_batch([*cols, pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                                   b.column(n + 1)], names=[*names, *added])

    schema = docs.select(*[F.col(f"`{x}`").cast("string") if x == text_col else F.col(f"`{x}`") for x in names]).schema
    schema = T.StructType([*schema.fields, *(T.StructField(x, f.dataType) for x, f in zip(added, REMOVED))])
    return map_arrow(joined, run, schema)
