"""Substring dedup with a sparse suffix array.

1. Of the suffixes of every text only those at content-selected places are
   kept: words whose ``GRAM``-gram hash is the minimum of a window of
   ``WINDOW`` places (minimisers).  Equal passages select equal places, and
   a passage of ``LEAST`` words has a selected place whose next ``PREFIX``
   words lie inside it.
2. The suffixes of all documents are sorted by the fingerprint of their
   first ``PREFIX`` words, then by document and place (range partitions, so
   a passage that a third of all documents share is spread over many).
   Neighbours are compared in one pass: where the prefix is that of the
   suffix before, the suffix matches the head of the run, which is its
   earliest occurrence.  A run that crosses partitions takes its head from
   the partition where it began (one row per partition is kept for this).
3. Places in runs of more than one suffix are extended: each carries the
   ``AROUND`` words before and behind its prefix.  Within a run, rows that
   share the first d words to the right and the first ``AROUND`` - d words to
   the left, for any d, hold one passage of ``LEAST`` words; all but the
   earliest of them lose it.  Every row is so extended against every other of
   its run, not only against its neighbour, by numbering the rows that agree
   up to each word.  So a phrase that stands earlier by itself does not hide
   the longer passage around it, which has an earliest occurrence of its own.
   Runs are put together in tasks; the rows of a run too long for that
   (``RUN``) take part in one aggregate per d, keyed by 128 bits of the same
   words, which has a map-side combine.
4. The extensions of a document's places are united and removed.

Words are what ASCII white space separates, compared by hash: 64 bits of the
prefix and 32 bits of each of the ``AROUND`` words that decide.  Sorted rows
are a fingerprint with its place; texts of documents that have matches move
once, to take the words around their places, and those that lose words again.

Guarantee: a word is removed if, and only if, it lies in a passage of
``LEAST`` words that also stands earlier (by id, then place).

Cases: null and empty texts have no suffixes; rows with one id and
different texts are separate documents (the CRC-32 of the text tells them
apart), rows equal in both are one document and cut alike; a null id sorts
first; an empty table gives an empty result; ``remove_repeats`` keeps all
columns, whatever their names (its own get another name where one is taken).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.llm.common import bounded, free_name, hash_values, map_arrow, mix, prepare, run_hashes, shuffle_partitions, sliding, stage, texts
from reviewlake.llm.sentence_spans import REMOVED

LEAST = 50               # words of a passage
PREFIX = 32              # words of a suffix that are compared by fingerprint
WINDOW = 17              # places of which one is selected: WINDOW + PREFIX - 1 < LEAST
GRAM = 6                 # words that select a place
AROUND = LEAST - PREFIX  # words on either side that a passage around a prefix may have
RUN = 65_536             # rows of a run that one task extends at most
NO_ID = -(1 << 63)       # stands for a null id
_TOKEN = re.compile(r"[^ \t\n\r\v\f]+")
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
#: passages that start at words lo to hi of a document stand earlier, first in f_id
SPAN = np.dtype([("lo", "<i4"), ("hi", "<i4"), ("f_id", "<i8")])


def exact_words(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words per text, hash of every word)."""
    cut = pc.ascii_split_whitespace(texts(col))
    flat, offsets = cut.flatten(), cut.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if not len(flat):
        return np.diff(offsets), np.zeros(0, np.uint64)
    keep = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    enc = flat.filter(keep).dictionary_encode()
    counts = before[offsets[1:]] - before[offsets[:-1]]
    return counts, hash_values(enc.dictionary, 3)[enc.indices.to_numpy()] if len(enc) else np.zeros(0, np.uint64)


def selected(h: np.ndarray) -> np.ndarray:
    """Places whose value is the minimum of some window of WINDOW values."""
    n = len(h)
    pad = np.full(WINDOW - 1, _TOP)
    low = sliding(np.concatenate([pad, h, pad]), WINDOW, np.minimum)      # all windows that touch a place
    return np.flatnonzero(sliding(low, WINDOW, np.maximum)[:n] == h)


def suffixes(counts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, fingerprint) of the kept suffixes."""
    gram, prefix = run_hashes(words, GRAM), run_hashes(words, PREFIX)
    ends = np.cumsum(counts)
    text, place, key = [], [], []
    for t, (lo, hi) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        if hi - lo >= PREFIX:
            p = selected(gram[lo:hi - GRAM + 1])
            p = p[p <= hi - lo - PREFIX]
            text.append(np.full(len(p), t))
            place.append(p)
            key.append(prefix[lo + p])
    if not text:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(text), np.concatenate(place), np.concatenate(key).view(np.int64)


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), text.alias("text"))


def kept_suffixes(source: DataFrame) -> DataFrame:
    """(h, id, crc, place) of the kept suffixes of (id, crc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, 2):
            text, place, key = suffixes(*exact_words(b.column(2)))
            if len(text):
                row = pa.array(text)
                yield pa.record_batch([pa.array(key), b.column(0).take(row), b.column(1).take(row), pa.array(place, pa.int32())],
                                      names=["h", "id", "crc", "place"])

    return map_arrow(source, run, "h long, id long, crc long, place int")


def neighbour_matches(rows: DataFrame) -> DataFrame:
    """Sort the staged fingerprints and match each with the head of its run:
    (id, crc, place, f_id, f_crc, f_place)."""
    spark = rows.sparkSession
    order = ["h", "id", "crc", "place"]
    ranged = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select(*order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, first, last = TaskContext.get().partitionId(), None, None      # last: head of the run that is open
        for b in batches:
            if not b.num_rows:
                continue
            h, i, c, p = (b.column(k).to_numpy() for k in order)
            starts = np.flatnonzero(np.concatenate([[last is None or h[0] != last[0]], h[1:] != h[:-1]]))
            run = np.searchsorted(starts, np.arange(len(h)), "right")         # 0: the run from the batch before
            head = np.array([(*(last or (0, 0, 0, 0))[1:], 0)] + [(i[s], c[s], p[s], 0) for s in starts], np.int64)[run]
            first = first or (int(h[0]), int(i[0]), int(c[0]), int(p[0]))
            if len(starts):
                last = (int(h[-1]), *(int(x[starts[-1]]) for x in (i, c, p)))
            own = np.ones(len(h), bool)
            own[starts] = False
            own |= h == first[0]                       # the run that may have begun in the partition before
            yield _matches(np.zeros(own.sum(), np.int32), part, h[own], i[own], c[own], p[own], *head[own].T[:3])
        if first:
            yield _matches(np.array([1, 2], np.int32), part, *(np.array(x, np.int64) for x in zip(first, last)),
                           *(np.array([0, x]) for x in last[1:]))

    found = stage(map_arrow(ranged, compare, "kind int, part int, h long, id long, crc long, place int, f_id long, f_crc long, f_place int"),
                  "suffix-matches")
    edges = found.where("kind > 0").select("part", "kind", *order).orderBy("part", "kind").collect()    # two rows per partition
    entering, head = [], None
    for r in edges:
        if r["kind"] == 1:
            goes_on = head is not None and head[0] == r["h"]
            if goes_on:
                entering.append((r["part"], *head))
            start = r["h"] if goes_on else None
        elif r["h"] != start:                           # the last run began in this partition
            head = (r["h"], r["id"], r["crc"], r["place"])
    joined = found.where("kind = 0").join(F.broadcast(_carried(spark, entering)), ["part", "h"], "left")   # a row per partition at most
    out = joined.select("id", "crc", "place", *(F.coalesce(f"g_{x}", f"f_{x}").alias(f"f_{x}") for x in ("id", "crc", "place")))
    return out.where("id <> f_id or crc <> f_crc or place <> f_place")


def _carried(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Heads that runs bring into a partition.  Given as an Arrow table: a list
    of tuples would pass through Python workers of another kind than those of
    ``mapInArrow``, and both kinds stay in every executor's memory."""
    schema = pa.schema([("part", pa.int32()), ("h", pa.int64()), ("g_id", pa.int64()), ("g_crc", pa.int64()), ("g_place", pa.int32())])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema))


def _matches(kind, part, h, i, c, p, f_i, f_c, f_p) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int64(), pa.int32())
    cols = (kind, np.full(len(h), part, np.int32), h, i, c, np.asarray(p, np.int32), f_i, f_c, np.asarray(f_p, np.int32))
    return pa.record_batch([pa.array(x, t) for x, t in zip(cols, kinds)],
                           names=["kind", "part", "h", "id", "crc", "place", "f_id", "f_crc", "f_place"])


def surroundings(texts_: DataFrame) -> DataFrame:
    """(h, id, crc, place, behind, around) of the places ``at`` of the staged
    (id, crc, text, at): the prefix's fingerprint, how many words stand behind
    it (AROUND at most), and 32 bits of each word around it, nearest first,
    those to the left before those to the right."""
    step = np.arange(AROUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, 2):
            counts, words = exact_words(b.column(2))
            at = b.column(3)
            place = at.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(at).to_numpy())
            if not len(place):
                continue
            g, behind = (np.cumsum(counts) - counts)[row] + place, np.minimum(counts[row] - place - PREFIX, AROUND)
            short = np.append((words >> np.uint64(32)).astype(np.uint32), np.uint32(0))     # the last: no word
            left = np.where(step < place[:, None], g[:, None] - 1 - step, len(words))
            right = np.where(step < behind[:, None], g[:, None] + PREFIX + step, len(words))
            around = np.ascontiguousarray(short[np.concatenate([left, right], axis=1)], "<u4")
            packed = pa.Array.from_buffers(pa.binary(8 * AROUND), len(place), [None, pa.py_buffer(around)]).cast(pa.binary())
            yield pa.record_batch([pa.array(run_hashes(words, PREFIX)[g].view(np.int64)), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                                   pa.array(place, pa.int32()), pa.array(behind, pa.int32()), packed],
                                  names=["h", "id", "crc", "place", "behind", "around"])

    return map_arrow(texts_.select("id", "crc", "text", "at"), run, "h long, id long, crc long, place int, behind int, around binary")


def _around(col) -> tuple[np.ndarray, np.ndarray]:
    """The words to the left and to the right of some rows."""
    m = np.frombuffer(b"".join(col.to_pylist()), "<u4").reshape(-1, 2 * AROUND)
    return m[:, :AROUND], m[:, AROUND:]


def _agreeing(run: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """Entry d: equal numbers for the rows of one run that share d words."""
    out = [run]
    for w in words.T:
        out.append(np.unique(out[-1].astype(np.uint64) << np.uint64(32) | w, return_inverse=True)[1])
    return out


def earliest(run: np.ndarray, left: np.ndarray, right: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """For rows in ascending order of place within their run, and each number
    j of words to the left: the row with the earliest equal passage of LEAST
    words that starts j words before the prefix; -1 if that is the row itself
    or its text has no such passage."""
    on_left, on_right = _agreeing(run, left), _agreeing(run, right)
    head = np.full((len(run), AROUND + 1), -1, np.int64)
    for j in range(AROUND + 1):
        has = np.flatnonzero((before >= j) & (behind >= AROUND - j))
        key = on_left[j][has].astype(np.uint64) << np.uint64(32) | on_right[AROUND - j][has].astype(np.uint64)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        head[has, j] = np.where(has[first][which] == has, -1, has[first][which])
    return head


def whole_runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches sorted by ``h`` as tables of about ``rows`` rows that hold
    their runs of equal ``h`` whole."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            t = pa.Table.from_batches(held)
            h = t.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield t.slice(0, cut)
            held, n = t.slice(cut).to_batches(), n - cut
    if n:
        yield pa.Table.from_batches(held)


def packed(id_: np.ndarray, crc: np.ndarray, lo: np.ndarray, hi: np.ndarray, f_id: np.ndarray) -> pa.RecordBatch:
    """Spans of some documents, a row (id, crc, spans) for each document."""
    order = np.lexsort((lo, crc, id_))
    i, c = id_[order], crc[order]
    new = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (c[1:] != c[:-1])])[:len(i)])
    spans = np.empty(len(i), SPAN)
    for name, x in (("lo", lo), ("hi", hi), ("f_id", f_id)):
        spans[name] = x[order]
    ends = (np.append(new, len(i)) * SPAN.itemsize).astype(np.int32)
    rows = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(ends), pa.py_buffer(spans)])
    return pa.record_batch([pa.array(i[new]), pa.array(c[new]), rows], names=["id", "crc", "spans"])


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_runs(batches, RUN):
        h, i, crc, place, behind = (t.column(k).to_numpy() for k in ("h", "id", "crc", "place", "behind"))
        run = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
        head = earliest(run, *_around(t.column("around")), place, behind)
        # neighbouring starts with one head are one row: j counts words to the left, so they run downwards
        edge = np.ones((len(h), AROUND + 2), bool)
        edge[:, 1:-1] = head[:, 1:] != head[:, :-1]
        r, j = np.nonzero(edge[:, :-1])
        stop = np.nonzero(edge[:, 1:])[1]
        keep = head[r, j] >= 0
        r, j, stop = r[keep], j[keep], stop[keep]
        if len(r):
            yield packed(i[r], crc[r], place[r] - stop, place[r] - j, i[head[r, j]])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            yield packed(*(b.column(k).to_numpy() for k in ("id", "crc", "lo", "hi", "f_id")))


def _extended_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of long runs once for each j: two hashes of the passage."""
    for b in batches:
        left, right = _around(b.column("around"))
        place, behind, h = b.column("place").to_numpy(), b.column("behind").to_numpy(), b.column("h").to_numpy().view(np.uint64)
        a, g = ([[mix(h + np.uint64(s))] for _ in range(2)] for s in (1, 2))
        with np.errstate(over="ignore"):
            for folds in (a, g):
                for k, words in enumerate((left, right)):
                    out = folds[k]
                    for w in words.T:
                        out.append(mix(out[-1] + w))
        for j in range(AROUND + 1):
            has = np.flatnonzero((place >= j) & (behind >= AROUND - j))
            if len(has):
                with np.errstate(over="ignore"):
                    ka, kg = (mix(x[0][j][has] + mix(x[1][AROUND - j][has] + np.uint64(j))) for x in (a, g))
                rows = pa.array(has)
                yield pa.record_batch([pa.array(ka.view(np.int64)), pa.array(kg.view(np.int64)), b.column("id").take(rows), b.column("crc").take(rows),
                                       b.column("place").take(rows), pa.array(np.full(len(has), j), pa.int32())],
                                      names=["a", "g", "id", "crc", "place", "j"])


def extensions(rows: DataFrame, run_rows: int = RUN) -> DataFrame:
    """(id, crc, spans) of the staged surroundings: the passages of a document
    that stand earlier, as bytes (``SPAN``), in a row for each document that a
    task has at a time.  Rows of one span each would be objects in the heap of
    the aggregate that puts a document's spans together."""
    n = shuffle_partitions(rows.sparkSession)
    long_runs = stage(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > run_rows).select("h"), "suffix-long-runs")
    order = ["h", "id", "crc", "place"]
    whole = rows.join(long_runs, "h", "left_anti").repartition(n, "h").sortWithinPartitions(*order)
    out = map_arrow(whole, _extend, "id long, crc long, spans binary")
    if long_runs.isEmpty():
        return out
    keyed = stage(map_arrow(rows.join(long_runs, "h"), _extended_keys, "a long, g long, id long, crc long, place int, j int"), "suffix-long")
    at = F.struct("id", "crc", "place")
    first = stage(keyed.groupBy("a", "g").agg(F.min(at).alias("f"), F.max(at).alias("l")).where("f <> l").select("a", "g", "f"), "suffix-heads")
    start = F.col("place") - F.col("j")
    later = keyed.join(first, ["a", "g"]).where(at != F.col("f"))
    spans = later.select("id", "crc", start.alias("lo"), start.alias("hi"), F.col("f.id").alias("f_id"))
    return out.unionByName(map_arrow(spans, _pack, "id long, crc long, spans binary"))


def without(text: str, ranges: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the word ranges, and the character ranges taken out
    (each with the white space behind it)."""
    at = [m.start() for m in _TOKEN.finditer(text)] + [len(text)]
    gone = [(at[lo], at[hi]) for lo, hi in ranges]
    out, last = [], 0
    for lo, hi in gone:
        out.append(text[last:lo])
        last = hi
    return "".join([*out, text[last:]]), gone


def united(spans: pa.ListArray) -> tuple[list[list[tuple[int, int]]], list[list[int]]]:
    """For each row's passages (lists of packed spans): the word ranges that
    they cover, and the documents that hold the earliest passage of some start
    (a place that not every occurrence selects may know a later one only)."""
    each, top = spans.flatten(), np.iinfo(np.int64).max
    flat = np.frombuffer(b"".join(each.to_pylist()), SPAN)
    lo, size, f = flat["lo"].astype(np.int64), flat["hi"] - flat["lo"] + 1, flat["f_id"]
    n, row = len(spans), np.repeat(np.arange(len(spans)), pc.list_value_length(spans).to_numpy())
    row = np.repeat(row, pc.binary_length(each).to_numpy() // SPAN.itemsize)
    low, high = np.full(n, top), np.full(n, -1)
    np.minimum.at(low, row, lo)
    np.maximum.at(high, row, flat["hi"].astype(np.int64))
    starts = np.where(high < 0, 0, high - low + 1)
    base = np.cumsum(starts) - starts
    first, at = np.full(int(starts.sum()), top), base[row] + lo - low[row]
    for k in range(size.max(initial=0)):               # a span has at most AROUND + 1 starts
        more = size > k
        np.minimum.at(first, at[more] + k, f[more])
    at = np.flatnonzero(first < top)
    owner = np.repeat(np.arange(n), starts)[at]
    start = at - base[owner] + low[owner]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (np.diff(start) > LEAST)])[:len(at)])
    last = np.append(new[1:], len(at))[:len(new)] - 1
    ranges: list = [[] for _ in range(n)]
    for r, x, y in zip(owner[new].tolist(), start[new].tolist(), (start[last] + LEAST).tolist()):
        ranges[r].append((x, y))
    firsts: list = [[] for _ in range(n)]
    order = np.lexsort((first[at], owner))
    o, f = owner[order], first[at][order]
    other = np.concatenate([[True], (o[1:] != o[:-1]) | (f[1:] != f[:-1])])[:len(o)] & (f != NO_ID)
    for r, x in zip(o[other].tolist(), f[other].tolist()):
        firsts[r].append(x)
    return ranges, firsts


def changed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN) -> DataFrame:
    """(id, crc, text, removed, first_ids) of the documents that lose words."""
    prepare(docs.sparkSession)
    source = _sources(docs, id_col, text_col)
    matches = neighbour_matches(stage(kept_suffixes(source), "suffixes"))
    places = matches.select("id", "crc", "place").union(matches.select("f_id", "f_crc", "f_place"))
    at = stage(places.groupBy("id", "crc").agg(F.collect_set("place").alias("at")), "suffix-places")
    some = stage(source.join(at, ["id", "crc"]).dropDuplicates(["id", "crc"]), "suffix-texts")
    again = extensions(stage(surroundings(some), "suffix-surroundings"), run_rows)
    per_doc = again.groupBy("id", "crc").agg(F.collect_list("spans").alias("spans"))
    cases = some.select("id", "crc", "text").join(per_doc, ["id", "crc"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, 2):
            new, gone = [], []
            words, firsts = united(b.column(3))
            for text, ranges in zip(b.column(2).to_pylist(), words):
                t, ranges = without(text, ranges)
                new.append(t)
                gone.append([{"start": lo, "end": hi} for lo, hi in ranges])
            yield pa.record_batch([b.column(0), b.column(1), pa.array(new, pa.string()),
                                   pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                                   pa.array(firsts, pa.list_(pa.int64()))], names=["id", "crc", "text", "removed", "first_ids"])

    fields = [T.StructField("id", T.LongType()), T.StructField("crc", T.LongType()), T.StructField("text", T.StringType()), *REMOVED.fields]
    return map_arrow(cases, cut, T.StructType(fields)).withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages removed from ``text_col``, and columns
    ``removed`` (array of start, end in the old text, in code points) and
    ``first_ids`` (documents that keep what was removed); a name that ``docs``
    has already gets underscores."""
    changed = stage(changed_texts(docs, id_col, text_col), "suffix-changed")
    names = {x: free_name(docs, f"_{x}") for x in changed.columns}
    changed = changed.select(*[F.col(x).alias(n) for x, n in names.items()])
    crc = F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    out = docs.join(changed, F.col(id_col).cast("long").eqNullSafe(F.col(names["id"])) & (crc == F.col(names["crc"])), "left")
    is_cut = F.col(names["crc"]).isNotNull()
    return out.select(*[F.when(is_cut, F.col(names["text"])).otherwise(F.col(x)).alias(x) if x == text_col else F.col(f"`{x}`") for x in docs.columns],
                      F.coalesce(names["removed"], F.array().cast(REMOVED["removed"].dataType)).alias(free_name(docs, "removed")),
                      F.coalesce(names["first_ids"], F.array().cast("array<long>")).alias(free_name(docs, "first_ids")))
