"""Packing of examples into sequences: vector bin packing.

An example has three demands: tokens, one segment, and loss-bearing tokens;
a sequence limits all three at once.  The dot-product heuristic fills one
sequence at a time: of the examples that still fit it takes the one whose
demand vector (each dimension weighted by its mean demand against its
limit) has the largest dot product with the sequence's remaining capacity.

Texts longer than a sequence are first cut into full sequences and one
remainder; only remainders compete.  They are dealt evenly over groups of a
bounded size by a hash of a staged row number, so no key, source or copy
can swell a group, and each group is packed in its own task.

Cases: a null text is empty and still has its end id; repeated rows are
packed like any other; an example over the limits on its own is refused
with an error (``cut_documents`` never makes one); an empty table gives an
empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import free_name, map_arrow, prepare, stage
from reviewlake.llm.tokens import append_end, encoder

GROUP_EXAMPLES = 8192           # examples that one packing task holds at most, on average


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""
    tokens: int = 1024
    segments: int = 512
    loss: int = 1024


def pack_group(tokens: np.ndarray, loss: np.ndarray, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Dot-product vector bin packing of one group.

    Returns (sequence number, place in it) of every example.  Examples with
    equal demands are interchangeable, so the heuristic works on distinct
    demand vectors with counts."""
    n = len(tokens)
    seq, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return seq, place
    limit = np.array([limits.tokens, limits.segments, limits.loss], float)
    kinds, kind_of = np.unique(np.stack([tokens, np.ones(n, np.int64), loss], axis=1), axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    if (kinds > limit).any():
        raise ValueError("an example exceeds the limits of a sequence")
    demand = kinds / limit
    left = np.bincount(kind_of, minlength=len(kinds))
    alone = np.flatnonzero((demand >= 1).any(axis=1)[kind_of])      # nothing fits beside these
    seq[alone] = np.arange(len(alone))
    left[(demand >= 1).any(axis=1)] = 0
    weighted = demand * ((demand * left[:, None]).sum(axis=0) / n)
    members = np.argsort(kind_of, kind="stable")
    nxt = np.searchsorted(kind_of[members], np.arange(len(kinds)))
    open_seq, spot, room = len(alone), 0, np.ones(3)
    alive = np.flatnonzero(left)
    for _ in range(n - len(alone)):
        fits = alive[(demand[alive] <= room + 1e-12).all(axis=1)]
        if not len(fits):
            open_seq, spot, room = open_seq + 1, 0, np.ones(3)
            fits = alive
        k = fits[np.argmax(weighted[fits] @ room)]
        i = members[nxt[k]]
        seq[i], place[i] = open_seq, spot
        spot += 1
        nxt[k] += 1
        left[k] -= 1
        room = room - demand[k]
        if not left[k]:
            alive = alive[alive != k]
    return seq, place


def assign_sequences(examples: DataFrame, limits: Limits = Limits(), tokens_col: str = "n_tokens",
                     loss_col: str = "n_loss", group_examples: int = GROUP_EXAMPLES) -> DataFrame:
    """``examples`` with ``sequence_id`` (long) and ``offset`` (long).

    ``examples`` should be a staged table: rows are numbered, and a
    recomputation must number them alike."""
    row, grp = free_name(examples, "_row"), free_name(examples, "_group")
    numbered = stage(examples.withColumn(row, F.monotonically_increasing_id()), "pack-rows")
    groups = max(1, math.ceil(numbered.count() / group_examples))
    slim = numbered.select(F.pmod(F.xxhash64(row), F.lit(groups)).alias(grp), F.col(row),
                           F.col(tokens_col).cast("long").alias("t"), F.col(loss_col).cast("long").alias("l"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(row, ignore_index=True)
        seq, place = pack_group(pdf["t"].to_numpy(), pdf["l"].to_numpy(), limits)
        order = np.lexsort((place, seq))
        t = pdf["t"].to_numpy()[order]
        before = np.cumsum(t) - t
        first = np.searchsorted(seq[order], seq[order])
        offset = np.empty(len(pdf), np.int64)
        offset[order] = before - before[first]
        base = int(pdf[grp].iloc[0])
        return pd.DataFrame({row: pdf[row], "sequence_id": seq * groups + base, "offset": offset})

    prepare(examples.sparkSession)
    packed = slim.groupBy(grp).applyInPandas(pack, f"`{row}` long, sequence_id long, offset long")
    return numbered.drop("sequence_id", "offset").join(packed, row).drop(row)


def cut_documents(docs: DataFrame, tokenizer_json: str, end_id: int, max_tokens: int, id_col: str = "doc_id",
                  text_col: str = "text", keeps_space: bool = True, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids of every whole text plus its end
    id: full pieces first, then the remainder.  ``with_ids`` adds the ids."""
    spark = docs.sparkSession
    prepare(spark)
    tok = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tok.value, keeps_space)
        for b in batches:
            n, ids = append_end(*enc.encode(b.column(1)), end_id)
            raw, at = ids.astype("<u4"), np.cumsum(n) - n
            per = -(-n // max_tokens)
            doc = np.repeat(np.arange(len(n)), per)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * max_tokens
            length = np.minimum(max_tokens, n[doc] - start)
            lo = at[doc] + start
            cols = [b.column(0).take(pa.array(doc)), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(raw[x:y]) for x, y in zip(lo.tolist(), (lo + length).tolist())], pa.int64()),
                    pa.array(n[doc], pa.int64())]
            if with_ids:
                cols.append(pa.array([raw[x:y] for x, y in zip(lo, lo + length)], pa.list_(pa.int64())))
            yield pa.record_batch(cols, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                     run, schema)


def pack_documents(docs: DataFrame, tokenizer_json: str, end_id: int, limits: Limits = Limits(),
                   with_ids: bool = False, **columns) -> DataFrame:
    """Pack whole documents; every token bears loss.  One row per piece:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    size = min(limits.tokens, limits.loss)
    pieces = cut_documents(docs, tokenizer_json, end_id, size, with_ids=with_ids, **columns)
    return assign_sequences(pieces.withColumn("n_loss", F.col("length")), limits, tokens_col="length").drop("n_loss")


def build_sequences(packed: DataFrame, limits: Limits = Limits(), pad_id: int = 0) -> DataFrame:
    """Sequences from ``pack_documents(..., with_ids=True)``: sequence_id,
    input ids (padded to the limit unless their number is a power of two)
    and the segment number of each position (-1: padding)."""
    s = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    n = F.aggregate("p", F.lit(0), lambda a, x: a + F.size(x["ids"]))
    pad = F.when(F.log2(n.cast("double")) % 1 == 0, 0).otherwise(limits.tokens - n)
    segments = F.flatten(F.transform("p", lambda x, i: F.array_repeat(i, F.size(x["ids"]))))
    return s.select("sequence_id",
                    F.concat(F.flatten(F.transform("p", lambda x: x["ids"])),
                             F.array_repeat(F.lit(pad_id).cast("long"), pad.cast("int"))).alias("input_ids"),
                    F.concat(segments, F.array_repeat(F.lit(-1), pad.cast("int"))).alias("segment_ids"))
