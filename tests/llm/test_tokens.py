"""Token-id output and packing against whole-text encoding."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlake.llm.packing import Limits, assign_sequences, build_sequences, pack_documents, pack_group
from reviewlake.llm.token_binary import Codec, control_bits, read_tokens, write_token_ids
from reviewlake.llm.tokens import PieceEncoder, tokenizer_json

WORD, BYTE = (tokenizer_json(public_tokenizers.path(x)) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ENCODERS = {"word": PieceEncoder(WORD, False), "byte": PieceEncoder(BYTE, True)}


def test_memo_is_bounded(monkeypatch):
    """Batches of ever new words, and unbroken texts, leave a bounded memo."""
    from reviewlake.llm import tokens
    monkeypatch.setattr(tokens, "MEMO_PIECES", 500)
    monkeypatch.setattr(tokens, "MEMO_IDS", 4000)
    enc, largest = PieceEncoder(BYTE, True), 0
    for k in range(200):
        own = [" ".join(f"w{k}x{j * 7919}" for j in range(60)), f"{k}" + "ab" * 400, "the same words every time"]
        n, ids = enc.encode(pa.array(own))
        want = [e.ids for e in enc.tok.encode_batch(own, add_special_tokens=False)]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]
        largest = max(largest, len(enc.pool))
        assert len(enc.codes) <= 500 and enc.used <= 4000 and all(len(p) <= 64 for p in enc.codes)
    assert largest < 12_000


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aBéßİ.,!?'s1 \n\t\x0b\x1c\x1e\x85 ́ 　日<|>"), ) | st.characters(codec="utf-8"), max_size=24),
                min_size=1, max_size=8))
def test_pieces_encode_like_whole_texts(texts):
    for enc in ENCODERS.values():
        n, ids = enc.encode(pa.array(texts, pa.string()))
        want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_encode_nulls_and_empty_batches():
    for enc in ENCODERS.values():
        n, ids = enc.encode(pa.array([None, "", None], pa.string()))
        assert n.tolist() == [0, 0, 0] and not len(ids)
        n, ids = enc.encode(pa.array([], pa.string()))
        assert not len(n) and not len(ids)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_codec_round_trip_two_bits(values):
    c = Codec(2)
    v = np.array(values, np.uint32)
    control, data = c.encode(v)
    assert len(control) == c.control_bytes(len(v))
    assert (c.decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(v)) == v).all()


@given(st.lists(st.integers(0, 2**16 - 1), max_size=300))
def test_codec_round_trip_one_bit(values):
    c = Codec(1)
    v = np.array(values, np.uint32)
    control, data = c.encode(v)
    assert len(data) == sum(1 if x < 256 else 2 for x in values)
    assert (c.decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(v)) == v).all()


def test_codec_limits():
    assert control_bits(65_536) == 1 and control_bits(65_537) == 2
    with pytest.raises(ValueError):
        Codec(1).encode(np.array([70_000], np.uint32))


def whole_ids(json_text, texts, end):
    tok = Tokenizer.from_str(json_text)
    return [np.array([*e.ids, end], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_token_files_round_trip(odd_docs):
    folder, manifest = write_token_ids(odd_docs, WORD, 2, 49_408, n_shards=5)
    got = read_tokens(odd_docs.sparkSession, folder, manifest).toPandas()
    rows = odd_docs.select("doc_id", "text").collect()
    ids = whole_ids(WORD, [r["text"] for r in rows], 2)
    want = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), len(x), zlib.crc32(x.tobytes())) for r, x in zip(rows, ids))
    got = sorted(zip(got["start"], [None if np.isnan(x) else int(x) for x in got["doc_id"].astype(float)], got["n_tokens"], got["ids_crc32"]))
    assert [((i is not None, i or 0), n, c) for _, i, n, c in got] == want
    assert [g[0] for g in got] == list(np.cumsum([w[1] for w in want]) - [w[1] for w in want])


def test_token_files_empty(no_docs):
    folder, manifest = write_token_ids(no_docs, WORD, 2, 49_408)
    assert read_tokens(no_docs.sparkSession, folder, manifest).count() == 0


def check_packing(p, limits):
    p = p.sort_values(["sequence_id", "offset"])
    per = p.groupby("sequence_id")
    assert (per["length"].cumsum() - p["length"] == p["offset"]).all()
    total = per["length"].sum()
    assert total.max() <= limits.tokens and per.size().max() <= limits.segments
    return float(np.where(total & (total - 1) == 0, 0, limits.tokens - total).sum() / total.sum())


def test_pack_documents(odd_docs):
    limits = Limits(1024, 16, 1024)
    p = pack_documents(odd_docs, BYTE, 0, limits, with_ids=True)
    got = p.toPandas()
    rows = odd_docs.select("doc_id", "text").collect()
    ids = whole_ids(BYTE, [r["text"] for r in rows], 0)
    want = sorted((s, len(x[s:s + 1024]), zlib.crc32(x[s:s + 1024].tobytes()), len(x)) for x in ids for s in range(0, len(x), 1024))
    assert sorted(zip(got["start"], got["length"], got["ids_crc32"], got["doc_tokens"])) == want
    check_packing(got, limits)
    seqs = build_sequences(p, limits).toPandas()
    for n, ids_, seg in zip(got.groupby("sequence_id")["length"].sum(), seqs.sort_values("sequence_id")["input_ids"], seqs.sort_values("sequence_id")["segment_ids"]):
        assert len(ids_) == len(seg) == (n if n & (n - 1) == 0 else 1024) and sum(s >= 0 for s in seg) == n


def test_pack_empty(no_docs):
    assert pack_documents(no_docs, BYTE, 0).count() == 0


def test_padding_is_little(spark):
    rng = np.random.default_rng(2)
    ex = spark.createDataFrame([(int(i), int(n), int(n)) for i, n in enumerate(rng.integers(1, 1025, 5000))], "i long, n_tokens long, n_loss long")
    got = assign_sequences(ex).toPandas().rename(columns={"n_tokens": "length"})
    assert check_packing(got, Limits()) < 0.01


@given(st.lists(st.tuples(st.integers(1, 64), st.integers(0, 40)), max_size=60), st.integers(1, 6))
def test_pack_group_obeys_all_limits(items, segments):
    limits = Limits(64, segments, 40)
    t, l = (np.array([x[k] for x in items], np.int64) for k in (0, 1))
    seq, place = pack_group(t, l, limits)
    for s in np.unique(seq):
        m = seq == s
        assert t[m].sum() <= 64 and l[m].sum() <= 40 and m.sum() <= segments
        assert sorted(place[m]) == list(range(m.sum()))


def test_pack_group_refuses_oversize():
    with pytest.raises(ValueError):
        pack_group(np.array([65]), np.array([1]), Limits(64, 4, 40))


def test_one_id_in_a_third_of_the_rows(spark):
    """A hot id (and copies) neither breaks offsets nor swells a group."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same text here").alias("text"))
    folder, manifest = write_token_ids(df, WORD, 2, 49_408, n_shards=4)
    got = read_tokens(spark, folder, manifest)
    assert got.count() == 3000 and got.select("start").distinct().count() == 3000
    check_packing(pack_documents(df, BYTE, 0).toPandas(), Limits())
