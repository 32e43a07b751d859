"""Registered queries against their SQL or brute force, and the pipeline."""

from __future__ import annotations

import os
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from reviewlake.llm import decontaminate, pii, quality
from reviewlake.llm.oracle import SQL
from reviewlake.llm.queries import QUERIES
from reviewlake.sources.tables import read_table

from .test_near_duplicates import roots, slow_fingerprint

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from oracle_check import rows_of_duck, rows_of_spark  # noqa: E402

COLUMNS = {
    "op1_token_binary": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op2_cap_neardup": ["vec_id", "n_links", "component_id", "kept"],
    "op6_url_redirects": ["page_id", "host", "path", "rule", "verdict"],
    "op7_vector_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8_simhash_vp": ["doc_id", "fingerprint", "component_id"],
    "op9_quality": ["doc_id", "held_out", "score", "predicted"],
    "op10_pii_anchors": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op11_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
    "op12_kd_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op13_ptolemy_clusters": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
}


def test_every_operator_has_one_query():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} and set(QUERIES) <= set(names) and "pipeline" in names
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    assert rows_of_spark(QUERIES[name](spark, sf)) == rows_of_duck(con, SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.columns[:len(COLUMNS.get(name, df.columns))] == COLUMNS.get(name, df.columns)
    assert df.count() > 0


def test_pipeline_matches_the_stages_by_hand(spark, sf):
    """The same decisions, taken document by document without Spark joins."""
    docs = read_table(spark, sf, "documents")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = quality.fit(docs, read_table(spark, sf, "labels"))
    import pyarrow as pa
    ids = sorted(rows)
    keep = [i for i, s in zip(ids, model.scores(pa.array([rows[i] for i in ids]))) if s >= 0.3]
    fp = [slow_fingerprint(rows[i]) for i in keep]
    root = roots(len(keep), [(a, b) for a in range(len(keep)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 3])
    keep = [i for k, i in enumerate(keep) if root[k] == k]
    items = read_table(spark, sf, "benchmark").collect()
    index = decontaminate.ItemIndex.build([r["item_id"] for r in items], pa.array([r["text"] for r in items]))
    dirty = {r[0] for r in decontaminate.verified(index, pa.array([rows[i] for i in keep]), 0.8)}
    keep = [i for k, i in enumerate(keep) if k not in dirty]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = set()
    for i in keep:
        x = np.array([*tok.encode(pii.redacted(rows[i]), add_special_tokens=False).ids, 0], "<u4")
        want |= {(i, s, len(x[s:s + 1024]), zlib.crc32(x[s:s + 1024].tobytes()), len(x)) for s in range(0, len(x), 1024)}
    got = corpus_pipeline.run(spark, sf).collect()
    assert len(got) == len(want) and {tuple(r)[:5] for r in got} == want


def test_stages_keep_columns_and_bear_odd_tables(spark, sf, odd_docs, no_docs):
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, odd_docs, sf).schema == odd_docs.schema
        assert step(spark, no_docs, sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, sf).count() == 0
