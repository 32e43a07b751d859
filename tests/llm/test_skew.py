"""One text, passage, host or vector in a third of all rows: whole results."""

from __future__ import annotations

import random

import pytest

from reviewlake.llm import cap_neardup, decontaminate, sentence_spans, simhash_vp, sparse_suffix, url_filter

N = 1500


@pytest.fixture(scope="module")
def corpus():
    """A third exact copies, a third with one passage, a third on their own."""
    rng = random.Random(12)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(4000)]

    def text(n):
        return " ".join(rng.choice(words) + ("." if k % 10 == 9 else "") for k in range(n)) + "."
    copy, passage = text(120), text(90)
    rows = []
    for i in range(N):
        rows.append((i, copy if i % 3 == 0 else f"{text(70)}\n{passage}\n{text(30)}" if i % 3 == 1 else text(150)))
    return rows, copy, passage


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(9)


def test_sentence_spans(spark, corpus):
    rows, copy, passage = corpus
    got = {r["doc_id"]: r for r in sentence_spans.remove_repeats(frame(spark, rows), changed_only=True).collect()}
    assert set(got) == {i for i in range(2, N) if i % 3 < 2}
    assert all(r["text"] == "" for i, r in got.items() if i % 3 == 0)
    assert all(passage not in r["text"] and r["first_ids"] == [1] for i, r in got.items() if i % 3 == 1)


def test_sparse_suffixes(spark, corpus):
    rows, copy, passage = corpus
    got = {r["id"]: r for r in sparse_suffix.changed_texts(frame(spark, rows)).collect()}
    assert set(got) == {i for i in range(2, N) if i % 3 < 2}
    assert all(r["text"] == "" and r["first_ids"][0] == 0 for i, r in got.items() if i % 3 == 0)
    for i, r in got.items():
        if i % 3 == 1:
            words = rows[i][1].split()
            kept = r["text"].split()      # a neighbouring word may be equal by chance in an earlier document
            assert 97 <= len(kept) <= 100 and kept[:67] == words[:67] and kept[-27:] == words[-27:] and r["first_ids"][0] == 1


def test_simhash(spark, corpus):
    rows, _, _ = corpus
    got = {r["doc_id"]: r["component_id"] for r in simhash_vp.simhash_components(frame(spark, rows)).collect()}
    assert {got[i] for i in range(0, N, 3)} == {0} and all(got[i] == i for i in range(2, N, 3))
    kept = simhash_vp.near_duplicates(frame(spark, rows))
    assert kept.where("doc_id % 3 = 0").count() == 1 and kept.where("doc_id % 3 = 2").count() == N // 3


def test_decontamination(spark, corpus):
    rows, _, passage = corpus
    items = spark.createDataFrame([(7, passage), (8, "none of these words stand in any of the texts")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, rows), items).collect()}
    assert got == {(i, 7) for i in range(1, N, 3)}


def test_one_host_and_one_class(spark):
    """A third of the pages point at one canonical page that is blocked."""
    rows = [(i, f"http://h.example.net/p{i}", '<link rel="canonical" href="https://bad.com/de/x">' if i % 3 == 0 else "<p>") for i in range(N)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(9)
    rules = url_filter.rules_table(spark, [("block", "com", "/de/")])
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(df, rules).collect()}
    assert got == {i: "block" if i % 3 == 0 else "allow" for i in range(N)}


def test_one_vector_and_one_dense_group(spark):
    rng = random.Random(3)
    centre = [rng.gauss(0, 1) for _ in range(24)]
    same = [rng.gauss(0, 1) for _ in range(24)]
    rows = [(i, same if i % 3 == 0 else [c + rng.gauss(0, 0.02) for c in centre] if i % 3 == 1 else [rng.gauss(0, 1) for _ in range(24)]) for i in range(N)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cap_neardup.embedding_near_duplicates(df).collect()}
    third = N // 3
    assert all(got[i] == (third - 1, i % 3) for i in range(N) if i % 3 < 2)
    assert sum(got[i] == (0, i) for i in range(2, N, 3)) == third
