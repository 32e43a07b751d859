"""Star and topic models that Spark fits: brute force, held-out labels, odd rows."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.operators.cascade import classify_cascade
from reviewlake.operators.text_models import best_topic, fit_stars, fit_topics, score_stars, score_topics, star_labels

LABELLED = [("awful broken refund", 1), ("awful slow refund broken", 1), ("slow but okay", 2), ("okay plain box", 3), ("plain okay thing", 3),
            ("good solid box", 4), ("great solid lovely", 5), ("great lovely quick", 5), ("lovely quick good", 4), (None, 5), ("", 1), ("ignored words", 9)]


def words(t):
    return set(re.findall(r"[^\W\d_]+", t.lower()))


def brute_stars(train, text, surprise):
    rows = [(words(t), s) for t, s in train if t is not None and 1 <= s <= 5]
    known = {w for ws, _ in rows for w in ws if sum(w in x for x, _ in rows) >= 2}
    if not words(text) & known:
        return None
    stars = 1
    for t in (1, 2, 3, 4):
        hi, lo = [ws for ws, s in rows if s > t], [ws for ws, s in rows if s <= t]
        r = lambda x: math.floor(1000 * math.log(x) + 0.5)
        total = r((len(hi) + 1) / (len(lo) + 1)) if hi and lo else 1 if hi else -1
        for w in words(text) & known if hi and lo else ():
            a, b = sum(w in x for x in hi), sum(w in x for x in lo)
            n = len(rows)
            if (a * n - (a + b) * len(hi)) ** 2 <= surprise * (a + b) * len(hi) * len(lo):
                continue
            total += r((a * n + len(hi)) * len(lo) / ((b * n + len(lo)) * len(hi)))
        stars += total > 0
    return stars


def test_stars_equal_brute_force(spark):
    texts = ["awful broken", "Great, LOVELY!", "okay", "plain solid box good refund", "nothing known 123", "", None, "great great great awful"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for surprise in (20.0, 1.0, 0.0):
        model = fit_stars(spark.createDataFrame(LABELLED, "text string, stars int"), surprise=surprise)
        got = {r["id"]: r["stars"] for r in score_stars(df, model, carry=["id"]).collect()}
        assert got == {i: None if t is None else brute_stars(LABELLED, t, surprise) for i, t in enumerate(texts)}
    assert got[0] == 1 and got[1] >= 4 and len(set(got.values())) > 3
    lab = {r["id"]: (r["bert_label"], r["bert_score"]) for r in star_labels(df, model, carry=["id"]).collect()}
    assert lab[0] == ("negative", -1.0) and lab[1][0] == "positive" and lab[4] == lab[5] == lab[6] == ("neutral", 0.0)


def test_one_sided_and_empty_labels(spark):
    only = spark.createDataFrame([("fine box", 4), ("fine shop", 4)], "text string, stars int")
    df = spark.createDataFrame([(1, "fine"), (2, "else")], "id int, text string")
    assert {r["id"]: r["stars"] for r in score_stars(df, fit_stars(only), carry=["id"]).collect()} == {1: 4, 2: None}
    assert [r["stars"] for r in score_stars(df, fit_stars(only.limit(0)), carry=["id"]).collect()] == [None, None]


def test_stars_on_held_out_documents(spark):
    """Fitted on four fifths of the labelled documents, the labels of the
    rest are found far more surely than by the commonest one."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").select("doc_id", "text", F.when(F.col("toxic") == 1, 1).otherwise(3 + 2 * F.col("quality")).alias("stars"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    scored = score_stars(rows.where(held).withColumnRenamed("stars", "true"), fit_stars(rows.where(~held)), carry=["doc_id", "true"])
    pairs = [(r["true"], r["stars"]) for r in scored.collect()]
    side = lambda n: 0 if n is None else (n >= 4) - (n <= 2)
    hit = sum(side(t) == side(s) for t, s in pairs) / len(pairs)
    commonest = max(sum(side(t) == k for t, _ in pairs) for k in (-1, 0, 1)) / len(pairs)
    assert hit >= commonest + 0.05, (hit, commonest, len(pairs))
    toxic = [side(s) for t, s in pairs if t <= 2]
    assert toxic.count(-1) >= 0.6 * len(toxic) and sum(side(s) < 0 for t, s in pairs if t == 5) <= 0.02 * len(pairs)


@pytest.fixture
def topics(spark):
    rows = [("run marathon asphalt tempo", "running"), ("marathon tempo laces", "running"), ("saddle chain asphalt", "cycling"),
            ("chain saddle brake", "cycling"), ("mood lovely", C.POSITIVE_EXPERIENCE), ("unknown tempo words", None), (None, "yoga"), ("", None)]
    return fit_topics(spark.createDataFrame(rows, "text string, sport_category string")), rows


def test_topics_equal_brute_force(spark, topics):
    model, rows = topics
    texts = [t for t, _ in rows if t is not None]
    idf = {w: math.floor(100 * math.log(len(texts) / sum(w in words(t) for t in texts)) + 0.5) for w in set().union(*map(words, texts))}
    proto = {}
    for c in C.ZERO_SHOT_LABELS:
        own = [words(t) for t, k in rows if t is not None and (k == c or (c == C.OTHER and k is not None and k not in C.ZERO_SHOT_LABELS))]
        proto[c] = {w: sum(w in x for x in own) * 1000 // len(own) * idf[w] for w in set().union(*own)} if own else {}
    known = {w for p in proto.values() for w in p}
    queries = ["tempo asphalt", "brake asphalt saddle", "lovely tempo", "words", "nothing here", "", None, "Marathon! run?"]
    df = spark.createDataFrame(list(enumerate(queries)), "id int, text string")
    got = {r["id"]: r for r in score_topics(df, model, F.col("text"), ["id"]).withColumn("top", best_topic(F.col("topic_scores"))).collect()}
    for i, t in enumerate(queries):
        mine = {w: idf[w] for w in words(t or "") & known}
        if not mine:
            assert got[i]["topic_scores"] is None and got[i]["top"] == C.OTHER
            continue
        norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
        cos = {c: sum(x * p.get(w, 0) for w, x in mine.items()) / (norm(mine) * norm(p)) if p else 0.0 for c, p in proto.items()}
        assert {s["label"]: s["score"] for s in got[i]["topic_scores"]} == pytest.approx(cos, abs=2e-6)
        scores = [s["score"] for s in got[i]["topic_scores"]]
        assert scores == sorted(scores, reverse=True) and got[i]["top"] == max(cos, key=cos.get)
    assert got[0]["top"] == "running" and got[1]["top"] == "cycling"


def test_cascade_with_topics(spark, topics):
    model, _ = topics
    df = spark.createDataFrame([(1, "bike asphalt"), (2, "tempo asphalt"), (3, "zzz"), (4, None)], "id int, text string")
    out = classify_cascade(df, "text", "cat", topics=model, carry=["id"])
    assert {r["id"]: r["cat"] for r in out.collect()} == {1: "cycling", 2: "running", 3: "other", 4: "other"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sums_collapse_before_the_shuffle(spark, topics):
    model, _ = topics
    df = spark.range(10).select("id", F.lit("tempo asphalt").alias("text"))
    plan = score_topics(df, model, F.col("text"), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "BroadcastHashJoin" in plan
