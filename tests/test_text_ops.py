"""Polarity, model scoring, cascade."""

import sys

from pyspark import cloudpickle

from reviewlake.operators.cascade import classify_cascade
from reviewlake.operators.model_scoring import star_sentiment, zero_shot_topic
from reviewlake.operators.polarity import with_polarity

# scorer factories below are defined here: ship them to the workers by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEX = {"good": 0.7, "bad": -0.7, "ok": 0.1004}


def test_polarity_plans_agree(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    a = with_polarity(d, "text").orderBy("doc_id").collect()
    from reviewlake import config as C
    lex = spark.createDataFrame(list(C.DEFAULT_LEXICON.items()), "word string, polarity double")
    b = with_polarity(d, "text", lex, key="doc_id").orderBy("doc_id").collect()
    assert [(r.doc_id, r.sentiment_score, r.sentiment_label) for r in a] == \
           [(r.doc_id, r.sentiment_score, r.sentiment_label) for r in b]


def test_polarity_semantics(spark):
    df = spark.createDataFrame([(1, "Good, GOOD and bad!"), (2, "nothing here"), (3, None), (4, "ok")],
                               "id int, text string")
    got = {r.id: (r.sentiment_score, r.sentiment_label) for r in with_polarity(df, "text", LEX).collect()}
    assert got[1] == (0.233, "positive")
    assert got[2] == (0.0, "neutral") and got[3] == (0.0, "neutral")
    assert got[4] == (0.1, "positive")          # label from the unrounded mean 0.1004


def flaky_stars():
    def score(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError("model failure")
        return [f"{min(5, len(t) % 6)} stars" for t in texts]
    return score


def test_star_sentiment_failure_is_per_row(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "boom"), (3, None), (4, "a")], "id int, text string")
    got = {r.id: (r.bert_label, r.bert_score) for r in star_sentiment(df, "text", flaky_stars).collect()}
    assert got[1] == ("positive", 0.5)
    assert got[2] == ("neutral", 0.0) and got[3] == ("neutral", 0.0)
    assert got[4] == ("negative", -1.0)


def topic_model():
    def score(texts):
        return ["hiking" if "tent" in t else "not-a-label" for t in texts]
    return score


def test_zero_shot_and_cascade(spark):
    df = spark.createDataFrame([(1, "bike"), (2, "a tent"), (3, "plain box")], "id int, text string")
    z = {r.id: r.sport_category for r in zero_shot_topic(df, "text", topic_model).collect()}
    assert z == {1: "other", 2: "hiking", 3: "other"}
    c = {r.id: r.sport_category for r in classify_cascade(df, "text", "sport_category", topic_model).collect()}
    assert c == {1: "cycling", 2: "hiking", 3: "other"}
    k = {r.id: r.sport_category for r in classify_cascade(df, "text", "sport_category", None, False).collect()}
    assert k == {1: "cycling", 2: "other", 3: "other"}
    plan = classify_cascade(df, "text", "sport_category", topic_model)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan or "PythonMapInArrow" in plan


def test_dict_lexicon_of_any_size_has_one_plan(spark):
    from reviewlake.operators.cascade import enrich
    big = {f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{i}": 0.0 for i in range(1200)}
    big.update(LEX)
    df = spark.createDataFrame([(1, "good bad good"), (2, "nothing")], "id int, text string")
    out = enrich(df, "text", big)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id: r.sentiment_score for r in out.collect()} == {1: 0.233, 2: 0.0}


def test_words_that_differ_in_case_are_one_word(spark):
    df = spark.createDataFrame([(1, "GOOD good")], "id int, text string")
    lex = {"Good": 0.2, "good": 0.6}
    table = spark.createDataFrame(list(lex.items()), "word string, polarity double")
    assert with_polarity(df, "text", lex).first().sentiment_score == 0.4
    assert with_polarity(df, "text", table, key="id").first().sentiment_score == 0.4


def constant_model(answer):
    def build():
        return lambda texts: [answer] * len(texts)
    return build


def test_two_factories_of_one_builder_are_two_models(spark):
    df = spark.createDataFrame([(i, "text") for i in range(4)], "id int, text string").coalesce(1)
    a = star_sentiment(df, "text", constant_model("5 stars")).collect()
    b = star_sentiment(df, "text", constant_model("1 star")).collect()
    assert {r.bert_label for r in a} == {"positive"} and {r.bert_label for r in b} == {"negative"}


def broken_model():
    def score(texts):
        raise RuntimeError("no weights")
    return score


def test_broken_model_fails_the_job_and_failures_are_counted(spark):
    import pytest
    from pyspark.sql import Observation
    df = spark.createDataFrame([(i, "text") for i in range(30)], "id int, text string").coalesce(1)
    with pytest.raises(Exception, match="failed on all 30 rows"):
        star_sentiment(df, "text", broken_model).collect()
    seen = Observation()
    rows = spark.createDataFrame([(1, "abcd"), (2, "boom"), (3, None)], "id int, text string")
    star_sentiment(rows, "text", flaky_stars, failures=seen).collect()
    assert seen.get == {"scored": 2, "failed": 1}


def test_cascade_reads_its_input_once(spark, sf):
    from reviewlake.sources.tables import reviews
    df = classify_cascade(reviews(spark, sf), "text", "sport_category", topic_model, carry=["review_id"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("MapInPandas") == 1


def test_run_metrics_scores_once(spark, sf):
    from reviewlake.registry import all_queries
    plan = all_queries()["run_metrics"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Python" not in plan and "MapInPandas" not in plan


def test_carry_only_key_through_python(spark):
    df = spark.createDataFrame([(1, "abcd", "x" * 1000)], "id int, text string, big string")
    out = star_sentiment(df, "text", flaky_stars, carry=["id"])
    assert out.columns == ["id", "bert_label", "bert_score"]
    assert out.first().bert_label == "positive"
