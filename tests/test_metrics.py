"""Aggregates: empty input, shares, paging, ordering, plan shape."""

from pyspark.sql import functions as F

from reviewlake.operators import metrics as M
from reviewlake.operators.filters import dashboard_predicate
from reviewlake.sources.tables import classified_reviews, reviews

DDL = ("review_id string, store_city string, rating double, sentiment_label string, sentiment_score double, "
       "sport_category string, language string, source string, text string, date timestamp")


def test_kpis_empty_input_is_not_an_error(spark):
    empty = spark.createDataFrame([], DDL)
    r = M.kpis(empty, dashboard_predicate(languages=["en"])).first()
    assert r.total == 0 and r.full_total == 0 and r.pct_positive == 0.0 and r.avg_rating is None
    assert M.insight_worst_category(empty).count() == 0
    assert M.insight_negative_city(empty).count() == 0


def test_kpis_filtered_vs_full(spark, sf):
    df = reviews(spark, sf)
    r = M.kpis(df, dashboard_predicate(languages=["en"])).first()
    assert r.full_total == df.count()
    assert r.total == df.where(F.col("language") == "en").count()
    assert r.delta_class == ("good" if r.delta_to_target >= 0 else "bad")


def test_city_shares_sum_to_100(spark, sf):
    s = M.sentiment_by_city(reviews(spark, sf)).groupBy("store_city").agg(F.sum("pct").alias("p"))
    assert all(abs(r.p - 100.0) < 1e-9 for r in s.collect())


def test_pages_concatenate_to_full_order(spark, sf):
    df = reviews(spark, sf)
    n = df.where(F.col("sentiment_label") == "neutral").count()
    pages = []
    for p in range(1, n // 7 + 2):
        pages += [r.review_id for r in M.explorer_page(df, "neutral", "Lowest Rating", p, 7).collect()]
    full = [r.review_id for r in df.where(F.col("sentiment_label") == "neutral")
            .orderBy(F.col("rating").asc_nulls_last(), "review_id").collect()]
    assert pages == full
    s = M.explorer_summary(df, "neutral", 7).first()
    assert s.total == n and s.total_pages == max(1, -(-n // 7))


def test_paging_plan_is_top_k(spark, sf):
    plan = M.explorer_page(reviews(spark, sf), "All", "Most Recent", 3, 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_lowest_scores_nulls_last(spark):
    df = spark.createDataFrame([("a", None, "x", None), ("b", "C", "y", 0.5), ("c", "C", "z", -1.0)],
                               "review_id string, store_city string, text string, sentiment_score double")
    assert [r.review_id for r in M.lowest_scores(df, 3).collect()] == ["c", "b", "a"]


def test_rating_by_category_partial_aggregation(spark, sf):
    df = M.rating_by_category(classified_reviews(spark, sf))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "BatchEvalPython" not in plan
    got = [r.rank for r in df.collect()]
    assert got == sorted(got)


def test_keyset_pages_concatenate_to_full_order(spark, sf):
    df = reviews(spark, sf)
    for sort_by, col, desc in [("Lowest Rating", "rating", False), ("Most Recent", "date", True)]:
        full = [r.review_id for r in df.orderBy(
            (F.col(col).desc_nulls_last() if desc else F.col(col).asc_nulls_last()), "review_id").collect()]
        got, after = [], None
        while True:
            page = M.explorer_page_after(df, after, "All", sort_by, 17).collect()
            if not page:
                break
            got += [r.review_id for r in page]
            after = (page[-1].sort_value, page[-1].review_id)
        assert got == full


def _scan_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]


def test_dashboard_filter_is_pushed_to_the_documents_scan(spark, sf):
    from reviewlake.operators.filters import dashboard_filter
    df = dashboard_filter(reviews(spark, sf), languages=["en", "fr"])
    doc_scans = [s for s in _scan_nodes(df) if "documents" in s]
    assert doc_scans and all("In(lang" in s for s in doc_scans)


def test_count_reads_only_the_key_column(spark, sf):
    scans = _scan_nodes(M.verify_total(reviews(spark, sf)))
    doc = [s for s in scans if "documents" in s][0]
    assert "ReadSchema: struct<doc_id:bigint>" in doc


def test_lookup_join_has_no_hint(spark):
    from reviewlake.operators.lookup import lookup_join
    df = spark.createDataFrame([("a", "pt"), ("b", "xx"), ("c", None)], "id string, lang string")
    names = spark.createDataFrame([("pt", "Portuguese"), ("en", "English")], "code string, name string")
    out = lookup_join(df, names, "lang", "code", "name", "lang_name")
    assert {r.id: r.lang_name for r in out.collect()} == {"a": "Portuguese", "b": "xx", "c": None}
    assert "hint" not in out._jdf.queryExecution().analyzed().toString().lower()


def test_means_do_not_depend_on_order(spark):
    from reviewlake.functions.numeric import exact_mean
    values = [0.1, 0.2, 0.3, 1e6, -1e6, 4.7] * 50
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {df.repartition(n).agg(exact_mean(F.col("x"))).first()[0] for n in (1, 3, 7, 16)}
    assert len(got) == 1
    assert spark.createDataFrame([], "x double").agg(exact_mean(F.col("x"))).first()[0] is None


def test_verify_sql_leaves_no_view(spark, sf):
    before = {t.name for t in spark.catalog.listTables()}
    M.verify_sql(reviews(spark, sf))["total"].collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_dashboard_bundle(spark, sf):
    from reviewlake.plans.dashboard import dashboard, release
    full = classified_reviews(spark, sf)
    panels = dashboard(full, languages=["en", "fr"], sentiments=["positive", "neutral", "negative"])
    try:
        counts = {k: v.count() for k, v in panels.items()}
        assert counts["kpis"] == 1 and counts["rating_by_category"] > 0 and counts["explorer_page"] == 20
        k = panels["kpis"].first()
        assert k.total == counts["_filtered"] and k.full_total == full.count()
        assert panels["_filtered"].storageLevel.useMemory
    finally:
        release(panels)
    assert not panels["_filtered"].storageLevel.useMemory


def test_ties_in_group_means_break_by_key(spark):
    df = spark.createDataFrame([("b_cat", 2.0, "negative", "X"), ("a_cat", 2.0, "negative", "Y"),
                                ("c_cat", 4.0, "negative", "X"), ("d_cat", 4.0, "positive", "Y")],
                               "sport_category string, rating double, sentiment_label string, store_city string")
    assert M.insight_worst_category(df).first().sport_category == "a_cat"
    assert M.insight_best_category(df).first().sport_category == "c_cat"
    assert M.insight_negative_city(df).first().store_city == "X"
    ranks = {r.sport_category: r.rank for r in M.rating_by_category(df).collect()}
    assert ranks == {"a_cat": 1, "b_cat": 2, "c_cat": 3, "d_cat": 4}


def test_verify_sql_matches_dataframe_forms(spark, sf):
    df = reviews(spark, sf)
    q = M.verify_sql(df)
    assert q["total"].first().total == M.verify_total(df).first().total
    assert q["avg_rating"].first().avg_rating == M.verify_avg_rating(df).first().avg_rating
    assert [tuple(r) for r in q["by_city"].collect()] == [tuple(r) for r in M.verify_by_city(df).collect()]
    assert [(r.sentiment_label, r.n) for r in q["by_sentiment"].collect()] == \
           [(r.sentiment_label, r.n) for r in M.verify_by_sentiment(df).collect()]


def test_dashboard_load_data(spark, tmp_path):
    import json
    from reviewlake.plans.dashboard import load_data
    rows = [{"review_id": "a", "text": "x", "rating": 4.0, "sentiment_label": "neutral", "sentiment_score": 0.0,
             "bert_label": "positive", "bert_score": 0.5, "date": "2026-01-02T10:00:00-07:00"},
            {"review_id": "b", "text": "y", "rating": 2.0, "date": "not a date"}]
    (tmp_path / "second.json").write_text(json.dumps(rows), encoding="utf-8")
    df = load_data(spark, [str(tmp_path / "first.json"), str(tmp_path / "second.json")])
    got = {r.review_id: (r.sentiment_label, r.sentiment_score, r.date) for r in df.collect()}
    assert got["a"][0] == "positive" and got["a"][1] == 0.5 and str(got["a"][2]) == "2026-01-02 17:00:00"
    assert got["b"] == (None, None, None)
    (tmp_path / "lexicon.json").write_text(json.dumps([{"review_id": "c", "sentiment_label": "negative", "sentiment_score": -0.5}]), encoding="utf-8")
    c = load_data(spark, [str(tmp_path / "lexicon.json")]).first()
    assert (c.sentiment_label, c.sentiment_score) == ("negative", -0.5)          # no model columns in the file: nothing to override with
    assert load_data(spark, [str(tmp_path / "none.json")]).count() == 0
