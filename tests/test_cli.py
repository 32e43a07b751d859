"""Command-line jobs end to end on a review file like the collectors write."""

import json
import os

from reviewlake import cli

ROWS = [
    {"review_id": "gp_1", "source": "google_play", "store_id": "app_br", "store_name": "App (Lisbon)",
     "store_city": "Lisbon", "rating": 5.0, "text": "Great running shoes, love them", "language": "en",
     "date": "2026-01-02T10:00:00", "sport_category": "other", "collected_at": "2026-01-03T00:00:00"},
    {"review_id": "gp_2", "source": "google_play", "store_id": "", "store_name": "App (Porto)",
     "store_city": "Porto", "rating": 1.0, "text": "Worst delivery ever, bad", "language": "en",
     "date": "2026-01-04T10:00:00", "sport_category": "other", "collected_at": "2026-01-05T00:00:00"},
    {"review_id": "gp_2", "source": "google_play", "store_city": "Porto", "rating": 1.0,
     "text": "duplicate of gp_2", "language": "en", "date": "2026-01-09T10:00:00"},
]


def test_cli_jobs(spark, tmp_path, capsys):
    src = tmp_path / "reviews.json"
    src.write_text(json.dumps(ROWS, ensure_ascii=False, indent=2), encoding="utf-8")
    cli.main(["analyze", "--input", str(src), "--output", str(tmp_path / "analyzed"), "--multiline"])
    got = {r.review_id: (r.sport_category, r.sentiment_label) for r in spark.read.parquet(str(tmp_path / "analyzed")).collect()}
    assert got["gp_1"] == ("running", "positive")

    cli.main(["load", "--input", str(src), "--table", str(tmp_path / "table"), "--multiline"])
    cli.main(["load", "--input", str(src), "--table", str(tmp_path / "table"), "--multiline", "--touch-only"])
    out = capsys.readouterr().out
    assert "total" in out and "by city" in out
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2          # deduplicated, upserted twice

    cli.main(["publish", "--input", str(src), "--multiline", "--format", "parquet", "--path", str(tmp_path / "topic")])
    cli.main(["consume", "--format", "parquet", "--path", str(tmp_path / "topic"), "--output", str(tmp_path / "sink"),
              "--checkpoint", str(tmp_path / "ckpt"), "--rejects", str(tmp_path / "rejects")])
    assert "received 3 records, 0 malformed" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 3

    cli.main(["process", "--input", str(tmp_path / "table"), "--output", str(tmp_path / "processed")])
    assert {r.length_category for r in spark.read.parquet(str(tmp_path / "processed")).collect()} == {"short"}


def scorers_on_workers(spark):
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "scorers.py"))


def test_cli_classify_with_model(spark, tmp_path):
    scorers_on_workers(spark)
    src = tmp_path / "r.json"
    src.write_text("\n".join(json.dumps(r) for r in [
        {"review_id": "a", "text": "bike ride"}, {"review_id": "b", "text": "It is a plain box"}]), encoding="utf-8")
    cli.main(["classify", "--input", str(src), "--output", str(tmp_path / "c"),
              "--model", "scorers:length_topic_factory"])
    got = {r.review_id: r.sport_category for r in spark.read.parquet(str(tmp_path / "c")).collect()}
    # keyword hit for "a"; "b" goes to the stub model: 17 characters → label index 7
    assert got == {"a": "cycling", "b": "water_sports"}


def test_cli_report(spark, tmp_path, capsys):
    src = tmp_path / "r.json"
    enriched = [dict(r, sentiment_label=lab, sentiment_score=sc)
                for r, lab, sc in zip(ROWS[:2], ["positive", "negative"], [0.6, -0.8])]
    src.write_text("\n".join(json.dumps(r) for r in enriched), encoding="utf-8")
    cli.main(["report", "--input", str(src)])
    out = capsys.readouterr().out
    assert "distribution" in out and "category_rating" in out and "lowest_scores" in out


def test_collect_score_report_export(spark, tmp_path, capsys):
    from pyspark.sql import functions as F
    play = [(json.dumps({"reviewId": f"p{i}", "score": s, "content": "a long enough review text"}), "gb", "en", "London") for i, s in enumerate((5, "bad", 2.5))]
    page = '<script type="application/ld+json">{"review": [{"description": "fine shop, nice staff"}, 7]}</script>'
    at = F.to_timestamp(F.lit("2026-03-01 12:00:00"))
    spark.createDataFrame(play, "payload string, country string, lang string, city string").withColumn("fetched_at", at).write.parquet(str(tmp_path / "play"))
    spark.createDataFrame([(page, "en", "York")], "html string, lang string, city string").withColumn("fetched_at", at).write.parquet(str(tmp_path / "pages"))
    cli.main(["collect", "--play", str(tmp_path / "play"), "--review-pages", str(tmp_path / "pages"),
              "--rejects", str(tmp_path / "rejects"), "--output", str(tmp_path / "reviews")])
    assert spark.read.json(str(tmp_path / "reviews")).count() == 3
    assert {r.reject_source for r in spark.read.parquet(str(tmp_path / "rejects")).collect()} == {"play", "review_pages"}

    scorers_on_workers(spark)
    score = ["score", "--input", str(tmp_path / "reviews"), "--model", "scorers:letter_stars_factory", "--metrics", str(tmp_path / "metrics")]
    for run in ("r1", "r2"):
        cli.main([*score, "--output", str(tmp_path / run), "--run-id", run])
    m = spark.read.parquet(str(tmp_path / "metrics"))
    assert {r.run_id for r in m.select("run_id").distinct().collect()} == {"r1", "r2"}
    assert m.where("name like '%seconds' and value_num is null").count() == 0 and m.where("name = 'scored_rows' and value_num = 3").count() == 2
    capsys.readouterr()
    cli.main(["report", "--input", str(tmp_path / "r1"), "--scored"])
    assert "city_score" in capsys.readouterr().out
    cli.main(["export-csv", "--input", str(tmp_path / "reviews"), "--output", str(tmp_path / "csv")])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def test_load_of_a_file_with_model_columns_only(spark, tmp_path):
    src = tmp_path / "scored.json"
    src.write_text(json.dumps([{"review_id": "a", "text": "x", "bert_label": "positive", "bert_score": 0.5}]), encoding="utf-8")
    cli.main(["load", "--input", str(src), "--table", str(tmp_path / "t"), "--multiline"])
    r = spark.read.parquet(str(tmp_path / "t")).first()
    assert (r.sentiment_label, float(r.sentiment_score)) == ("positive", 0.5)
