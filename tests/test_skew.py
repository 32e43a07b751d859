"""Aggregates stay exact when one key holds a third of all rows."""

from pyspark.sql import functions as F

from reviewlake.operators import metrics as M
from reviewlake.operators.setops import dedup_first


def _skewed(spark, n=30000):
    df = spark.range(n).select(
        F.col("id").cast("string").alias("review_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("store_city"),
        F.element_at(F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative")), (F.col("id") % 3 + 1).cast("int")).alias("sentiment_label"),
        (F.lit(1.0) + (F.col("id") % 9) * F.lit(0.5)).alias("rating"),
    )
    return df.repartition(16)


def test_city_aggregates_under_skew(spark):
    df = _skewed(spark)
    pdf = df.toPandas()
    got = {(r.store_city, r.sentiment_label): (r.n, r.pct) for r in M.sentiment_by_city(df).collect()}
    g = pdf.groupby(["store_city", "sentiment_label"]).size()
    tot = g.groupby(level=0).sum()
    want = {k: (int(v), v / tot[k[0]] * 100) for k, v in g.items()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)
    hot = {r.store_city: r for r in M.verify_by_city(df).collect()}["Hot"]
    assert hot.total == 10000 and hot.avg_rating == round(pdf[pdf.store_city == "Hot"].rating.mean(), 2)
    plan = M.sentiment_by_city(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan                      # pre-aggregated before the shuffle


def test_dedup_under_skew(spark):
    df = _skewed(spark).withColumn("review_id", F.when(F.col("store_city") == "Hot", F.lit("dup")).otherwise(F.col("review_id")))
    d = dedup_first(df, "review_id", ["rating", "store_city"])
    assert d.count() == 20001
    first = d.where(F.col("review_id") == "dup").first()
    p = df.toPandas()
    want = p[p.review_id == "dup"].sort_values(["rating", "store_city", "sentiment_label"]).iloc[0]
    assert (first.rating, first.sentiment_label) == (want.rating, want.sentiment_label)
