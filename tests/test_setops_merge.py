"""Union, first-occurrence dedup and keyed upsert properties."""

import pytest
from pyspark.sql import functions as F

from reviewlake.operators.merge import UPDATE_TOUCH_ONLY, upsert
from reviewlake.operators.setops import dedup_first, union_sources

SCHEMA = "review_id string, source string, text string, sentiment_label string, ingested_at timestamp"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_union_priority_and_dedup(spark):
    a = spark.createDataFrame([("x", "a", "first", None, None), ("y", "a", "only a", None, None)], SCHEMA)
    b = spark.createDataFrame([("x", "b", "second", None, None), ("z", "b", "only b", None, None),
                               ("z", "b", "only b again", None, None)], SCHEMA)
    u = union_sources([a, b])
    assert u.where(F.col("source") == "b").select("source_priority").distinct().first()[0] == 2
    d = dedup_first(u, "review_id", ["source_priority"]).drop("source_priority")
    got = {r.review_id: r.text for r in d.collect()}
    assert got == {"x": "first", "y": "only a", "z": "only b"}
    w = dedup_first(u, "review_id", ["source_priority"], strategy="window").drop("source_priority")
    assert rows(w) == rows(d)
    assert rows(dedup_first(d, "review_id", ["source"])) == rows(d)     # idempotent


def test_dedup_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"))
    d = dedup_first(df, "k", ["seq"])
    assert d.count() == 20001
    assert d.where(F.col("k") == "hot").first().seq == 0


def _table(spark):
    return spark.createDataFrame([
        ("r1", "s", "old text", "neutral", None),
        ("r2", "s", "keep me", "positive", None)], SCHEMA).withColumn(
        "ingested_at", F.to_timestamp(F.lit("2026-01-01 00:00:00")))


def test_upsert_semantics(spark):
    t = _table(spark)
    b = spark.createDataFrame([("r1", "new", "ignored text", None, None),
                               ("r3", "new", "inserted", "negative", None)], SCHEMA)
    now = F.to_timestamp(F.lit("2026-02-01 00:00:00"))
    got = {r.review_id: r for r in upsert(t, b, "review_id", ("sentiment_label",), now=now).collect()}
    assert got["r1"].text == "old text" and got["r1"].sentiment_label is None     # incoming null overwrites
    assert str(got["r1"].ingested_at).startswith("2026-02-01")
    assert got["r2"].sentiment_label == "positive" and str(got["r2"].ingested_at).startswith("2026-01-01")
    assert got["r3"].text == "inserted" and got["r3"].source == "new"
    touch = {r.review_id: r for r in upsert(t, b, "review_id", UPDATE_TOUCH_ONLY, now=now).collect()}
    assert touch["r1"].sentiment_label == "neutral" and str(touch["r1"].ingested_at).startswith("2026-02-01")


def test_batch_keys_are_checked(spark):
    import pytest
    t, now = _table(spark), F.to_timestamp(F.lit("2026-02-01 00:00:00"))
    twice = spark.createDataFrame([("r1", "a", "x", None, None), ("r1", "b", "y", None, None)], SCHEMA)
    with pytest.raises(Exception, match="repeated review_id"):
        upsert(t, twice, now=now).collect()
    with pytest.raises(Exception, match="null review_id"):
        upsert(t, spark.createDataFrame([(None, "a", "x", None, None)], SCHEMA), now=now).collect()


def test_upsert_idempotent_and_splittable(spark):
    t = _table(spark)
    b = spark.createDataFrame([(f"r{i}", "new", f"t{i}", "positive", None) for i in range(1, 6)], SCHEMA)
    now = F.to_timestamp(F.lit("2026-02-01 00:00:00"))
    once = upsert(t, b, now=now)
    twice = upsert(once, b, now=now)
    assert rows(once) == rows(twice)
    b1, b2 = b.where(F.col("review_id") <= "r2"), b.where(F.col("review_id") > "r2")
    split = upsert(upsert(t, b1, now=now), b2, now=now)
    assert rows(split) == rows(once)


def test_bucketed_table_side_is_not_shuffled(spark, tmp_path):
    import uuid
    from reviewlake.sinks.files import save_bucketed
    name = f"t_{uuid.uuid4().hex[:8]}"
    save_bucketed(_table(spark), name, "review_id", 4, path=str(tmp_path / name))
    b = spark.createDataFrame([("r1", "new", "x", "negative", None), ("r9", "new", "y", "positive", None)], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as if the batch were large
    try:
        df = upsert(spark.table(name), b, now=F.to_timestamp(F.lit("2026-02-01 00:00:00")), buckets=4)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [x for x in plan.splitlines() if "FileScan parquet" in x and "text#" in x]
    assert wide and all("Bucketed: true" in x for x in wide)     # only the key column may move
    assert {r.review_id: r.sentiment_label for r in df.collect()} == {"r1": "negative", "r2": "positive", "r9": "positive"}


def test_buckets_are_bounded_in_bytes(spark, tmp_path, monkeypatch):
    from reviewlake.sinks import files as S
    df = spark.createDataFrame([(i, "é" * 500, None) for i in range(100)], "k long, t string, u string")
    assert S.rows_and_bytes(df) == (100, 100 * 1008)
    assert S.rows_and_bytes(df.where("k < 0")) == (0, 0)
    monkeypatch.setattr(S, "BYTES_PER_BUCKET", 10_000)
    assert S.buckets_for(100, size=100 * 1008) == 11
    assert S.buckets_for(100) == 1 and S.buckets_for(2_500_000) == 3


def test_rows_of_single_keys_do_not_move(spark):
    df = spark.createDataFrame([(f"k{i % 90}" if i % 7 else None, i % 5, f"t{i % 11}") for i in range(120)], "k string, seq int, t string")
    got = dedup_first(df, "k", ["seq"], strategy="repeated")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, dedup_first(df, "k", ["seq"]).collect())) and got.columns == df.columns
    wide = spark.range(1000).select(F.concat(F.lit("id"), "id").alias("k"), F.repeat(F.lit("x"), 100).alias("t"))
    plan = dedup_first(wide, "k", ["t"], strategy="repeated")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_touched_upsert_equals_the_join(spark, monkeypatch):
    """Null and repeated keys in the table, hits and inserts, also where most keys share their bit."""
    from reviewlake.operators import merge
    t = spark.createDataFrame([(f"r{i % 70}" if i % 9 else None, "s", f"text {i}", "neutral", None) for i in range(100)], SCHEMA) \
        .withColumn("ingested_at", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    b = spark.createDataFrame([(f"r{i}", "new", f"new {i}", "positive" if i % 3 else None, None) for i in range(40, 120)], SCHEMA)
    now = F.to_timestamp(F.lit("2026-02-01 00:00:00"))
    def plain(df):
        return sorted(map(repr, df.collect()))
    want = plain(upsert(t, b, now=now))
    for bits in (1 << 20, 64, 8):
        monkeypatch.setattr(merge, "bits_for", lambda n, bits=bits: bits)
        assert plain(upsert(t, b, now=now, strategy="touched")) == want
    assert plain(upsert(t, b.limit(0), now=now, strategy="touched")) == plain(t)
    assert plain(upsert(t.limit(0), b, now=now, strategy="touched")) == plain(upsert(t.limit(0), b, now=now))


def test_touched_upsert_leaves_other_rows_where_they_are(spark):
    from reviewlake.operators import merge
    t = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("k"), F.repeat(F.lit("x"), 100).alias("t"))
    b = spark.range(4990, 5400).select(F.concat(F.lit("r"), "id").alias("k"), F.lit("new").alias("t"))
    changes, touched, rest, known, unsure = merge._touched(t, b, b.select(F.col("k").alias("_k"), F.lit(True).alias("_hit")), "k")
    assert changes.count() == 10 and 10 <= touched.count() < 50 and touched.count() + rest.count() == 5000
    assert 380 < known.count() <= 400 and unsure.count() + known.count() <= 400 + 10
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_key_bits_miss_no_key(spark):
    from reviewlake.operators.keybits import MAX_BITS, MIN_BITS, bits_for, key_bits, with_may_hold
    assert bits_for(0) == MIN_BITS and bits_for(10 ** 9) == MAX_BITS and bits_for(100_000) >= 64 * 100_000
    keys = spark.range(3000).select(F.when(F.col("id") % 50 != 0, F.concat(F.lit("é"), "id")).alias("k"))
    for bits in (1 << 20, 1 << 16, 1 << 12):
        bm = key_bits(keys.where("k is not null"), "k", bits)
        assert with_may_hold(keys, "k", bm, bits, "m").where("not m and k is not null").count() == 0
        assert with_may_hold(keys, "k", bm, bits, "m").where("m and k is null").count() == 0
    others = spark.range(3000, 13000).select(F.concat(F.lit("é"), "id").alias("k"))
    assert with_may_hold(others, "k", key_bits(keys, "k", 1 << 20), 1 << 20, "m").where("m").count() < 100


def test_upsert_by_slices_is_the_upsert(spark, tmp_path):
    """A table in folders: the touched rows are stored slice by slice, the result has no slice column."""
    from reviewlake.operators.merge import upsert
    cols = "review_id string, sentiment_label string, sentiment_score double, t string, _slice int"
    table = spark.createDataFrame([(f"k{i}" if i else None, "old", 0.0, f"t{i}", i % 3) for i in range(60)], cols)
    table.write.partitionBy("_slice").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(f"k{i}", "new" if i % 2 else None, 1.0, f"b{i}") for i in range(50, 70)], "review_id string, sentiment_label string, sentiment_score double, t string")
    want = sorted(map(str, upsert(table.drop("_slice"), batch).collect()))
    got = upsert(table, batch, strategy="touched", slice_col="_slice")
    assert got.columns == ["review_id", "sentiment_label", "sentiment_score", "t"] and sorted(map(str, got.collect())) == want
    none = upsert(table.where("t is null"), batch, strategy="touched", slice_col="_slice")
    assert none.count() == 20
    with pytest.raises(ValueError):
        upsert(table, batch, slice_col="_slice")
