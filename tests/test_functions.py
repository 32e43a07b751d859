"""Scalar helpers: rounding, text, numbers, time."""

import datetime as dt

from pyspark.sql import functions as F

from reviewlake.functions import numeric as N
from reviewlake.functions import text as T
from reviewlake.functions import timefn as TM


def one(spark, expr, value=None, ddl="x double"):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(expr.alias("y")).first().y


def test_round_half_up(spark):
    for x, n, want in [(1.005, 2, 1.01), (2.675, 2, 2.68), (0.125, 2, 0.13), (-0.125, 2, -0.13),
                       (0.1004, 3, 0.1), (4.0, 2, 4.0)]:
        assert one(spark, N.round_half_up(F.col("x"), n), x) == want


def test_title_case(spark):
    assert one(spark, T.title_case(F.col("x")), "water_sports", "x string") == "Water_Sports"
    assert one(spark, T.title_case(F.col("x")), "hELLO wORLD-x2y", "x string") == "Hello World-X2Y"


def test_strip_ljust_pad_int(spark):
    assert one(spark, T.strip_chars(F.col("x"), ". "), ". Works well. ", "x string") == "Works well"
    assert one(spark, T.ljust(F.col("x"), 5), "ab", "x string") == "ab   "
    assert one(spark, T.ljust(F.col("x"), 2), "abcdef", "x string") == "abcdef"
    assert one(spark, T.zero_pad(F.col("x"), 5), 42, "x long") == "00042"
    assert one(spark, T.zero_pad(F.col("x"), 5), 1234567, "x long") == "1234567"
    assert one(spark, T.leading_int(F.col("x")), "4 stars", "x string") == 4
    assert one(spark, T.leading_int(F.col("x")), "five stars", "x string") is None
    assert one(spark, T.bar(F.col("x")), 3.0) == "███"
    assert one(spark, T.bar(F.col("x")), None) == ""


def test_vote_rating_boundaries(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 10, 11, 50, 51, 100, 101, -5]], "v long")
    got = [r.r for r in df.select(N.vote_to_rating(F.col("v")).alias("r")).collect()]
    assert got == [1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 4.0, 5.0, 1.0]


def test_labels_and_bands(spark):
    df = spark.createDataFrame([(0.1,), (-0.1,), (0.1001,), (-0.1001,), (None,)], "s double")
    got = [r.l for r in df.select(N.polarity_label(F.col("s")).alias("l")).collect()]
    assert got == ["neutral", "neutral", "positive", "negative", "neutral"]
    lens = spark.createDataFrame([(49,), (50,), (199,), (200,), (None,)], "n int")
    got = [r.c for r in lens.select(N.length_category(F.col("n")).alias("c")).collect()]
    assert got == ["short", "medium", "medium", "long", "long"]
    stars = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "s int")
    got = [(r.l, r.v) for r in stars.select(N.stars_label(F.col("s")).alias("l"), N.stars_score(F.col("s")).alias("v")).collect()]
    assert got == [("negative", -1.0), ("negative", -0.5), ("neutral", 0.0), ("positive", 0.5), ("positive", 1.0)]
    assert one(spark, N.clamp(F.col("x"), 1.0, 5.0), 5.3) == 5.0
    assert one(spark, N.clamp(F.col("x"), 1.0, 5.0), None) is None
    assert one(spark, N.pct(F.lit(1), F.lit(0), 1)) == 0.0


def test_parse_ts_each_row(spark):
    df = spark.createDataFrame([("2026-01-02T10:00:00-07:00",), ("2026-02-03T10:00:00",),
                                ("2026-02-03T10:00:00.250",), ("garbage",), (None,)], "s string")
    got = [r.t for r in df.select(TM.parse_ts(F.col("s")).alias("t")).collect()]
    assert got[0] == dt.datetime(2026, 1, 2, 17, 0)
    assert got[1] == dt.datetime(2026, 2, 3, 10, 0)
    assert got[2] == dt.datetime(2026, 2, 3, 10, 0, 0, 250000)
    assert got[3] is None and got[4] is None


def test_epoch(spark):
    want = dt.datetime.fromtimestamp(1_700_000_000.5, dt.timezone.utc).replace(tzinfo=None).isoformat()
    assert one(spark, TM.iso(TM.epoch_to_ts(F.col("x"))), 1_700_000_000.5) == want == "2023-11-14T22:13:20.500000"


def test_iso_like_python(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 2, 3, 4, 5),), (dt.datetime(2026, 1, 2, 3, 4, 5, 120),)], "t timestamp")
    got = [r.s for r in df.select(TM.iso(F.col("t")).alias("s")).collect()]
    assert got == [dt.datetime(2026, 1, 2, 3, 4, 5).isoformat(), dt.datetime(2026, 1, 2, 3, 4, 5, 120).isoformat()]


def test_pick_null_index(spark):
    """Guard against element_at(<literal array>, NULL) returning the last element."""
    df = spark.createDataFrame([([1, 2],), ([],)], "xs array<int>")
    arr = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    got = [r.v for r in df.select(T.pick(arr, F.array_min("xs") + 1).alias("v")).collect()]
    assert got == ["b", None]
