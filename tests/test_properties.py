"""Property tests (hypothesis): each example is a whole batch checked in
one Spark job."""

import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions.numeric import round_half_up
from reviewlake.operators.classify import with_keyword_category
from reviewlake.operators.setops import dedup_first

from test_classify import first_match

WORDS = sorted({w for _, ws in C.SPORT_KEYWORDS for w in ws} | set(C.POSITIVE_EMOTIONS) | set(C.NEGATIVE_EMOTIONS))
piece = st.one_of(st.sampled_from(WORDS), st.sampled_from(WORDS).map(str.upper),
                  st.text(alphabet="abcdeéilmnoprstuç .,!", max_size=8))
texts = st.lists(st.lists(piece, max_size=6).map("".join), min_size=50, max_size=120)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(texts)
def test_cascade_equals_first_match(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, text string")
    got = {r.i: r.c for r in with_keyword_category(df, "text", "c", fill=None).collect()}
    assert got == {i: first_match(t) for i, t in enumerate(batch)}


@SETTINGS
@given(st.lists(st.decimals(min_value=-1000, max_value=1000, places=4, allow_nan=False), min_size=20, max_size=80),
       st.integers(min_value=0, max_value=3))
def test_round_half_up_matches_decimal(spark, values, n):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.y for r in df.select(round_half_up(F.col("x"), n).alias("y")).collect()]
    q = decimal.Decimal(1).scaleb(-n)
    want = [float(decimal.Decimal(repr(float(v))).quantize(q, rounding=decimal.ROUND_HALF_UP)) for v in values]
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=150))
def test_dedup_strategies_agree_with_python(spark, rows):
    df = spark.createDataFrame(rows, "k int, prio int, v int")
    want = {}
    for k, p, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want.setdefault(k, (k, p, v))
    for strategy in ("aggregate", "window"):
        got = {tuple(r) for r in dedup_first(df, "k", ["prio"], strategy).collect()}
        assert got == set(want.values())


keys = st.sampled_from([f"k{i}" for i in range(12)])
labels = st.one_of(st.none(), st.sampled_from(["positive", "neutral", "negative"]))


@SETTINGS
@given(st.dictionaries(keys, st.tuples(labels, st.sampled_from(["a", "b"])), max_size=10),
       st.dictionaries(keys, st.tuples(labels, st.sampled_from(["x", "y"])), max_size=10),
       st.booleans())
def test_upsert_matches_on_conflict_model(spark, table, batch, touch_only):
    from reviewlake.operators.merge import upsert
    ddl = "review_id string, sentiment_label string, source string, ingested_at timestamp"
    t = spark.createDataFrame([(k, l, s, None) for k, (l, s) in table.items()], ddl)
    b = spark.createDataFrame([(k, l, s, None) for k, (l, s) in batch.items()], ddl)
    cols = () if touch_only else ("sentiment_label",)
    got = {r.review_id: (r.sentiment_label, r.source, r.ingested_at is not None)
           for r in upsert(t, b, "review_id", cols, now=F.current_timestamp()).collect()}
    want = {k: (l, s, False) for k, (l, s) in table.items()}
    for k, (l, s) in batch.items():
        if k in want:
            old_l, old_s, _ = want[k]
            want[k] = (old_l if touch_only else l, old_s, True)
        else:
            want[k] = (l, s, True)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([1.0, 2.5, 3.0, 5.0])), labels), min_size=0, max_size=60),
       st.integers(1, 4), st.integers(1, 7), st.sampled_from(["Lowest Rating", "Highest Rating"]))
def test_explorer_page_matches_python(spark, rows, page, per_page, sort_by):
    from reviewlake.operators.metrics import explorer_page
    data = [(f"r{i:03d}", r, l, "c", "en", "t") for i, (r, l) in enumerate(rows)]
    df = spark.createDataFrame(data, "review_id string, rating double, sentiment_label string, "
                                     "store_city string, language string, text string")
    desc = sort_by == "Highest Rating"
    ordered = sorted(data, key=lambda x: (x[1] is None, -(x[1] or 0) if desc else (x[1] or 0), x[0]))
    want = [x[0] for x in ordered][(page - 1) * per_page: page * per_page]
    got = [r.review_id for r in explorer_page(df, "All", sort_by, page, per_page).collect()]
    assert got == want
