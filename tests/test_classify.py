"""Keyword cascade: phrase expectations, traps, nulls, pruning exactness,
agreement with a plain first-match loop on real document text."""

from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.operators.classify import keyword_rules, with_keyword_category
from reviewlake.sources.tables import PHRASES

EXPECTED = ["running", "cycling", "fitness", "hiking", "swimming", "football", "yoga", "water_sports",
            "app_delivery", "app_delivery", "app_delivery", "positive_experience", "negative_experience",
            None, "water_sports", None, "positive_experience", "negative_experience", None, None]


def first_match(text):
    """Brute force: the rule as stated, on the unpruned lists."""
    if text is None:
        return None
    t = text.lower()
    for cat, words in C.SPORT_KEYWORDS:
        if any(w in t for w in words):
            return cat
    if any(w in t for w in C.POSITIVE_EMOTIONS):
        return C.POSITIVE_EXPERIENCE
    if any(w in t for w in C.NEGATIVE_EMOTIONS):
        return C.NEGATIVE_EXPERIENCE
    return None


def test_phrases(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(PHRASES)], "i int, text string")
    got = {r.i: r.c for r in with_keyword_category(df, "text", "c", fill=None).collect()}
    assert [got[i] for i in range(len(PHRASES))] == EXPECTED
    assert [first_match(p) for p in PHRASES] == EXPECTED


def test_null_and_fill(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "ÓTIMO produto")], "i int, text string")
    got = {r.i: r.c for r in with_keyword_category(df, "text", "c", fill="other").collect()}
    assert got == {1: "other", 2: "other", 3: "positive_experience"}


def test_overwrites_existing_column(spark):
    df = spark.createDataFrame([("bike ride", "hiking")], "text string, c string")
    assert with_keyword_category(df, "text", "c").first().c == "cycling"


def test_pruning_is_exact():
    """Every dropped word contains a kept word of the same or an earlier category."""
    pruned = dict(keyword_rules())
    order = [c for c, _ in keyword_rules()]
    full = [(c, list(w)) for c, w in C.SPORT_KEYWORDS] + [
        (C.POSITIVE_EXPERIENCE, C.POSITIVE_EMOTIONS), (C.NEGATIVE_EXPERIENCE, C.NEGATIVE_EMOTIONS)]
    for i, (cat, words) in enumerate(full):
        allowed = [w for c in order[: i + 1] for w in pruned[c]]
        for w in words:
            assert w in pruned[cat] or any(k in w for k in allowed), (cat, w)


def test_matches_brute_force_on_documents(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: first_match(r.text) for r in d.collect()}
    for native in (False, True):
        assert {r.doc_id: r.c for r in with_keyword_category(d, "text", "c", fill=None, native=native).collect()} == want


def test_nested_and_overlapping_words(spark):
    """Words inside words, over each other's ends, equal in two categories,
    and texts that end inside a word."""
    rules = [("a", ["abcd", "xyz", "é b"]), ("b", ["bc", "yzw", "same", "zz"]), ("c", ["c", "same", "bcde", "\U0001F600"])]
    texts = ["abcd", "abc", "xbcdey", "xyzw", "yzw", "same", "sam", "c", "é b", "é  b", "x\U0001F600", "zzz", "", None, "ABCD", "d" * 100_000 + "bc", "xy"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    want = {i: None if t is None else next((n for n, ws in rules if any(w in t.lower() for w in ws)), None) for i, t in enumerate(texts)}
    for native in (False, True):
        assert {r.i: r.c for r in with_keyword_category(df, "text", "c", fill=None, rules=rules, native=native).collect()} == want


def test_filter_on_category(spark, sf):
    from reviewlake.sources.tables import reviews
    want = sum(first_match(r.text) is None for r in reviews(spark, sf).select("text").collect())
    for native in (False, True):
        df = with_keyword_category(reviews(spark, sf), "text", "c", fill=None, native=native).where(F.col("c").isNull())
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert ("ArrowEvalPython" in plan) != native and df.count() == want > 0


def test_only_the_text_crosses_to_python(spark, sf):
    from reviewlake.sources.tables import classified_reviews
    df = classified_reviews(spark, sf).groupBy("sport_category").agg(F.avg("rating"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    scan = next(x for x in plan.splitlines() if "ArrowEvalPython" in x)
    assert scan.count("category(") == 1 and "store_id" not in plan
