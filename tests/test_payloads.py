"""Source normalisers on literal payloads (edge rows from FIXTURES §9)."""

import json

import pytest

from pyspark.sql import functions as F

from reviewlake.sources import payloads as P

FETCHED = "2026-03-01 12:00:00"


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl).withColumn("fetched_at", F.to_timestamp(F.lit(FETCHED)))


def test_feed(spark):
    entries = [
        {"id": {"label": "app"}, "title": {"label": "App"}},                       # header entry
        {"id": {"label": "1"}, "im:rating": {"label": "5"}, "title": {"label": "Great"},
         "content": {"label": "Works well."}, "updated": {"label": "2026-01-02T10:00:00-07:00"}},
        {"id": {"label": "2"}, "title": {"label": "No rating"}, "content": {"label": "dropped entirely"}},
        {"id": {"label": "3"}, "im:rating": {"label": "2"}, "title": {"label": "Bad"}, "content": {"label": "x"}},
        {"id": {"label": "4"}, "im:rating": {}, "title": {"label": "Default rating"},
         "content": {"label": "kept with 3"}},
    ]
    df = frame(spark, [(json.dumps({"feed": {"entry": entries}}), "br", "pt", "Lisbon"),
                       ("{not json", "br", "pt", "Lisbon")],
               "payload string, country string, lang string, city string")
    rows = {r.review_id: r for r in P.normalise_feed(df).collect()}
    assert set(rows) == {"as_1", "as_4"}
    assert rows["as_1"].text == "Great. Works well" and rows["as_1"].rating == 5.0
    assert rows["as_1"].date == "2026-01-02T10:00:00-07:00" and rows["as_1"].store_id == "appstore_br"
    assert rows["as_4"].rating == 3.0 and rows["as_4"].date == "2026-03-01T12:00:00"


def test_play(spark):
    recs = [{"reviewId": None, "score": 4.7, "content": "no id, first text", "at": None}, {"score": "4", "content": "no id, second text"},
            {"reviewId": "bad", "score": "bad", "content": "score is no number"},
            {"reviewId": "a", "score": None, "content": "long enough text", "at": None},
            {"reviewId": "b", "score": 1, "content": "too short", "at": "2026-01-01T00:00:00"},
            {"reviewId": "c", "score": 4, "content": None, "at": None}]
    df = frame(spark, [(json.dumps(r), "gb", "en", "London") for r in recs],
               "payload string, country string, lang string, city string")
    good, bad = P.normalise_play(df, rejects=True)
    rows = {r.text: r for r in good.collect()}
    assert {t: r.rating for t, r in rows.items()} == {"no id, first text": 4.7, "no id, second text": 4.0, "long enough text": 3.0}
    assert rows["long enough text"].review_id == "gp_a" and rows["long enough text"].date == "2026-03-01T12:00:00"
    assert len({r.review_id for r in rows.values()}) == 3 and all(r.review_id.startswith("gp_") for r in rows.values())
    assert [(r.review_id, r.reject_reason) for r in bad.collect()] == [("gp_bad", "rating is not a number")]


def test_listing(spark):
    posts = [{"data": {"id": "p1", "selftext": "", "title": "A title that is long enough", "score": 101,
                       "created_utc": 0}},
             {"data": {"id": "p2", "selftext": "x" * 600, "title": "t", "score": 0, "created_utc": 1.5}},
             {"data": {"id": "p3", "selftext": "short", "title": "t", "score": 50}}]
    df = frame(spark, [(json.dumps({"data": {"children": posts}}), "running", "en")],
               "payload string, subreddit string, lang string")
    rows = {r.review_id: r for r in P.normalise_listing(df).collect()}
    assert set(rows) == {"rd_p1", "rd_p2"}
    assert rows["rd_p1"].text == "A title that is long enough" and rows["rd_p1"].rating == 5.0
    assert rows["rd_p1"].date == "1970-01-01T00:00:00" and rows["rd_p1"].store_city == "Online"
    assert len(rows["rd_p2"].text) == 600 and rows["rd_p2"].rating == 1.0
    odd = [{"data": {"id": f"s{i}", "selftext": "a text that is long enough", "score": s}} for i, s in enumerate((200.0, "200", "many"))]
    odd += [{"data": {"selftext": f"no id, but a text of its own {i}", "score": 1}} for i in range(2)]
    df = frame(spark, [(json.dumps({"data": {"children": odd}}), "running", "en")], "payload string, subreddit string, lang string")
    good, bad = P.normalise_listing(df, rejects=True)
    got = {r.review_id: r.rating for r in good.collect()}
    assert got["rd_s0"] == 5.0 and got["rd_s1"] == 5.0 and len(got) == 4
    assert [r.review_id for r in bad.collect()] == ["rd_s2"]


def test_review_pages_skip_broken_block(spark):
    good = {"review": [{"reviewRating": {"ratingValue": "4"}, "description": "Nice shop, fast",
                        "datePublished": "2026-01-05", "author": {"name": "ana"}},
                       {"description": "No rating or author given"},
                       {"description": "short"}]}
    html = ('<html><script type="application/ld+json">' + json.dumps(good) + "</script>"
            '<script type="application/ld+json">{broken</script>'
            '<script>var x = 1;</script></html>')
    df = frame(spark, [(html, "fr", "Paris")], "html string, lang string, city string")
    rows = P.normalise_review_pages(df).collect()
    assert sorted((r.text, r.rating) for r in rows) == [("Nice shop, fast", 4.0), ("No rating or author given", 3.0)]
    ids = {r.text: r.review_id for r in rows}
    assert ids["Nice shop, fast"].startswith("tp_") and len(ids["Nice shop, fast"]) == 3 + 32
    # deterministic: the same input gives the same ids on every run
    assert {r.review_id for r in P.normalise_review_pages(df).collect()} == set(ids.values())


def test_product_pages_type_filter(spark):
    item_list = {"@type": "ItemList", "itemListElement": [
        {"item": {"review": [{"reviewBody": "Sturdy and light frame", "reviewRating": {"ratingValue": "5"}}]}},
        {"item": {"review": [{"reviewBody": "tiny"}]}}]}
    other = {"@type": "Product", "itemListElement": [
        {"item": {"review": [{"reviewBody": "Should never appear here"}]}}]}
    html = ''.join('<script type="application/ld+json">' + json.dumps(x) + "</script>" for x in (other, item_list))
    df = frame(spark, [(html, "cycling", "pt", "Porto")], "html string, sport string, lang string, city string")
    rows = P.normalise_product_pages(df).collect()
    assert [(r.text, r.rating, r.store_id) for r in rows] == [("Sturdy and light frame", 5.0, "site_cycling")]


def test_topic_decode_flags_malformed(spark):
    from reviewlake.sources.topic import decode_records, encode_records
    df = spark.createDataFrame([("s1", 1, "ok"), ("", 2, "empty key")], "store_id string, n int, t string")
    enc = encode_records(df, "store_id")
    assert [r.key for r in enc.collect()] == [b"s1", None]
    bad = spark.createDataFrame([(b"k", b"{not json")], "key binary, value binary")
    rows = decode_records(enc.unionByName(bad), "store_id string, n int, t string").collect()
    assert [(r.key, r.n, r._malformed) for r in rows] == [("s1", 1, False), (None, 2, False), ("k", None, True)]


def test_length_boundaries_count_code_points(spark):
    """9 vs 10 characters (10 kept) and 19 vs 20 for the forum; an emoji is one character."""
    from reviewlake.operators.filters import min_length
    df = spark.createDataFrame([("a" * 9,), ("a" * 10,), ("👍" * 10,), ("é" * 9,), (None,)], "t string")
    assert sorted(r.t for r in min_length(df, "t", 10).collect()) == ["a" * 10, "👍" * 10]
    posts = [{"data": {"id": f"p{n}", "selftext": "x" * n, "score": 1}} for n in (19, 20)]
    lst = frame(spark, [(json.dumps({"data": {"children": posts}}), "s", "en")], "payload string, subreddit string, lang string")
    assert [r.review_id for r in P.normalise_listing(lst).collect()] == ["rd_p20"]


def test_bad_rating_rejects_only_that_item(spark):
    good = {"review": [{"reviewRating": {"ratingValue": "4"}, "description": "Fine shop overall"},
                       {"reviewRating": {"ratingValue": "four"}, "description": "Rating is not a number"},
                       {"reviewRating": {"ratingValue": "2.5"}, "description": "Kept after the bad one"}]}
    html = '<script type="application/ld+json">' + json.dumps(good) + "</script>"
    df = frame(spark, [(html, "en", "York")], "html string, lang string, city string")
    ok, bad = P.normalise_review_pages(df, rejects=True)
    assert sorted(r.text for r in ok.collect()) == ["Fine shop overall", "Kept after the bad one"]
    assert [r.text for r in bad.collect()] == ["Rating is not a number"]
    assert P.normalise_review_pages(df).count() == 2


def test_one_odd_item_does_not_take_its_block(spark):
    block = {"review": [{"author": "Bob", "description": "Author is a plain name", "reviewRating": 4},
                        {"author": {"name": "Ann"}, "description": "Author is an object", "reviewRating": {"ratingValue": 5}},
                        "just a string", {"description": "same undated text of nobody"}, {"description": "other undated text of nobody"}]}
    html = '<script type="application/ld+json">' + json.dumps(block) + "</script>"
    df = frame(spark, [(html, "en", "York")], "html string, lang string, city string")
    good, bad = P.normalise_review_pages(df, rejects=True)
    rows = good.collect()
    assert sorted(r.rating for r in rows) == [3.0, 3.0, 4.0, 5.0] and len({r.review_id for r in rows}) == 4
    assert [(r.text, r.reject_reason) for r in bad.collect()] == [("just a string", "item is not an object")]


def test_product_ids_cover_the_whole_body(spark):
    body = "x" * 60
    block = {"@type": "ItemList", "itemListElement": {"item": {"review": [{"reviewBody": body + "a"}, {"reviewBody": body + "b"}, {"reviewBody": body + "a"}]}}}
    html = '<script type="application/ld+json">' + json.dumps(block) + "</script>"
    rows = P.normalise_product_pages(frame(spark, [(html, "yoga", "en", "Rome")], "html string, sport string, lang string, city string")).collect()
    assert len(rows) == 3 and len({r.review_id for r in rows}) == 2


def test_equal_texts_on_two_products_have_two_ids(spark):
    from reviewlake.operators.setops import dedup_first
    rv = {"reviewBody": "Great product!"}
    items = [{"item": {"name": "Ball", "review": [rv, rv]}}, {"item": {"url": "/net", "name": "Ball", "review": rv}}, {"url": "/bat", "item": {"review": [rv]}},
             {"item": {"name": "Ball", "review": [rv | {"author": "Ann"}, rv | {"author": {"name": "Bob"}}, rv | {"author": {"name": "Ann"}}]}},
             {"item": {"review": [rv, rv | {"author": ""}]}}, {"item": {"review": [rv | {"author": "Ann"}]}}]
    html = '<script type="application/ld+json">' + json.dumps({"@type": "ItemList", "itemListElement": items}) + "</script>"
    rows = P.normalise_product_pages(frame(spark, [(html, "ball", "en", "Rome")], "html string, sport string, lang string, city string"))
    assert rows.count() == 10 and dedup_first(rows, "review_id", ["date"]).count() == 7


def test_bounded_options_limit_every_partition():
    from reviewlake.sources.topic import bounded_options
    o = bounded_options("reviews.raw", {0: 5, 1: 0}, {0: 900, 1: 30}, 200)
    assert json.loads(o["startingOffsets"]) == {"reviews.raw": {"0": 5, "1": 0}}
    assert json.loads(o["endingOffsets"]) == {"reviews.raw": {"0": 205, "1": 30}}


def test_feed_ends_at_the_first_empty_page(spark):
    """Entries behind a page without entries, or one that is no JSON, are
    rejected, in that country and city alone; a missing number is no end."""
    entry = '{"im:rating": {"label": "4"}, "title": {"label": "Fine shoes"}, "content": {"label": "good"}, "id": {"label": "%s"}}'
    page = '{"feed": {"entry": [{"id": {"label": "app"}}, ' + entry + "]}}"
    rows = [("fr", "x", 1, page % "a"), ("fr", "x", 2, '{"feed": {}}'), ("fr", "x", 3, page % "b"), ("fr", "x", 5, '{"feed": {"entry": []}}'),
            ("fr", "y", 3, page % "c"), ("de", None, 1, page % "d"), ("de", None, 4, "<html>"), ("de", None, 9, page % "e"),
            ("es", "z", 1, page % "f"), ("es", "z", 7, page % "g"), ("es", "z", None, page % "h"), ("pt", "w", 2, None), ("pt", "w", 3, page % "i")]
    df = spark.createDataFrame(rows, "country string, city string, page int, payload string") \
              .withColumn("lang", F.col("country")).withColumn("fetched_at", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    good, bad = P.normalise_feed(df, rejects=True)
    assert {r.review_id for r in good.collect()} == {"as_a", "as_c", "as_d", "as_f", "as_g", "as_h"}
    assert {(r.review_id, r.reject_reason) for r in bad.collect()} == {(f"as_{x}", P.LATE_PAGE) for x in "bei"}
    assert P.normalise_feed(df.drop("page")).count() == 9


@pytest.mark.parametrize("flag,columns,texts", [
    (P.flag_play, "payload string, country string, lang string, city string", 1),
    (P.flag_review_pages, "html string, lang string, city string", 2),
    (P.flag_product_pages, "html string, sport string, lang string, city string", 3),
])
def test_each_json_text_is_decoded_once(spark, flag, columns, texts):
    df = spark.createDataFrame([], columns).withColumn("fetched_at", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    df = spark.createDataFrame(df.rdd, df.schema).where("lang is not null")
    plan = flag(df)._jdf.queryExecution().optimizedPlan().toString()
    wide = [x for x in plan.split("from_json(")[1:] if not x.startswith("ArrayType(StringType")]
    assert len(wide) == texts, plan


def _exchanges(df):
    """Exchanges of rows in the plan (not of broadcast ones)."""
    import re
    return re.findall(r"Exchange (hashpartitioning\S*)", df._jdf.queryExecution().executedPlan().toString())


def test_texts_move_once_to_their_pages(spark, sf):
    from reviewlake.plans.queries_more import landed_sources
    from reviewlake.sources import landing as L
    from reviewlake.sources import payloads as P
    from reviewlake.sources.tables import classified_reviews, stage
    base = stage(classified_reviews(spark, sf), "base")
    assert len(_exchanges(L.product_page_payloads(spark, sf, base))) == 1
    with landed_sources(spark, sf) as landed:
        for name in ("play", "feed", "review_pages", "product_pages"):
            assert not _exchanges(landed[name])
        plan = P.flag_feed(landed["feed"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        for name, alone in (("feed", L.feed_payloads), ("product_pages", L.product_page_payloads)):
            assert sorted(map(repr, landed[name].collect())) == sorted(map(repr, alone(spark, sf, base).collect()))
