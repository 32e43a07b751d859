"""Normalisers: landed raw payloads → canonical ``REVIEW`` rows.

Each source lands one payload text per row (JSON document or HTML page)
plus context columns (country / lang / city / subreddit / sport) and the
``fetched_at`` timestamp of the download.  Normalising is a pure
column pipeline: ``from_json`` → ``explode``/``posexplode`` → predicates
→ projection, each JSON text decoded once (a feed with
page numbers a second time, to find its last page).  Only HTML leaves the JVM, for
its script blocks; a payload that is not JSON yields no rows (``PERMISSIVE`` null), never an exception.  An item that cannot be a
review (a rating that is no number, an item that is no object) is flagged
with ``reject_reason`` and leaves alone: ``flag_*`` keep it, ``normalise_*``
drop it or return it as a second frame, and jobs write it to a reject output.

Defaults that depended on the wall clock now come from ``fetched_at`` so
reruns are deterministic; ids built from hashes use the full-width
MD5 (stable across runs and processes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C
from reviewlake.functions.html import script_blocks
from reviewlake.functions.jsonfn import bind, decode
from reviewlake.functions.numeric import vote_to_rating
from reviewlake.functions.text import hash_id, nullif_empty, strip_chars
from reviewlake.functions.timefn import epoch_to_ts, iso
from reviewlake.schema import (
    FEED_PAYLOAD, LISTING_PAYLOAD, PLAY_REVIEW, PRODUCT_ITEM, PRODUCT_PAGE_LD, PRODUCT_REVIEW, REVIEW, REVIEW_ITEM,
    REVIEW_PAGE_LD,
)

OUT_COLS = [f.name for f in REVIEW.fields]
LATE_PAGE = "page after the first empty page"


def _review(review_id: Column, source: str, store_id: Column, store_name: Column, city: Column,
            rating: Column, text: Column, lang: Column, date: Column, fetched_at: Column) -> list[Column]:
    return [
        review_id.alias("review_id"),
        F.lit(source).alias("source"),
        store_id.alias("store_id"),
        store_name.alias("store_name"),
        city.cast("string").alias("store_city"),
        rating.cast("double").alias("rating"),
        text.alias("text"),
        lang.cast("string").alias("language"),
        date.cast("string").alias("date"),
        F.lit(C.OTHER).alias("sport_category"),
        iso(fetched_at).alias("collected_at"),
    ]


def _content_id(prefix_: str, *parts: Column) -> Column:
    """Id of a row without one of its own: prefix + MD5 over whole content."""
    return hash_id(prefix_, F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]))


def _split(rows: DataFrame, rejects: bool):
    """Rows whose ``reject_reason`` is null, or with ``rejects`` also the
    others: only the odd item leaves, never its page."""
    good = rows.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return (good, rows.where(F.col("reject_reason").isNotNull())) if rejects else good


def _number(text: Column, default: float) -> Column:
    """Number in a payload: missing → ``default``, not a number → null."""
    return F.coalesce(text, F.lit(str(default))).try_cast("double")


def _reason(rating: Column, bad_item: Column | None = None) -> Column:
    r = F.when(rating.isNull(), F.lit("rating is not a number"))
    return (r if bad_item is None else F.when(bad_item, F.lit("item is not an object")).otherwise(r)).alias("reject_reason")


def _items(json_text: Column) -> Column:
    """A JSON array's items (or the one object in its place) as JSON texts."""
    return F.when(F.ltrim(json_text).startswith("["), F.from_json(json_text, "array<string>")) \
            .otherwise(F.when(json_text.isNotNull(), F.array(json_text)))


def _field(json_text: Column, name: str) -> Column:
    """``name`` of a nested object, or the plain value that stands for it."""
    return F.when(F.ltrim(json_text).startswith("{"), F.get_json_object(json_text, f"$.{name}")).otherwise(json_text)


def flag_feed(df: DataFrame, payload: str = "payload") -> DataFrame:
    """App-store review feed pages, with ``reject_reason``.

    Entry 0 is app information and is skipped; entries without a rating
    object are dropped; text = ``"{title}. {content}"`` stripped of dots and
    spaces at both ends, at least 10 characters; id ``as_`` + entry id.
    Context: ``country``, ``lang``, ``city``, ``fetched_at``, and ``page``
    where pages are numbered: collecting a country and city ends at its
    first page without entries (or that is not JSON), so entries of later
    pages are rejected.
    """
    late = F.lit(False)
    if "page" in df.columns:
        df, late = _with_last_page(df, payload), F.col("page") > F.col("_last_page")
    e = (df.select("*", F.posexplode(decode(F.col(payload), FEED_PAYLOAD)["feed"]["entry"]).alias("pos", "entry"))
           .where((F.col("pos") > 0) & F.col("entry")["im:rating"].isNotNull()))
    text = strip_chars(F.concat(F.coalesce(e.entry["title"]["label"], F.lit("")), F.lit(". "),
                                F.coalesce(e.entry["content"]["label"], F.lit(""))), ". ")
    e = e.withColumn("_text", text).where(F.length("_text") >= C.MIN_TEXT_LENGTH)
    updated, rating = e.entry["updated"]["label"], _number(e.entry["im:rating"]["label"], C.DEFAULT_RATING)
    own = F.concat(F.lit("as_"), e.entry["id"]["label"])
    return e.select(*_review(
        F.coalesce(own, _content_id("as_", F.col("country"), F.col("_text"), updated, e.entry["im:rating"]["label"])), "app_store",
        F.concat(F.lit("appstore_"), F.col("country")),
        F.concat(F.lit("App Store ("), F.col("city"), F.lit(")")),
        F.col("city"), rating, F.col("_text"), F.col("lang"),
        F.coalesce(updated, iso(F.col("fetched_at"))), F.col("fetched_at")),
        F.when(late, F.lit(LATE_PAGE)).otherwise(_reason(rating)).alias("reject_reason"))


def _with_last_page(df: DataFrame, payload: str) -> DataFrame:
    """``df`` with ``_last_page``: the first page without entries of the row's
    country and city, null where there is none (or no page number)."""
    entries = decode(F.col(payload), FEED_PAYLOAD)["feed"]["entry"]
    stops = (df.where(F.coalesce(F.size(entries), F.lit(0)) <= 0)
               .groupBy(F.col("country").alias("_country"), F.col("city").alias("_city")).agg(F.min("page").alias("_last_page")))
    on = F.col("country").eqNullSafe(F.col("_country")) & F.col("city").eqNullSafe(F.col("_city"))
    # one row per country and city at most: the payloads stay where they are
    return df.join(F.broadcast(stops), on, "left").drop("_country", "_city")


def flag_play(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Play-store reviews (one JSON object per row), with ``reject_reason``.

    Content of at least 10 characters; score default 3; date default the
    fetch time; id ``gp_`` + review id, or a hash of the whole content.
    Context: ``country``, ``lang``, ``city``, ``fetched_at``.
    """
    r = bind(df, "r", decode(F.col(payload), PLAY_REVIEW))
    r = r.where(F.length(r.r["content"]) >= C.MIN_TEXT_LENGTH)
    rating = _number(r.r["score"], C.DEFAULT_RATING)
    own = F.concat(F.lit("gp_"), r.r["reviewId"])
    return r.select(*_review(
        F.coalesce(own, _content_id("gp_", F.col("country"), F.col("city"), r.r["content"], r.r["at"], r.r["score"])), "google_play",
        F.concat(F.lit("app_"), F.col("country")),
        F.concat(F.lit("App ("), F.col("city"), F.lit(")")),
        F.col("city"), rating, r.r["content"], F.col("lang"),
        F.coalesce(r.r["at"], iso(F.col("fetched_at"))), F.col("fetched_at")), _reason(rating))


def flag_listing(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Forum search listing, with ``reject_reason``.

    Text = the whole self text, or the title when the self text is empty, at
    least 20 characters; vote score → 1..5 rating; creation epoch → UTC ISO
    date; city ``Online``; id ``rd_`` + post id, or a hash of the whole
    content.  Context: ``subreddit``, ``lang``, ``fetched_at``.
    """
    p = df.select("*", F.explode(decode(F.col(payload), LISTING_PAYLOAD)["data"]["children"]).alias("c"))
    d = p.c["data"]
    text = F.coalesce(nullif_empty(d["selftext"]), d["title"], F.lit(""))
    p = p.withColumn("_text", text).where(F.length("_text") >= C.MIN_FORUM_TEXT_LENGTH)
    score, created = _number(d["score"], 0), d["created_utc"].try_cast("double")
    own = F.concat(F.lit("rd_"), d["id"])
    return p.select(*_review(
        F.coalesce(own, _content_id("rd_", F.col("subreddit"), d["title"], F.col("_text"), d["created_utc"])), "reddit",
        F.concat(F.lit("reddit_"), F.col("subreddit")),
        F.concat(F.lit("Forum r/"), F.col("subreddit")),
        F.lit(C.FORUM_CITY), F.when(score.isNotNull(), vote_to_rating(score)), F.col("_text"), F.col("lang"),
        iso(epoch_to_ts(F.coalesce(created, F.lit(0.0)))), F.col("fetched_at")), _reason(score))


def _ld_documents(df: DataFrame, html: str, schema) -> DataFrame:
    """One row per JSON-LD script block of each page, decoded with ``schema``;
    blocks that are not JSON are skipped."""
    s = df.select("*", F.explode(script_blocks(F.col(html))).alias("_script"))
    s = bind(s, "_ld", decode(F.col("_script"), schema, corrupt=True))
    return s.where(F.col("_ld").isNotNull() & F.col("_ld")["_corrupt_record"].isNull())


def flag_review_pages(df: DataFrame, html: str = "html") -> DataFrame:
    """Review-site pages: every ``review`` of every JSON-LD block, with
    ``reject_reason``.

    Items are decoded one by one; an author may be an object or a name.
    Description of at least 10 characters; rating default 3; author default
    ``anon``; date default the fetch time; id ``tp_`` + hash of author, date
    and whole text.  Context: ``lang``, ``city``, ``fetched_at``.
    """
    s = _ld_documents(df, html, REVIEW_PAGE_LD)
    r = s.select("*", F.explode(_items(F.col("_ld")["review"])).alias("_item"))
    r = bind(r, "rv", decode(F.col("_item"), REVIEW_ITEM))
    odd = ~F.ltrim(F.col("_item")).startswith("{") | F.col("_item").isNull()
    r = r.where(odd | (F.length(r.rv["description"]) >= C.MIN_TEXT_LENGTH))
    date = F.coalesce(r.rv["datePublished"], iso(F.col("fetched_at")))
    author = F.coalesce(_field(r.rv["author"], "name"), F.lit(C.DEFAULT_AUTHOR))
    rating = _number(_field(r.rv["reviewRating"], "ratingValue"), C.DEFAULT_RATING)
    text = F.when(odd, F.col("_item")).otherwise(r.rv["description"])
    return r.select(*_review(
        _content_id("tp_", author, date, text), "trustpilot",
        F.concat(F.lit("tp_"), F.col("lang")),
        F.concat(F.lit("Review site ("), F.col("city"), F.lit(")")),
        F.col("city"), rating, text, F.col("lang"), date, F.col("fetched_at")), _reason(rating, odd))


def flag_product_pages(df: DataFrame, html: str = "html") -> DataFrame:
    """Product pages: JSON-LD blocks of ``@type`` ItemList → items → reviews,
    with ``reject_reason``.

    Body of at least 10 characters; rating default 3; date default the
    fetch time; id ``dc_`` + hash of category, date, whole body and, where
    the page names them, product (``@id``, url, sku or name) and author.
    Without either, equal texts of one category and date share an id.
    Context: ``sport``, ``lang``, ``city``, ``fetched_at``.
    """
    s = _ld_documents(df, html, PRODUCT_PAGE_LD).where(F.col("_ld")["@type"] == "ItemList")
    items = s.select("*", F.explode(_items(F.col("_ld")["itemListElement"])).alias("_it"))
    items = bind(items, "_p", decode(F.col("_it"), PRODUCT_ITEM))
    r = items.select("*", F.explode(_items(F.col("_p")["item"]["review"])).alias("_item"))
    r = bind(r, "rv", decode(F.col("_item"), PRODUCT_REVIEW))
    odd = ~F.ltrim(F.col("_item")).startswith("{") | F.col("_item").isNull()
    r = r.where(odd | (F.length(r.rv["reviewBody"]) >= C.MIN_TEXT_LENGTH))
    date = F.coalesce(r.rv["datePublished"], iso(F.col("fetched_at")))
    rating = _number(_field(r.rv["reviewRating"], "ratingValue"), C.DEFAULT_RATING)
    text = F.when(odd, F.col("_item")).otherwise(r.rv["reviewBody"])
    p = F.col("_p")
    product = F.coalesce(*[nullif_empty(x) for x in (p["item"]["@id"], p["item"]["url"], p["url"], p["item"]["sku"], p["item"]["name"], p["name"])])
    author = nullif_empty(_field(r.rv["author"], "name"))
    named = F.when(product.isNotNull() | author.isNotNull(), F.concat_ws(
        "\x1f", text, F.coalesce(product, F.lit("\x00")), F.coalesce(author, F.lit("\x00"))))
    return r.select(*_review(
        _content_id("dc_", F.col("sport"), date, F.coalesce(named, text)), "product_site",
        F.concat(F.lit("site_"), F.col("sport")),
        F.concat(F.lit("Product site ("), F.col("sport"), F.lit(")")),
        F.col("city"), rating, text, F.col("lang"), date, F.col("fetched_at")), _reason(rating, odd))


def normalise_feed(df: DataFrame, payload: str = "payload", rejects: bool = False):
    return _split(flag_feed(df, payload), rejects)


def normalise_play(df: DataFrame, payload: str = "payload", rejects: bool = False):
    return _split(flag_play(df, payload), rejects)


def normalise_listing(df: DataFrame, payload: str = "payload", rejects: bool = False):
    return _split(flag_listing(df, payload), rejects)


def normalise_review_pages(df: DataFrame, html: str = "html", rejects: bool = False):
    return _split(flag_review_pages(df, html), rejects)


def normalise_product_pages(df: DataFrame, html: str = "html", rejects: bool = False):
    return _split(flag_product_pages(df, html), rejects)


FLAGGERS = {"play": flag_play, "feed": flag_feed, "review_pages": flag_review_pages, "listing": flag_listing,
            "product_pages": flag_product_pages}
