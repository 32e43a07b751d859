"""Readers for the driver's parquet tables and the ``reviews`` adapter.

The adapter turns the generic tables into review rows so every operator
can be checked against an independent SQL oracle on the same data:

* ``documents`` gives id, source, language, a length used for rating and
  score, and the text: an own phrase, then the whole document text;
* ``orders`` (same key, left join) gives the review date;
* ``nation`` (25-row dimension, ``doc_id % 25``) gives the city;
* ``labels`` (left join) gives the sentiment label.

Nulls in city, rating, date and label appear on purpose (every 89th / 97th
/ 83rd row, unlabeled docs) so null handling is exercised at every scale.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed review phrases (own wording).  Index = doc_id % 20.  They cover
# every keyword category, both emotion fallbacks, substring traps and
# texts that match nothing.
PHRASES: list[str] = [
    "Marathon pace training went well",
    "The bike frame bent on day two",
    "New gym gloves feel solid",
    "Trekking poles are light",
    "The swim cap ripped",
    "Soccer socks shrank",
    "Pilates mat smells odd",
    "Kayak seat is fine",
    "Login fails on every update",
    "I am happy with this",
    "Very disappointed by staff",
    "What a great shop",
    "Useless zipper",
    "It is a plain box",
    "Surface is smooth",
    "Wool hat, grey",
    "Truly brilliant colour",
    "Worst queue so far",
    "The strap is long",
    "Grey bottle, 1 litre",
]

# Fixed-domain dimension: TPC-H nation has 25 rows at every scale factor.
NATION_MAX_ROWS = 25


# One DataFrame handle per (session, input table): the driver's tables are
# read-only, so the file listing and footer reads happen once per session.
_TABLES: dict[tuple[int, str], DataFrame] = {}
_SMALL: dict[tuple[int, str, int], bool] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _TABLES.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


def clear_table_cache() -> None:
    _TABLES.clear()
    _SMALL.clear()


def bounded_broadcast(df: DataFrame, max_rows: int, cache_key: str | None = None) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check is a ``limit(max_rows + 1).count()`` (reads at most one
    partition's worth); with ``cache_key`` (a read-only input) it runs once
    per session.  Above the bound the frame is returned unhinted and the
    planner picks a shuffle join.
    """
    key = (id(df.sparkSession), cache_key, max_rows) if cache_key else None
    small = _SMALL.get(key) if key else None
    if small is None:
        small = df.limit(max_rows + 1).count() <= max_rows
        if key:
            _SMALL[key] = small
    return F.broadcast(df) if small else df


def phrase_for(doc_id: Column) -> Column:
    from reviewlake.functions.text import pick
    return pick(F.array(*[F.lit(p) for p in PHRASES]), (doc_id % F.lit(len(PHRASES))).cast("int") + F.lit(1))


def review_text(doc_id: Column, text: Column) -> Column:
    """The phrase of a document, then its whole text on the next line."""
    return F.concat(phrase_for(doc_id), F.coalesce(F.concat(F.lit("\n"), text), F.lit("")))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``reviews`` adapter view (see module doc).

    Columns: review_id, source, store_id, store_city, rating, text,
    language, date, sentiment_label, sentiment_score, doc_id.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars",
                                                     F.col("text").alias("d_text"))
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    nation = bounded_broadcast(
        read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), NATION_MAX_ROWS,
        cache_key=f"{sf_dir}/nation")

    # Both big joins are on the same key (doc_id), so the planner reuses one
    # hash partitioning for them; the nation lookup is a broadcast that
    # keeps it.
    j = (d.join(orders, d.doc_id == orders.o_orderkey, "left")
          .join(labels, d.doc_id == labels.l_doc_id, "left")
          .join(nation, (d.doc_id % 25).cast("int") == nation.n_nationkey, "inner"))
    doc_id = F.col("doc_id")
    return j.select(
        F.concat(F.lit("r_"), doc_id.cast("string")).alias("review_id"),
        F.col("source"),
        F.concat(F.lit("store_"), (doc_id % 25).cast("string")).alias("store_id"),
        F.when(doc_id % 89 != 0, F.col("n_name")).alias("store_city"),
        F.when(doc_id % 97 != 0, (F.lit(1.0) + (F.col("n_chars") % 9) * F.lit(0.5)).cast("double")).alias("rating"),
        review_text(doc_id, F.col("d_text")).alias("text"),
        F.col("lang").alias("language"),
        F.when(doc_id % 83 != 0, F.col("o_orderdate")).alias("date"),
        F.when(F.col("toxic") == 1, F.lit("negative"))
         .when(F.col("quality") == 1, F.lit("positive"))
         .when(F.col("quality") == 0, F.lit("neutral")).alias("sentiment_label"),
        (((F.col("n_chars") % 5) - F.lit(2)).cast("double") / F.lit(2.0)).alias("sentiment_score"),
        doc_id,
    )


_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder
    and read it back: several consumers then share one computation, and the
    lineage is cut (a lost executor re-reads the table instead of
    recomputing the joins behind it).  Texts take up most of it: zstd.
    Inside ``passing_tables`` it lives until that ends, unless ``keep``."""
    from reviewlake.session import scratch_path, shuffles_dropped
    path, passing = scratch_path(df.sparkSession, name), _STAGED.get()
    if passing is not None and not keep:
        passing.append(path)
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


SLICE = "_slice"        # of a table stored in a folder for each of a few hash values of its key


def sliced(df: DataFrame, name: str, key: str, count: int) -> Iterator[DataFrame]:
    """Write ``df`` once, dealt into ``count`` folders by a hash of ``key`` (the
    rows of a key lie in one of them), and read them back one at a time.  A
    folder is deleted when the next one is asked for, so that what is made of
    the rows takes the room on disk that they leave."""
    from reviewlake.session import drop_scratch, scratch_path, shuffles_dropped
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    dealt = df.withColumn(SLICE, F.pmod(F.hash(key), F.lit(count)))
    try:
        with shuffles_dropped(spark):
            dealt.write.mode("overwrite").option("compression", "zstd").partitionBy(SLICE).parquet(path)
        for k in range(count):
            yield spark.read.schema(dealt.schema).parquet(path).where(F.col(SLICE) == k).drop(SLICE)
            drop_scratch(spark, f"{path}/{SLICE}={k}")
    finally:
        drop_scratch(spark, path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """The tables staged inside are deleted at the end: for steps whose result
    is stored with ``stage(..., keep=True)`` or written before it."""
    from reviewlake.session import drop_scratch
    token = _STAGED.set([])
    try:
        yield
    finally:
        paths = _STAGED.get()
        _STAGED.reset(token)
        for path in paths:
            drop_scratch(spark, path)


def classified_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter rows with ``sport_category`` from the keyword cascade."""
    from reviewlake.operators.classify import with_keyword_category
    return with_keyword_category(reviews(spark, sf_dir), "text", "sport_category", fill="other")
