"""Composed jobs: gates, the processing job, the batch load."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators.cascade import ENRICHED, enrich
from reviewlake.operators.merge import UPDATE_SENTIMENT, known_once, upsert
from reviewlake.operators.projections import split_rejects, unfit_numbers, with_text_features
from reviewlake.operators.setops import dedup_first, union_sources
from reviewlake.session import shuffles_dropped
from reviewlake.sources.tables import SLICE, sliced, stage
from reviewlake.sources.topic import encode_records


def require_nonempty(df: DataFrame, what: str = "input") -> DataFrame:
    """Lazy gate: one row ``n`` = row count; evaluating it fails the job
    (``raise_error``) when the input is empty."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.when(F.col("n") == 0, F.raise_error(F.lit(f"no rows in {what}"))).otherwise(F.col("n"))
                    .cast("long").alias("n"))


def output_check(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """Gate on a job's output: the table (or folder) must exist; returns its
    row count (a zero count passes, as an existing empty table)."""
    if table is not None:
        if not spark.catalog.tableExists(table):
            raise ValueError(f"output table {table} was not created")
        df = spark.table(table)
    else:
        df = spark.read.parquet(path)   # raises when the folder does not exist
    return df.agg(F.count(F.lit(1)).alias("n"))


def processing_job(spark: SparkSession, stored: DataFrame, out_path: str) -> dict:
    """Gate → three derived columns → overwrite → verify.

    The written row count is observed during the write (no second scan of
    the source)."""
    n_in = require_nonempty(stored, "reviews").first()["n"]
    obs = Observation("processed")
    out = with_text_features(stored, "review_text").observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").parquet(out_path)
    n_out = output_check(spark, path=out_path).first()["n"]
    return {"input_rows": n_in, "written_rows": obs.get["rows"], "verified_rows": n_out}


SLICE_BYTES, MAX_SLICES = 16_000_000, 6


def slices_for(size: int) -> int:
    """In how many slices to store what comes from so many bytes of input."""
    return max(1, min(MAX_SLICES, size // SLICE_BYTES))


def batch_load(spark: SparkSession, sources: list[DataFrame], table: DataFrame | None = None,
                   lexicon=None, ingested_at=None, topic_path: str | None = None,
                   reject_path: str | None = None, item_reject_path: str | None = None,
                   load_path: str | None = None, slices: int = 1,
                   sources_read: Callable[[], None] | None = None) -> DataFrame:
    """collect (union + first occurrence) → sentiment + category → publish
    (encoded records appended to ``topic_path`` when given) → load (upsert
    into ``table``, or the first load).  Returns the loaded table.

    Rows without an id, and rows whose numbers do not fit the stored types,
    do not load; with ``reject_path`` they are appended there.  With
    ``item_reject_path`` the sources are flagged ones (see ``flag_sources``):
    items that cannot be reviews are appended there, with source and reason.

    With ``load_path`` a first load is stored there, in ``slices`` by a hash of
    the id (more than one: in a folder each, and with their column ``SLICE``);
    the working rows of a slice go once it is published and stored.

    The sources are read once, in the write of their enriched rows; for an
    upsert that publishes nothing once more before it, for the ids alone (see
    ``_without_known_texts``).  ``sources_read`` is called after that."""
    if load_path and table is not None:
        raise ValueError("load_path is for a first load")
    union = union_sources(sources)
    flags = ["reject_reason", "reject_source"] if item_reject_path else []
    columns = [c for c in union.columns if c not in ("source_priority", *flags)]
    # duplicates are told apart by the columns as they came, also by those that enrich() sets anew
    given = {c: f"_given_{c}" for c in columns if c in ENRICHED}
    # duplicates, publishing, rejects, the key check and the joins of the upsert
    # read the enriched rows: they are written once to the shared checkpoint
    # folder and read back (survives executor loss, cuts the lineage)
    rows = enrich(union.withColumnsRenamed(given), "text", lexicon)
    as_given = [F.col(given.get(c, c)).alias(c) for c in columns]

    def publish(rows: DataFrame) -> DataFrame:
        """Writes what ``rows`` hold besides the rows to store, which it returns."""
        if item_reject_path:
            rows.where(F.col("reject_reason").isNotNull()).select(*as_given, *flags).write.mode("append").parquet(item_reject_path)
            rows = rows.where(F.col("reject_reason").isNull()).drop(*flags)
        collected = dedup_first(rows.where(F.col("review_id").isNotNull()), "review_id", ["source_priority", "date"],
                                strategy="repeated")
        enriched = collected.select(*columns, *[c for c in ENRICHED if c not in columns])
        if topic_path:
            encode_records(enriched, "store_id").write.mode("append").option("compression", "zstd").parquet(topic_path)
        stored, unfit = split_rejects(enriched, ingested_at=ingested_at)
        if reject_path:
            no_id = rows.where(F.col("review_id").isNull()).select(*as_given)
            unfit.unionByName(no_id, allowMissingColumns=True).write.mode("append").parquet(reject_path)
        return stored

    if load_path:
        for k, part in enumerate(sliced(rows, "enriched", "review_id", slices)):
            if sources_read and not k:
                sources_read()
            with shuffles_dropped(spark):
                publish(part).write.option("compression", "zstd").parquet(f"{load_path}/{SLICE}={k}" if slices > 1 else load_path)
        return spark.read.parquet(load_path)
    with ExitStack() as until_stored:
        if table is not None and not topic_path:
            rows = until_stored.enter_context(_without_known_texts(rows, union, table, bool(flags)))
        rows = stage(rows, "enriched")
    if sources_read:
        sources_read()
    with shuffles_dropped(spark):
        stored = publish(rows)
    if table is None:
        return stored
    return upsert(table, stored, "review_id", UPDATE_SENTIMENT, now=ingested_at, strategy="touched",
                  slice_col=SLICE if SLICE in table.columns else None)


@contextmanager
def _without_known_texts(rows: DataFrame, union: DataFrame, table: DataFrame, rejects: bool) -> Iterator[DataFrame]:
    """Enriched ``rows`` of ``union``, the text null where nothing will read it:
    the upsert takes only the sentiment of a row whose id the batch holds once
    and ``table`` too.  Rejects and rows that share an id keep theirs."""
    good = F.col("reject_reason").isNull() if rejects else F.lit(True)
    with known_once(union.where(good).select("review_id"), table, "review_id") as flagged:
        unread = F.col("_unread") & good & ~unfit_numbers(rows)
        yield flagged(rows, "_unread").withColumn("text", F.when(~unread, F.col("text"))).drop("_unread")


def flag_sources(payloads: dict[str, DataFrame]) -> list[DataFrame]:
    """Landed payload frames (by source name, in collection order) → their
    items, each with ``reject_source`` and, if it cannot be a review, a
    ``reject_reason``.  Nothing is stored: for ``batch_load``, which reads them once."""
    from reviewlake.sources.payloads import FLAGGERS
    return [FLAGGERS[name](df).withColumn("reject_source", F.lit(name)) for name, df in payloads.items()]


def collect_sources(spark: SparkSession, payloads: dict[str, DataFrame], reject_path: str) -> list[DataFrame]:
    """Normalise landed payload frames (by source name, in collection order);
    items that cannot be reviews are appended to ``reject_path`` with their
    source and reason.  Each source is decoded once: its flagged rows are
    written to the shared checkpoint folder, and rejects and reviews read from there."""
    from reviewlake.sources.payloads import FLAGGERS
    flagged = {name: stage(FLAGGERS[name](df), f"flagged-{name}") for name, df in payloads.items()}
    rejects = None
    for name, df in flagged.items():
        bad = df.where(F.col("reject_reason").isNotNull()).withColumn("reject_source", F.lit(name))
        rejects = bad if rejects is None else rejects.unionByName(bad)
    if rejects is not None:
        rejects.write.mode("append").parquet(reject_path)
    return [df.where(F.col("reject_reason").isNull()).drop("reject_reason") for df in flagged.values()]


def scoring_run(df: DataFrame, text_col: str, model, output: str, metrics_path: str, run_id: str,
                model_name: str | None = None, max_chars: int | None = None) -> DataFrame:
    """Score every row with a star model (a fitted ``StarModel`` or a scorer
    factory), write the rows to ``output`` and append the run's metrics (with measured load and inference seconds and
    failure counts) to ``metrics_path``; returns the metric rows.

    The model runs once, in the write.  Load time is that of one scorer built
    on the driver, or of reading the fitted weights once; inference time is
    the wall time of the scoring write.  With a fitted model the rows are
    written without their text, and a text without a known word has failed."""
    import time

    from reviewlake.operators.metrics import run_metrics
    from reviewlake.operators.model_scoring import star_sentiment
    from reviewlake.operators.text_models import StarModel, score_stars, star_labels_of
    failures, fitted = Observation(), isinstance(model, StarModel)
    t0 = time.perf_counter()
    _ = model.words.count() if fitted else model()
    loaded = time.perf_counter() - t0
    t0 = time.perf_counter()
    if fitted:
        text = F.col(text_col) if max_chars is None else F.substring(text_col, 1, max_chars)
        named = df.withColumn(text_col, text).withColumn("_has_text", F.col(text_col).isNotNull())
        stars = score_stars(named, model, text_col, stars_col="_stars").observe(
            failures, F.count_if("_has_text").alias("scored"), F.count_if(F.col("_has_text") & F.col("_stars").isNull()).alias("failed"))
        scored = star_labels_of(stars, "_stars").drop("_stars", "_has_text")
    else:
        scored = star_sentiment(df, text_col, model, max_chars=max_chars, failures=failures)
    scored.write.mode("overwrite").parquet(output)
    spent = time.perf_counter() - t0
    scored = df.sparkSession.read.parquet(output)
    rows = run_metrics(scored, run_id, load_seconds=loaded, inference_seconds=spent, model_name=model_name,
                       extra={"scored_rows": failures.get["scored"], "failed_rows": failures.get["failed"]})
    rows.write.mode("append").parquet(metrics_path)
    return df.sparkSession.read.parquet(metrics_path).where(F.col("run_id") == run_id)


def load_reviews(spark: SparkSession, path: str, policy: str = "fill", multiline: bool = False) -> DataFrame:
    """A review file with the sentiment columns decided by ``policy`` from the
    columns that the file has (see ``apply_sentiment_policy``)."""
    from pyspark.sql.types import StructType

    from reviewlake.operators.projections import apply_sentiment_policy
    from reviewlake.schema import MODEL_FIELDS, REVIEW, SENTIMENT_FIELDS
    from reviewlake.sinks.files import read_json_present
    optional = SENTIMENT_FIELDS + MODEL_FIELDS
    rows = read_json_present(spark, path, StructType(REVIEW.fields + optional), [f.name for f in optional], multiline)
    return apply_sentiment_policy(rows, policy)
