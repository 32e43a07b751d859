"""Command-line jobs (run with ``spark-submit`` or ``python -m reviewlake.cli``).

Each subcommand is one Spark job over files; the session comes from the
environment (cluster settings win; only unset values are filled).

    collect    landed payload folders → normalise, union, first per id → review file (+ rejects)
    analyze    review file → polarity + keyword category → parquet
    score      review file → star-model sentiment → parquet, run metrics appended
    classify   review file → keyword cascade (+ optional model) → parquet
    load       review file → upsert into a parquet review table → verification queries
    process    stored review table → length / lower / length band → parquet
    publish    review file → topic (kafka, or a file-backed topic folder)
    consume    topic → decoded review files (available-now stream, checkpointed) + rejects
    report     review file (enriched, or scored) → insight report
    export-csv review file → CSV for BI tools
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.schema import ENRICHED_REVIEW, REVIEW


def _read_reviews(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    from reviewlake.sinks.files import read_json
    return read_json(spark, path, ENRICHED_REVIEW, multiline=multiline)


def cmd_analyze(spark, a) -> None:
    from reviewlake.operators.cascade import enrich
    enrich(_read_reviews(spark, a.input, a.multiline), "text").write.mode("overwrite").parquet(a.output)


def _factory(spec: str | None):
    """``package.module:function`` → the scorer factory (None when not given)."""
    if not spec:
        return None
    import importlib
    mod, _, fn = spec.partition(":")
    return getattr(importlib.import_module(mod), fn)


def cmd_classify(spark, a) -> None:
    from reviewlake.operators.cascade import classify_cascade
    df = _read_reviews(spark, a.input, a.multiline)
    factory = _factory(a.model)
    classify_cascade(df, "text", "sport_category", factory, use_model=factory is not None) \
        .write.mode("overwrite").parquet(a.output)


def cmd_collect(spark, a) -> None:
    """Each source's landed payloads are parquet: payload or html text, its
    context columns and ``fetched_at``."""
    from reviewlake.operators.setops import dedup_first, union_sources
    from reviewlake.plans.jobs import collect_sources
    from reviewlake.sinks.files import write_json
    given = {"play": a.play, "feed": a.feed, "review_pages": a.review_pages, "listing": a.listing, "product_pages": a.product_pages}
    frames = collect_sources(spark, {k: spark.read.parquet(p) for k, p in given.items() if p}, a.rejects)
    if not frames:
        raise SystemExit("no payload folder given")
    write_json(dedup_first(union_sources(frames), "review_id", ["source_priority", "date"]).drop("source_priority"), a.output)


def cmd_score(spark, a) -> None:
    from reviewlake.plans.jobs import scoring_run
    scoring_run(_read_reviews(spark, a.input, a.multiline), "text", _factory(a.model), a.output, a.metrics, a.run_id, a.model,
                a.max_chars).show(50, truncate=False)


def cmd_export_csv(spark, a) -> None:
    from reviewlake.sinks.files import write_csv
    write_csv(_read_reviews(spark, a.input, a.multiline), a.output)


def cmd_load(spark, a) -> None:
    """The merged table is written beside the old one first, then over it; a
    run that dies in between leaves the copy named in the message."""
    from reviewlake.operators import metrics as M
    from reviewlake.operators.merge import UPDATE_SENTIMENT, UPDATE_TOUCH_ONLY, upsert
    from reviewlake.operators.projections import split_rejects
    from reviewlake.operators.setops import dedup_first
    from reviewlake.plans.jobs import load_reviews
    from reviewlake.session import scratch_path
    from reviewlake.sinks.files import first_available
    from reviewlake.sources.tables import stage
    rows = load_reviews(spark, a.input, "fill", a.multiline).where("review_id is not null")
    batch, rejects = split_rejects(dedup_first(rows, "review_id", ["date"]))
    if a.rejects:
        rejects.write.mode("append").parquet(a.rejects)
    _, table = first_available(spark, [a.table], lambda s, p: s.read.parquet(p))
    merged = batch if table is None else upsert(table, stage(batch, "load-batch"), "review_id", UPDATE_TOUCH_ONLY if a.touch_only else UPDATE_SENTIMENT)
    copy = scratch_path(spark, "load")
    merged.write.parquet(copy)
    print(f"new table staged in {copy}")
    spark.read.parquet(copy).write.mode("overwrite").parquet(a.table)
    spark.catalog.refreshByPath(a.table)
    stored = spark.read.parquet(a.table)
    for title, df in [("total", M.verify_total(stored)), ("avg rating", M.verify_avg_rating(stored)),
                      ("by sentiment", M.verify_by_sentiment(stored)), ("by city", M.verify_by_city(stored))]:
        print(title)
        df.show(50, truncate=False)


def cmd_process(spark, a) -> None:
    from reviewlake.plans.jobs import processing_job
    out = processing_job(spark, spark.read.parquet(a.input), a.output)
    print(out)


def cmd_publish(spark, a) -> None:
    from reviewlake.sources.topic import encode_records, write_topic
    recs = encode_records(_read_reviews(spark, a.input, a.multiline), "store_id")
    if a.format == "kafka":
        write_topic(recs, a.topic, "kafka", {"kafka.bootstrap.servers": a.servers})
    else:
        write_topic(recs, a.topic, a.format, path=a.path)


def cmd_consume(spark, a) -> None:
    from reviewlake.streaming.ingest import ingest, read_topic_stream
    opts = {"subscribe": a.topic, "kafka.bootstrap.servers": a.servers} if a.format == "kafka" else {}
    schema = None if a.format == "kafka" else spark.read.format(a.format).load(a.path).schema
    stream = read_topic_stream(spark, a.format, schema, opts, None if a.format == "kafka" else a.path,
                               max_per_trigger=a.max_per_trigger)
    q, got = ingest(stream, REVIEW, a.output, a.checkpoint, a.rejects)
    q.awaitTermination()
    print(f"received {got.records} records, {got.malformed} malformed")


def cmd_report(spark, a) -> None:
    from reviewlake.operators.metrics import insight_report, star_report
    if a.scored:
        star_report(spark.read.parquet(a.input)).show(100, truncate=False)
        return
    df = _read_reviews(spark, a.input, a.multiline).withColumn(
        "sport_category", F.coalesce("sport_category", F.lit("other")))
    insight_report(df).show(100, truncate=False)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="reviewlake")
    sub = p.add_subparsers(dest="cmd", required=True)

    def add(name, fn, *args):
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(*a[0], **a[1])
        s.set_defaults(fn=fn)
        return s

    inp = (["--input"], {"required": True})
    out = (["--output"], {"required": True})
    ml = (["--multiline"], {"action": "store_true", "help": "input files are JSON arrays"})
    rej = (["--rejects"], {"required": True, "help": "reject output"})
    folder = [([f"--{x}"], {"default": None}) for x in ("play", "feed", "review-pages", "listing", "product-pages")]
    add("collect", cmd_collect, out, rej, *folder)
    add("analyze", cmd_analyze, inp, out, ml)
    add("score", cmd_score, inp, out, ml, (["--model"], {"required": True, "help": "scorer factory as package.module:function"}),
        (["--metrics"], {"required": True}), (["--run-id"], {"required": True}), (["--max-chars"], {"type": int, "default": None}))
    add("export-csv", cmd_export_csv, inp, out, ml)
    add("classify", cmd_classify, inp, out, ml,
        (["--model"], {"default": None, "help": "topic scorer factory as package.module:function"}))
    add("load", cmd_load, inp, ml, (["--table"], {"required": True}), (["--touch-only"], {"action": "store_true"}),
        (["--rejects"], {"default": None, "help": "reject output"}))
    add("process", cmd_process, inp, out)
    add("publish", cmd_publish, inp, ml, (["--topic"], {"default": "reviews.raw"}),
        (["--format"], {"default": "kafka"}), (["--servers"], {"default": ""}), (["--path"], {"default": None}))
    add("consume", cmd_consume, out, rej, (["--topic"], {"default": "reviews.raw"}), (["--format"], {"default": "kafka"}),
        (["--servers"], {"default": ""}), (["--path"], {"default": None}), (["--checkpoint"], {"required": True}),
        (["--max-per-trigger"], {"type": int, "default": None}))
    add("report", cmd_report, inp, ml, (["--scored"], {"action": "store_true", "help": "input is the output of score"}))
    a = p.parse_args(argv)
    from reviewlake.session import get_spark
    a.fn(get_spark(), a)


if __name__ == "__main__":
    main(sys.argv[1:])
