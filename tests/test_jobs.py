"""Gates, processing job, stream restart."""

import pytest

from reviewlake.plans import jobs
from reviewlake.streaming import ingest as ST
from reviewlake.sources import topic as TP


def test_gate_fails_on_empty_and_counts_otherwise(spark):
    empty = spark.createDataFrame([], "review_id string")
    with pytest.raises(Exception, match="no rows in reviews"):
        jobs.require_nonempty(empty, "reviews").collect()
    assert jobs.require_nonempty(spark.range(7), "x").first().n == 7


def test_processing_job_counts(spark, tmp_path):
    df = spark.createDataFrame([("a", "x" * 10), ("b", "y" * 60), ("c", None)], "review_id string, review_text string")
    out = jobs.processing_job(spark, df, str(tmp_path / "out"))
    assert out == {"input_rows": 3, "written_rows": 3, "verified_rows": 3}
    got = {r.review_id: r.length_category for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": "short", "b": "medium", "c": "long"}
    with pytest.raises(Exception):
        jobs.output_check(spark, table="no_such_table_here")


def test_stream_restart_does_not_duplicate(spark, tmp_path):
    base = str(tmp_path)
    schema = "n int, t string"
    def land(rows, mode):
        enc = TP.encode_records(spark.createDataFrame(rows, schema), None)
        enc.write.mode(mode).parquet(f"{base}/topic")
    land([(1, "a"), (2, "b")], "overwrite")
    topic_schema = spark.read.parquet(f"{base}/topic").schema

    received = []

    def run():
        s = ST.read_topic_stream(spark, "parquet", topic_schema, path=f"{base}/topic")
        q, got = ST.ingest(s, schema, f"{base}/sink", f"{base}/ckpt", f"{base}/rejects")
        q.awaitTermination()
        received.append(got.records)
        return sorted(r.n for r in spark.read.parquet(f"{base}/sink").collect())

    assert run() == [1, 2]
    assert run() == [1, 2]            # restart from the checkpoint: nothing replayed
    land([(3, "c")], "append")
    assert run() == [1, 2, 3]         # only the new data is read
    assert received == [2, 0, 1]


def test_split_rejects_routes_overflow(spark):
    from reviewlake.operators.projections import split_rejects
    df = spark.createDataFrame([("a", 4.5, 0.25), ("b", 99.95, 0.1), ("c", 3.0, 123.4), ("d", None, None)],
                               "review_id string, rating double, sentiment_score double")
    good, rejects = split_rejects(df)
    assert sorted(r.review_id for r in rejects.collect()) == ["b", "c"]
    rows = {r.review_id: r for r in good.collect()}
    assert set(rows) == {"a", "d"} and str(rows["a"].rating) == "4.5" and rows["d"].rating is None


def test_first_available_and_typed_table(spark, tmp_path):
    from reviewlake.schema import STORED_REVIEW
    from reviewlake.sinks import files as S
    p, df = S.first_available(spark, [str(tmp_path / "nope")], lambda s, x: s.read.parquet(x))
    assert p is None and df is None
    S.create_table_if_absent(spark, "typed_reviews_t", STORED_REVIEW, location=str(tmp_path / "typed"))
    S.create_table_if_absent(spark, "typed_reviews_t", STORED_REVIEW, location=str(tmp_path / "typed"))
    assert spark.table("typed_reviews_t").schema.simpleString() == STORED_REVIEW.simpleString()


def test_synthetic_reviews_do_not_depend_on_partitioning(spark):
    from reviewlake.sources.synth import synthetic_reviews
    a = synthetic_reviews(spark.range(500).withColumnRenamed("id", "k"), "k").collect()
    b = synthetic_reviews(spark.range(500).repartition(7).withColumnRenamed("id", "k"), "k").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    r = {x.review_id: x for x in a}
    assert r["syn_00042"].source == "synthetic" and 1.0 <= r["syn_00042"].rating <= 5.0
    langs = [x.language for x in a]
    assert 0.3 < langs.count("pt") / 500 < 0.5 and 0.1 < langs.count("en") / 500 < 0.3


def test_reads_a_json_array_review_file(spark, tmp_path):
    """A review file as the collectors wrote it: one indented JSON array,
    non-ASCII characters unescaped."""
    import json
    from reviewlake.schema import REVIEW
    from reviewlake.sinks.files import read_json
    rows = [{"review_id": "as_1", "source": "app_store", "store_id": "appstore_br", "store_name": "App (São Paulo)",
             "store_city": "São Paulo", "rating": 4.0, "text": "Ótimo app, entrega rápida", "language": "pt",
             "date": "2026-01-02T10:00:00-07:00", "sport_category": "other", "collected_at": "2026-01-03T00:00:00"},
            {"review_id": "rd_x", "source": "reddit", "rating": 2.0, "text": "meh", "extra_field": 1}]
    path = tmp_path / "reviews.json"
    path.write_text(json.dumps(rows, ensure_ascii=False, indent=2), encoding="utf-8")
    got = {r.review_id: r for r in read_json(spark, str(path), REVIEW, multiline=True).collect()}
    assert got["as_1"].store_city == "São Paulo" and got["as_1"].rating == 4.0
    assert got["rd_x"].store_id is None and got["rd_x"].text == "meh"


def test_partitioned_table_prunes_folders(spark, tmp_path):
    from reviewlake.operators.filters import dashboard_filter
    from reviewlake.sinks.files import write_parquet
    df = spark.createDataFrame([(f"r{i}", f"s{i % 4}", float(i % 5 + 1)) for i in range(40)],
                               "review_id string, source string, rating double")
    write_parquet(df, str(tmp_path / "t"), partition_by=["source"])
    q = dashboard_filter(spark.read.parquet(str(tmp_path / "t")), sources=["s1", "s2"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [source#" in plan and "IN (s1,s2)" in plan
    assert q.count() == 20


def test_first_available_empty_fallback(spark, tmp_path):
    from reviewlake.schema import REVIEW
    from reviewlake.sinks import files as S
    p, df = S.first_available(spark, [str(tmp_path / "none")], lambda s, x: s.read.parquet(x), REVIEW)
    assert p is None and df.count() == 0 and df.schema == REVIEW


def test_an_unreadable_dataset_is_not_a_missing_one(spark, tmp_path):
    from reviewlake.sinks import files as S
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception, match="INFER_SCHEMA|infer"):
        S.first_available(spark, [str(tmp_path / "none"), str(tmp_path / "broken")], lambda s, p: s.read.parquet(p))


def test_csv_keeps_any_text(spark, tmp_path):
    from reviewlake.sinks import files as S
    rows = [("a", 'line one\nline "two", and\r\nthree'), ("b", "  leading and trailing  "), ("c", ""), ("d", None), ("e", "back\\slash, \\N"), ("f", '"')]
    df = spark.createDataFrame(rows, "id string, text string")
    S.write_csv(df, str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in S.read_csv(spark, str(tmp_path / "csv"), df.schema).collect()) == sorted(rows)


def test_checkpoint_dir_is_required_off_local(spark, monkeypatch):
    from reviewlake import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("none")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_submitted_settings_survive(tmp_path):
    """A submitted master and shuffle count reach the job of ``cli.main``."""
    import os
    import subprocess
    import sys

    import pyspark
    job = tmp_path / "job.py"
    job.write_text("import sys\nfrom reviewlake import cli\n"
                   "cli.cmd_process = lambda spark, a: print('GOT', spark.sparkContext.master, spark.conf.get('spark.sql.shuffle.partitions'))\n"
                   "cli.main(['process', '--input', 'x', '--output', 'y'])\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    submit = os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit")
    out = subprocess.run([submit, "--master", "local[2]", "--conf", "spark.sql.shuffle.partitions=4000", "--conf", "spark.ui.enabled=false", str(job)],
                         env=os.environ | {"PYTHONPATH": root, "PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 4000" in out.stdout, out.stderr[-2000:]


def test_a_load_writes_its_texts_once(spark, tmp_path, monkeypatch):
    """Besides what is published: neither the union nor the batch is stored again."""
    from reviewlake.sources import tables
    staged = []
    monkeypatch.setattr(jobs, "stage", lambda df, name: staged.append(name) or tables.stage(df, name))
    cols = "review_id string, source string, store_id string, store_name string, store_city string, rating double, text string, language string, date string, sport_category string, collected_at string"
    def src(ids, text):
        return spark.createDataFrame([(i, "s", "st", "n", "c", 4.0 if i != "big" else 999.0, f"{text} {i}", "en", "2026-01-01T00:00:00", "other", None) for i in ids], cols)
    out = jobs.batch_load(spark, [src(["a", "b", "big", None], "first"), src(["b", "c", "c", None], "second")],
                          topic_path=str(tmp_path / "topic"), reject_path=str(tmp_path / "rejects"))
    assert sorted((r.review_id, r.review_text) for r in out.collect()) == [("a", "first a"), ("b", "first b"), ("c", "second c")]
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 4
    assert sorted(str(r.review_id) for r in spark.read.parquet(str(tmp_path / "rejects")).collect()) == ["None", "None", "big"]
    jobs.batch_load(spark, [src(["b", "d"], "third")], table=out, reject_path=str(tmp_path / "rejects"))
    assert staged == ["enriched", "enriched"]


def test_passing_tables_go(spark):
    import os

    from reviewlake.session import shuffles_dropped
    from reviewlake.sources.tables import passing_tables, stage

    def folder(df):
        return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    before = folder(stage(spark.range(3), "before"))
    with passing_tables(spark):
        inside, kept = stage(spark.range(3), "inside"), stage(spark.range(3), "kept", keep=True)
        inside, kept_at = folder(inside), folder(kept)
        assert os.path.exists(inside)
    assert not os.path.exists(inside) and os.path.exists(kept_at) and os.path.exists(before) and kept.count() == 3
    with pytest.raises(ValueError), passing_tables(spark), shuffles_dropped(spark):
        inside = folder(stage(spark.range(3), "inside"))
        raise ValueError
    assert not os.path.exists(inside) and os.path.exists(folder(stage(spark.range(3), "after"))) and spark.conf.get(key, None) == was


def test_duplicates_are_told_apart_by_the_columns_as_they_came(spark):
    """Also by a category that the load replaces, as if the rows were classified after the choice."""
    cols = "review_id string, source string, rating double, text string, date string, sport_category string, collected_at string"
    a = spark.createDataFrame([("x", "s", 4.0, "great bike", "2026-01-01T00:00:00", "y", "2026-01-01T00:00:00"),
                               ("x", "s", 4.0, "great bike", "2026-01-01T00:00:00", "b", "2026-01-02T00:00:00")], cols)
    got = jobs.batch_load(spark, [a]).collect()
    assert [(r.sport_category, r.collected_at.day) for r in got] == [("cycling", 2)]


def test_two_loads_leave_only_the_tables_they_need(spark, tmp_path):
    """No stored copy of a source, no landed table and one working table are left of two loads."""
    import os
    import re

    from reviewlake.registry import all_queries
    from reviewlake.session import checkpoint_dir
    sf = str(tmp_path / "in")
    docs = [(i, f"a great bike, document {i}" if i % 5 else None, "en", f"src{i % 3}", 20 + i) for i in range(1, 31)]
    for name, rows, schema in [
            ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", [(i, i % 2, 0) for i in range(1, 20)], "doc_id long, quality int, toxic int"),
            ("orders", [(i, "2026-01-02") for i in range(1, 25)], "o_orderkey long, o_orderdate string"),
            ("nation", [(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string"),
            ("conversations", [(1, i, "user", f"a long enough post, number {i}") for i in range(3)], "conv_id long, turn int, role string, text string")]:
        df = spark.createDataFrame(rows, schema)
        (df.selectExpr("o_orderkey", "cast(o_orderdate as timestamp_ntz) o_orderdate") if name == "orders" else df).write.parquet(f"{sf}/{name}.parquet")
    scratch = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    got = {r.review_id: r for r in all_queries()["batch_load_incremental"](spark, sf).collect()}
    play = [k for k in got if k.startswith("gp_")]
    assert len(play) == len([k for k in got if k.startswith("new_")]) > 20
    assert all(got[k].ingested_at.month == 3 and not got[k].review_text.startswith("Worst, useless.") for k in play)
    assert all(got["new_" + k].review_text.startswith("Worst, useless. ") and got["new_" + k].sentiment_score == got[k].sentiment_score for k in play)
    left = sorted(re.sub(r"-[0-9a-f]{12}$", "", x) for x in set(os.listdir(scratch)) - before if re.search(r"-[0-9a-f]{12}$", x))
    assert left == ["changes", "enriched", "item-rejects", "loaded", "published", "rejects", "rejects"]


REVIEW_COLS = ("review_id string, source string, store_id string, store_name string, store_city string, rating double, text string, "
               "language string, date string, sport_category string, collected_at string")


def _source(spark, rows):
    """Source rows of (id, text) or (id, text, rating)."""
    return spark.createDataFrame([(r[0], "s", "st", "n", "c", r[2] if len(r) > 2 else 4.0, r[1], "en", "2026-01-01T00:00:00", "other", None) for r in rows], REVIEW_COLS)


def _slices_at(path):
    import os
    return sorted(x for x in os.listdir(path) if x.startswith("_slice="))


def test_slices_go_one_by_one(spark):
    from reviewlake.session import checkpoint_dir
    from reviewlake.sources.tables import sliced
    import os
    scratch = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    df = spark.createDataFrame([(f"k{i % 40}" if i % 9 else None, i) for i in range(200)], "k string, n int")
    seen, there = [], []
    for part in sliced(df, "parts", "k", 4):
        (folder,) = [x for x in os.listdir(scratch) if x not in before and x.startswith("parts-")]
        there.append(len(_slices_at(f"{scratch}/{folder}")))
        assert part.columns == ["k", "n"]
        seen.append(part.collect())
    assert there == [4, 3, 2, 1] and not [x for x in os.listdir(scratch) if x not in before and x.startswith("parts-")]
    assert sorted(r.n for rows in seen for r in rows) == list(range(200))
    assert all(sum(any(r.k == k for r in rows) for rows in seen) == 1 for k in {r.k for rows in seen for r in rows})
    empty = [part.collect() for part in sliced(df.where("n < 0"), "parts", "k", 3)]
    assert empty == [[], [], []]


def test_a_load_in_slices_is_the_same_load(spark, tmp_path):
    """Also with duplicates across sources, rows without an id, numbers that do
    not fit and rejected items; the working rows of a slice are gone before the last is stored."""
    from pyspark.sql import functions as F

    first = _source(spark, [(f"i{k}", f"first {k}", 999.0 if k == 3 else 4.0) for k in range(30)] + [(None, "none")])
    second = _source(spark, [(f"i{k}", f"second {k}") for k in range(20, 50)] + [("i49", "again"), (None, "none")])
    bad = F.when(F.col("review_id").isin("i7", "i45"), F.lit("bad"))
    sources = [s.withColumn("reject_reason", bad).withColumn("reject_source", F.lit("src")) for s in (first, second)]

    def run(name, **kw):
        at, read = tmp_path / name, []
        out = jobs.batch_load(spark, sources, ingested_at=F.to_timestamp(F.lit("2026-01-01")), topic_path=str(at / "topic"), reject_path=str(at / "rejects"),
                              item_reject_path=str(at / "items"), sources_read=lambda: read.append(len(list((at / "topic").glob("*")) if (at / "topic").exists() else [])), **kw)
        assert read == [0]                                  # once, before anything is published
        return [sorted(map(str, df.drop("_slice").collect())) for df in (out, *[spark.read.parquet(str(at / x)) for x in ("topic", "rejects", "items")])]
    plain = run("plain")
    assert [len(x) for x in plain] == [47, 48, 3, 2]
    assert run("one", load_path=str(tmp_path / "t1")) == plain
    assert run("four", load_path=str(tmp_path / "t4"), slices=4) == plain and len(_slices_at(tmp_path / "t4")) == 4
    with pytest.raises(ValueError):
        jobs.batch_load(spark, sources, table=spark.read.parquet(str(tmp_path / "t1")), load_path=str(tmp_path / "t5"))


def test_an_upsert_stores_no_text_that_it_does_not_read(spark, tmp_path, monkeypatch):
    """The text of a known id is not stored again, unless the batch repeats the
    id, the row is a reject or the load publishes it."""
    from reviewlake.sources import tables
    staged = []
    monkeypatch.setattr(jobs, "stage", lambda df, name: staged.append(tables.stage(df, name)) or staged[-1])
    old = _source(spark, [(x, f"old {x}") for x in ("a", "b", "c", "d", "e")])
    batch = _source(spark, [("a", "great a"), ("b", "a great b"), ("b", "useless b"), ("c", "great c", 999.0), ("n", "great n"), (None, "great none")])
    for slices in (1, 3):
        table = jobs.batch_load(spark, [old], load_path=str(tmp_path / f"table{slices}"), slices=slices)
        out = jobs.batch_load(spark, [batch], table=table, reject_path=str(tmp_path / f"rejects{slices}"))
        assert out.columns == [c for c in table.columns if c != "_slice"]
        got = {r.review_id: (r.review_text, r.sentiment_label) for r in out.collect()}
        assert got == {"a": ("old a", "positive"), "b": ("old b", "positive"), "c": ("old c", "neutral"), "d": ("old d", "neutral"),
                       "e": ("old e", "neutral"), "n": ("great n", "positive")}
        assert sorted(r.text for r in spark.read.parquet(str(tmp_path / f"rejects{slices}")).collect()) == ["great c", "great none"]
        rows = [(r.review_id, r.text) for r in staged.pop().collect()]
        assert sorted(rows, key=str) == sorted([("a", None), ("b", "a great b"), ("b", "useless b"), ("c", "great c"), ("n", "great n"), (None, "great none")], key=str)
    out = jobs.batch_load(spark, [batch], table=table, topic_path=str(tmp_path / "topic"))
    assert out.count() == 6 and all(r.text for r in staged.pop().collect()) and spark.read.parquet(str(tmp_path / "topic")).count() == 4


def test_two_loads_in_slices_give_the_same_rows(spark, tmp_path, monkeypatch):
    """The first load's working rows and the landed reviews are gone when the second load's are joined."""
    import os

    from reviewlake.operators import merge
    from reviewlake.registry import all_queries
    from reviewlake.session import checkpoint_dir
    sf = str(tmp_path / "in")
    for name, rows, schema in [
            ("documents", [(i, f"a great bike, document {i}" if i % 5 else None, "en", f"src{i % 3}", 20 + i) for i in range(1, 31)], "doc_id long, text string, lang string, source string, n_chars long"),
            ("labels", [(i, i % 2, 0) for i in range(1, 20)], "doc_id long, quality int, toxic int"),
            ("orders", [(i, "2026-01-02") for i in range(1, 25)], "o_orderkey long, o_orderdate string"),
            ("nation", [(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string"),
            ("conversations", [(1, i, "user", f"a long enough post, number {i}") for i in range(3)], "conv_id long, turn int, role string, text string")]:
        df = spark.createDataFrame(rows, schema)
        (df.selectExpr("o_orderkey", "cast(o_orderdate as timestamp_ntz) o_orderdate") if name == "orders" else df).write.parquet(f"{sf}/{name}.parquet")
    query, scratch, there = all_queries()["batch_load_incremental"], checkpoint_dir(spark).removeprefix("file:"), []
    one = sorted(map(str, query(spark, sf).collect()))
    monkeypatch.setattr(jobs, "SLICE_BYTES", 1)
    before, by_slice = set(os.listdir(scratch)), merge._by_slice
    monkeypatch.setattr(merge, "_by_slice", lambda *a: there.extend(sorted(x[:-13] for x in set(os.listdir(scratch)) - before if x[-13:-12] == "-")) or by_slice(*a))
    assert sorted(map(str, query(spark, sf).collect())) == one
    assert there == ["changes", "enriched", "item-rejects", "loaded", "published", "rejects", "rejects"]
