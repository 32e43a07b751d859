"""Shards against the same tree built by sorting whole lists."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from reviewlake.llm import kd_shards as kd


def number(x):
    if isinstance(x, str):
        return float(int.from_bytes(x.encode()[:6].ljust(6, b"\0"), "big"))
    return None if x is None or x != x or abs(x) == float("inf") else float(x)


def by_sorting(rows, shards, n_dims):
    """id -> (shard, slot) for rows (id, text, dims...), ids all different."""
    pts = []
    for i, text, *dims in rows:
        raw = (text or "").encode()
        tie = int(hashlib.md5(f"{'' if i is None else i}:{zlib.crc32(raw)}".encode()).hexdigest()[:8], 16)
        pts.append({"id": i, "size": len(raw) + 1, "tie": tie, "at": [number(d) for d in dims]})
    for k in range(n_dims):
        known = [p["at"][k] for p in pts if p["at"][k] is not None]
        low, high = (min(known), max(known)) if known else (0, 0)
        for p in pts:
            p["at"][k] = (p["at"][k] - low) / (high - low) if p["at"][k] is not None and high > low else 0.0
    out = {}

    def grow(ps, first, parts):
        if parts == 1:
            out.update({p["id"]: (first, s) for s, p in enumerate(sorted(ps, key=lambda p: p["tie"]))})
            return
        if not ps:
            return
        spans = [max(p["at"][k] for p in ps) - min(p["at"][k] for p in ps) for k in range(n_dims)]
        dim = spans.index(max(spans))
        low = min(p["at"][dim] for p in ps)

        def key(p):
            return int((p["at"][dim] - low) / spans[dim] * ((1 << 28) - 1)) if spans[dim] > 0 else 0, p["tie"]
        ps = sorted(ps, key=key)
        total, left = sum(p["size"] for p in ps), parts // 2
        goal, run, cut = total // parts * left + total % parts * left // parts, 0, 0
        while run + ps[cut]["size"] < goal:
            run, cut = run + ps[cut]["size"], cut + 1
        cut += 2 * run + ps[cut]["size"] <= 2 * goal
        grow(ps[:cut], first, left)
        grow(ps[cut:], first + left, parts - left)
    grow(pts, 0, shards)
    return out


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(i, rng.choice(["x" * 500, None, "", "é" * rng.randrange(900), f"text {i}"]), rng.choice(["en", "en", "en", "de", None, ""]),
             rng.choice([f"src{rng.randrange(20)}", "hot"]), rng.choice([None, rng.randrange(1000)])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_equals_sorting(spark, shards):
    rows = corpus(600)
    got = {r["id"]: (r["shard"], r["slot"]) for r in kd.place(frame(spark, rows), shards).collect()}
    assert got == by_sorting(rows, shards, 3)


def test_near_equal_bytes_and_target(spark):
    rows = [(i, "x" * (i % 97), "en", "one", 5) for i in range(3000)]           # every dimension is one value
    placed = kd.place(frame(spark, rows), target_bytes=20_000).groupBy("shard").agg({"size": "sum", "slot": "max", "*": "count"}).collect()
    total = sum(r["sum(size)"] for r in placed)
    assert len(placed) == -(-total // 20_000) and max(r["sum(size)"] for r in placed) < 20_000 + 97
    assert all(r["max(slot)"] == r["count(1)"] - 1 for r in placed)
    assert max(r["sum(size)"] for r in placed) - min(r["sum(size)"] for r in placed) < 200


def test_one_row_in_a_third_of_the_table(spark):
    """Rows that nothing but their number tells apart are split all the same."""
    rows = [(0, "same text", "en", "hot", 9)] * 400 + corpus(800)[1:]
    placed = kd.place(frame(spark, rows), 8).collect()
    assert len(placed) == len(rows)
    by = {}
    for r in placed:
        by.setdefault(r["shard"], []).append(r)
    assert set(by) == set(range(8)) and all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by.values())
    size = [sum(r["size"] for r in rs) for rs in by.values()]
    assert max(size) - min(size) < 4000


def test_odd_tables(spark, odd_docs, no_docs):
    placed = kd.place(odd_docs, 4, dims=("lang", "source", "n_chars", "score")).collect()
    want = sorted((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in odd_docs.where("doc_id is not null").collect())
    assert sorted((r["id"], r["size"], r["crc"]) for r in placed if r["id"] is not None) == want and len(placed) == odd_docs.count()
    assert kd.place(no_docs, target_bytes=10).count() == 0
    few = kd.place(odd_docs.where("doc_id in (1, 2)"), 8).collect()
    assert len(few) == 2 and all(r["slot"] == 0 for r in few)
    with pytest.raises(ValueError):
        kd.place(odd_docs)


def test_written_shards(spark, odd_docs, tmp_path):
    docs = odd_docs.withColumnRenamed("h", "shard")
    back = kd.write_shards(docs, str(tmp_path / "out"), shards=3, files=2)
    assert back.columns == [*docs.columns, "shard_", "slot"]
    assert sorted(map(repr, back.drop("shard_", "slot").collect())) == sorted(map(repr, docs.collect()))
    for k in range(3):
        own = [r["slot"] for r in back.where(f"shard_ = {k}").collect()]
        assert sorted(own) == list(range(len(own)))


def test_main_path_is_native(spark, sf):
    from reviewlake.llm.queries import op12_kd_shards
    plan = op12_kd_shards(spark, sf)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))
