"""Sentence spans and sparse suffixes against brute force."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.llm import sentence_spans as spans
from reviewlake.llm import sparse_suffix as suffix



def planted(seed=1, n=60):
    """Documents of own prose; some share passages, some are copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 5)))

    def text(k):
        out = []
        for i in range(k):
            out.append(word() + ("." if i % 9 == 8 else ""))
        return " ".join(out) + "."
    shared = [text(70), text(120)]
    docs = []
    for i in range(n):
        body = [text(rng.randrange(20, 90)) for _ in range(3)]
        if i % 3 == 0:
            body.insert(1, shared[i % 2])
        docs.append((i, "\n".join(body)))
    docs += [(100 + i, docs[i][1]) for i in range(4)] + [(200, docs[5][1] + " " + text(30)), (201, text(60)), (201, text(61))]
    return docs


def brute_spans(rows):
    """What stays of each document, by comparing all runs of sentences."""
    first, cut = {}, {}
    for i, t in sorted(set(rows), key=lambda d: (d[0], zlib.crc32(d[1].encode()))):
        s = spans.sentences(t)
        norm = [" ".join(t[a:b].lower().split()) for a, b in s]
        n = [spans.word_count(x.split()) for x in norm]
        gone = set()
        for k in range(len(s)):
            e = k + 3
            while e <= len(s) and sum(n[k:e]) < spans.LEAST:
                e += 1
            if e > len(s):
                break
            key = tuple(norm[k:e])
            if key in first:
                gone |= set(range(k, e))
            else:
                first[key] = i
        cut[i, t] = gone
    return cut


def test_sentences_cover_all_words():
    for t in ("One. Two! Three?\nFour", "a " * 40, "", " \n ", "x.y z. ", "A. B.\n\nC", "long " * 16 + "end. next", "tab\t" * 40, " ".join(map(str, range(99)))):
        got = [w for a, b in spans.sentences(t) for w in t[a:b].split()]
        assert got == t.split()
        assert all(len(t[a:b].split()) <= spans.LONGEST for a, b in spans.sentences(t))


def shared_keys(a, b):
    """Runs that two texts share; the hashes of a text do not depend on its batch."""
    text, place, key = spans.run_keys([a, "", b])
    alone = spans.run_keys([b])
    assert (alone[2] == key[text == 2]).all() and (alone[1] == place[text == 2]).all()
    assert place[text == 0].tolist() == list(range((text == 0).sum())) and (text != 1).all()
    return len({tuple(k) for k in key[text == 0].tolist()} & {tuple(k) for k in key[text == 2].tolist()})


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 40), st.integers(0, 40), st.sampled_from([" ", "\t", " \u3000"]))
def test_a_passage_without_stops_has_common_runs_behind_any_lead(seed, before, after, space):
    rng = random.Random(seed)
    w = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    passage = w(120)
    assert shared_keys(space.join(w(before) + passage + w(after)), space.join(w(after) + passage + w(before)))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 40), st.integers(0, 40), st.sampled_from([0, 12]))
def test_text_without_spaces_has_common_runs(seed, before, after, stop):
    """Chinese with full-width stops and without any; a long unspaced run."""
    rng = random.Random(seed)

    def han(n, first=0x4E00, last=0x9FA5):
        signs = [chr(rng.randrange(first, last)) for _ in range(n)]
        return "".join(c + ("\u3002" if stop and k % stop == stop - 1 else "") for k, c in enumerate(signs))
    passage = han(240)
    assert shared_keys(han(before) + passage + han(after), han(after) + passage + han(before))
    code = "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(400))
    assert shared_keys("x" * before + code + "yz" * after, "q" * after + code + "y" * before)
    assert spans.word_count(spans.words_in(passage.replace("\u3002", ""), True)) == 120
    assert spans.word_count(spans.words_in("a bc " + "d" * 33, False)) == 18


def kept_text(t, gone):
    s = spans.sentences(t)
    out, last = [], 0
    for k in sorted(gone):
        hi = s[k + 1][0] if k + 1 < len(s) else len(t)
        out.append(t[last:max(last, s[k][0])])
        last = hi
    return "".join(out) + t[last:]


def test_repeated_spans_are_removed(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = spans.remove_repeats(df).collect()
    cut = brute_spans(rows)
    want = sorted((i, kept_text(t, cut[i, t])) for i, t in rows)
    assert sorted((r["doc_id"], r["text"]) for r in out) == want
    changed = {r["doc_id"] for r in spans.remove_repeats(df, changed_only=True).collect()}
    assert changed == {i for (i, t), g in cut.items() if g}
    assert all(r["removed"] == [] and not r["first_ids"] for r in out if r["doc_id"] not in changed)


def test_spans_of_odd_documents(odd_docs, no_docs):
    out = spans.remove_repeats(odd_docs)
    assert out.columns == [*odd_docs.columns, "removed_", "first_ids"] and out.dtypes[:-2] == odd_docs.dtypes
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    assert sum(r["text"] is None for r in rows) == 2
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 21, 22)}
    assert not by[20]["first_ids"] == [] and by[5]["first_ids"] in (None, [])
    assert spans.remove_repeats(no_docs).count() == 0


# --- suffixes ---------------------------------------------------------------

def brute_windows(rows):
    """For each document the words of 50-word windows that stand earlier."""
    first, out = set(), {}
    for i, t in sorted(set(rows), key=lambda d: (d[0], zlib.crc32(d[1].encode()))):
        w = suffix._TOKEN.findall(t)
        hit = np.zeros(len(w), bool)
        for k in range(len(w) - suffix.LEAST + 1):
            key = tuple(w[k:k + suffix.LEAST])
            if key in first:
                hit[k:k + suffix.LEAST] = True
            first.add(key)
        out[i, t] = hit
    return out


def removed_words(text, removed):
    at = [m.span() for m in suffix._TOKEN.finditer(text)]
    return np.array([any(r["start"] <= a and b <= r["end"] for r in removed) for a, b in at], bool)


def test_passages_are_removed(spark):
    rows = planted(seed=8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in suffix.remove_repeats(df).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for (i, t), want in brute_windows(rows).items():
        mine = [removed_words(t, r["removed"]) for r in got[i] if len(removed_words(t, r["removed"])) == len(want)]
        assert any((m == want).all() for m in mine), i
    changed = suffix.changed_texts(df).collect()
    assert {r["id"] for r in changed} == {i for (i, t), w in brute_windows(rows).items() if w.any()}
    for r in changed:
        old = dict(rows)[r["id"]]
        out, last = [], 0
        for x in r["removed"]:
            out.append(old[last:x["start"]])
            last = x["end"]
        assert "".join(out) + old[last:] == r["text"] and r["first_ids"]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(suffix.LEAST, 90), st.integers(0, 60), st.integers(0, 60))
def test_equal_passages_select_a_common_suffix(seed, size, before, after):
    rng = random.Random(seed)
    w = lambda n: [str(rng.randrange(1000)) for _ in range(n)]
    passage = w(size)
    a, b = w(before) + passage + w(after), w(after) + passage + w(before)
    text, place, key = suffix.suffixes(*suffix.exact_words(pa.array([" ".join(a), " ".join(b)])))
    own = {(int(p) - before, int(k)) for t, p, k in zip(text, place, key) if t == 0 and p >= before}
    other = {(int(p) - after, int(k)) for t, p, k in zip(text, place, key) if t == 1 and p >= after}
    assert own & other


def test_runs_that_cross_partitions_have_one_head(spark):
    """A passage in every document: one keeps it, however the sort is cut."""
    rng = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(80))
    rows = [(i, " ".join(f"{rng.random()}" for _ in range(40)) + "\n" + passage) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["id"]: r for r in suffix.changed_texts(df).collect()}
    assert set(got) == set(range(1, 300))
    assert all(r["text"].split() == rows[i][1].split()[:40] and r["first_ids"][0] == 0 for i, r in got.items())


def test_phrases_that_stand_earlier_do_not_hide_a_passage(spark):
    """Passages around a phrase of 32 to 49 words that an earlier document holds."""
    rng, rows, keeper = random.Random(12), [], {}
    words = lambda n: [f"{rng.random():.9f}" for _ in range(n)]
    for k in range(120):
        size, inner = rng.choice([(50, 40), (60, 49), (60, 40), (100, 90)])
        passage, at = words(size), rng.choice([0, (size - inner) // 2, size - inner])
        keeper[k] = {1000 + k, k} if inner >= suffix.LEAST else {1000 + k}
        rows.append((k, " ".join(words(20) + passage[at:at + inner] + words(20))))
        rows += [(1000 * c + k, " ".join(words(15) + passage + words(15))) for c in (1, 2, 3)]
    rows.append((9000, "again " * 200))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["id"]: r for r in suffix.changed_texts(df).collect()}
    for (i, t), want in brute_windows(rows).items():
        assert (removed_words(t, out[i]["removed"] if i in out else []) == want).all(), i
    assert all(r["first_ids"] and set(r["first_ids"]) <= keeper[i % 1000] for i, r in out.items() if i != 9000)
    spread = {r["id"]: r for r in suffix.changed_texts(df, run_rows=2).collect()}                 # every run of three by aggregates
    assert spread == out


def test_extension_finds_the_earliest_equal_passage():
    """All runs of one batch against comparing words row by row."""
    rng = np.random.default_rng(2)
    n, a = 400, suffix.AROUND
    run = np.sort(rng.integers(0, 40, n))
    left, right = (rng.integers(0, 9, (n, a)).astype(np.uint32) // 8 for _ in range(2))
    before, behind = rng.integers(0, 40, n), rng.integers(0, a + 1, n)
    head = suffix.earliest(run, left, right, before, behind)
    for r in range(n):
        for j in range(a + 1):
            same = [q for q in np.flatnonzero(run == run[r]) if q <= r and before[q] >= j and behind[q] >= a - j
                    and (left[q, :j] == left[r, :j]).all() and (right[q, :a - j] == right[r, :a - j]).all()]
            assert head[r, j] == (same[0] if same and same[0] != r and same[-1] == r else -1)


def test_spans_of_a_document_move_together(spark):
    """A row for each document that a task has, its spans as bytes: no object for each span in the aggregate behind."""
    rng = random.Random(3)
    text = " ".join(f"{rng.random():.6f}" for _ in range(600))
    place = suffix.suffixes(*suffix.exact_words(pa.array([text])))[1].tolist()
    places = spark.createDataFrame([(i, 7, text, place) for i in range(30)], "id long, crc long, text string, at array<int>")
    rows = suffix.stage(suffix.surroundings(places), "test-surroundings")
    out = suffix.extensions(rows)
    assert out.dtypes == [("id", "bigint"), ("crc", "bigint"), ("spans", "binary")]
    got = out.collect()
    tasks = suffix.shuffle_partitions(spark)
    assert {r["id"] for r in got} == set(range(1, 30)) and len(got) <= 29 * tasks < 29 * len(place)
    want = {p - j for p in place for j in range(suffix.AROUND + 1) if j <= p <= 600 - suffix.LEAST + j}
    for some in (got, suffix.extensions(rows, run_rows=2).collect()):
        for i in (1, 29):
            spans = np.frombuffer(b"".join(r["spans"] for r in some if r["id"] == i), suffix.SPAN)
            assert {x for lo, hi, f in spans.tolist() for x in range(lo, hi + 1)} == want and set(spans["f_id"].tolist()) == {0}
        ranges, firsts = suffix.united(pa.array([[r["spans"] for r in some if r["id"] == i] for i in range(30)], pa.list_(pa.binary())))
        assert ranges[0] == firsts[0] == [] and all(x == ranges[1] for x in ranges[1:]) and firsts[1:] == [[0]] * 29
        assert sum(hi - lo for lo, hi in ranges[1]) == len({w for x in want for w in range(x, x + suffix.LEAST)})


def test_uniting_takes_no_memory_for_each_start():
    """Spans of 19 starts each: the peak stays below eight bytes a start."""
    import tracemalloc
    n = 100_000
    lo = np.arange(n) // 10
    spans = suffix.packed(np.zeros(n, np.int64), np.zeros(n, np.int64), lo, lo + suffix.AROUND, np.full(n, 5)).column("spans")
    rows = pa.array([spans.to_pylist()], pa.list_(pa.binary()))
    tracemalloc.start()
    ranges, firsts = suffix.united(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ranges == [[(0, int(lo[-1]) + suffix.AROUND + suffix.LEAST)]] and firsts == [[5]]
    assert peak < 8 * n * (suffix.AROUND + 1)


def test_carried_heads_need_no_python_workers(spark):
    for rows in ([], [(3, -5, 1, 2, 9)]):
        df = suffix._carried(spark, rows)
        assert [tuple(r) for r in df.collect()] == rows
        assert df.dtypes == [("part", "int"), ("h", "bigint"), ("g_id", "bigint"), ("g_crc", "bigint"), ("g_place", "int")]
        assert "ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()


def test_suffixes_of_odd_documents(odd_docs, no_docs):
    out = suffix.remove_repeats(odd_docs)
    assert out.columns == [*odd_docs.columns, "removed_", "first_ids"] and out.dtypes[:-2] == odd_docs.dtypes
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 21, 22)}
    assert by[20]["text"] == "" and by[20]["first_ids"] == [5] or by[20]["first_ids"] == []
    assert by[41]["text"] == "" or re.fullmatch(r"\s*(end)?", by[41]["text"])
    assert by[40]["removed_"] == [] or len(by[40]["text"]) > 0
    assert suffix.remove_repeats(no_docs).count() == 0 and suffix.changed_texts(no_docs).count() == 0
