"""Filter audit against a simulation of every order, document by document."""

from __future__ import annotations

import random
import re
from itertools import permutations
from math import factorial

from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failing(rows):
    """(part, letters failed, id) per row: the conditions word by word."""
    out = []
    for i, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = ["A" * (len(w) < 200), "B" * (100 * len(set(w)) < 50 * len(w)), "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)),
             "D" * bool(re.search(r"[#$%&*|]", t)),
             "E" * any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in rows)]
        out.append((part or "", "".join(f), i))
    return out


def simulate(rows, good, toxic):
    told, out = failing(rows), []
    for part in {p for p, _, _ in told}:
        own = [(f, i) for p, f, i in told if p == part]
        total = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = list(own)
            for step, c in enumerate(order, 1):
                gone = [x for x in left if c in x[0]]
                left = [x for x in left if c not in x[0]]
                total[c] += len(gone)
                lines.append([part, "".join(order), step, len(left), len(gone), sum(c in f for f, _ in own) - len(gone),
                              sum(f == c for f, _ in own), sum(i in good for _, i in gone), sum(i in toxic for _, i in gone), c])
        out += [(*x[:-1], total[x[-1]]) for x in lines]
    return sorted(out)


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 1, "n", 2) for i, t, p in rows], "doc_id long, text string, lang string, mask int, part string, n int")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = fa.audit_filters(docs, known)
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_every_order(spark):
    rng = random.Random(3)
    word = ["alpha", "Beta", "GAMMA", "100%", "a|b", "delta", "x", "über", "\x1c"]
    rows = []
    for i in range(120):
        n = rng.choice([0, 1, 5, 150, 199, 200, 201, 400])
        kinds = word[:rng.choice([1, 3, 5])] if rng.random() < 0.5 else [f"w{k}" for k in range(500)] + word[: rng.choice([1, 9])]
        rows.append((i, rng.choice([" ", "\t\n", "\x0b"]).join(rng.choice(kinds) for _ in range(n)), rng.choice(["en", "de", None, ""])))
    rows += [(200 + k, rows[3][1], "en") for k in range(40)]          # one text in a quarter of the rows
    rows += [(7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (8, rows[9][1], "fr"), (None, rows[3][1], "en"), (None, None, "en"),
             (None, "", None), (300, None, "fr"), (301, "", "fr"), (302, " \t ", "fr")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 240, 3)] + [(3, 0, 1), (6, None, None), (None, 1, 1), (999, 1, 1)]
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    assert audited(spark, rows, labels) == simulate(rows, good, toxic)


def test_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, fa.audit_filters(odd_docs, labels).collect())) == simulate(rows, set(), set())
    assert fa.audit_filters(no_docs, labels).count() == 0


def test_weights_are_the_marginal_ones():
    """The least squares solution equals n! times the mean marginal gain."""
    for n in range(1, 7):
        for f, row in enumerate(fa.shapley_weights(n)):
            for s, c in enumerate(row):
                k = s.bit_count()
                assert c == (factorial(k - 1) * factorial(n - k) if s >> f & 1 else -factorial(k) * factorial(n - k - 1) if k < n else 0) or (s == 0)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 31), st.integers(1, 9)), max_size=12))
def test_shapley_adds_up(counts):
    weights = fa.shapley_weights(5)
    v = [sum(n for m, n in counts if m & s) for s in range(32)]
    assert sum(c * x for row in weights for c, x in zip(row, v)) == 120 * v[31]
