"""Small tables with every odd case, shared by the operator tests."""

from __future__ import annotations

import random

import pytest

LONG = " ".join(f"w{k % 997}x{k % 31}" for k in range(60_000))


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split())
             + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n)]
    out = []
    for k, w in enumerate(words):
        out.append(w.capitalize() if k % 9 == 0 else w + "." if k % 9 == 8 else w)
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows
    and extra columns whose names the operators use themselves."""
    rng = random.Random(5)
    base = [prose(rng, n) for n in (1, 2, 4, 30, 80, 200, 400)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(20, base[5]), (21, base[5]), (21, base[5]), (22, base[4]), (22, base[3]), (30, ""), (31, None), (None, base[6]), (None, None),
             (40, LONG), (41, LONG + " end"), (50, "  \n\t "), (51, "a@b.co and +1 (555) 123-4567"), (52, "de " * 300),
             (53, "<|endoftext|> İ!\x1c x y z 's  ''t\r\n"), (54, "퟿ \U0001F600 é")]
    data = [(i, t, "en" if i else None, None if i == 3 else "s", len(t or ""), i, f"x{i}", 1.5, [1], -1, 7) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, id long, h string, "
                                       "score double, removed array<int>, component_id int, _row long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
