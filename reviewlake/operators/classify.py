"""Keyword topic classifier (first category with a substring hit wins).

The words of all categories make up one Aho-Corasick automaton, whose words
carry the rank of their category.  A text is read once, in an Arrow batch,
keeping the best rank met, and left early when no better one exists, so the
cost does not grow with the number of words.  It needs no shuffle, and only
the lower-cased text crosses to Python.  (``native=True`` compiles the same
rule into one ``CASE`` of ``contains`` tests instead, a byte scan per word,
for sessions without Python workers.)

Order of categories = priority: the nine sport categories, then positive
emotions, then negative emotions; no hit → null (or ``fill``).

Words that can never decide the result are dropped before compiling
(exact, by the rule itself): a word that contains a word of the same or
an earlier category always co-occurs with that word, so the earlier arm
already fires.  E.g. "swimming" (has "swim"), "happy" (has "app").
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake import config as C


def _ordered_rules(sport_keywords=None, positive=None, negative=None) -> list[tuple[str, list[str]]]:
    rules = [(cat, list(words)) for cat, words in (sport_keywords or C.SPORT_KEYWORDS)]
    rules.append((C.POSITIVE_EXPERIENCE, list(positive or C.POSITIVE_EMOTIONS)))
    rules.append((C.NEGATIVE_EXPERIENCE, list(negative or C.NEGATIVE_EMOTIONS)))
    return rules


def keyword_rules(sport_keywords=None, positive=None, negative=None) -> list[tuple[str, list[str]]]:
    """``[(category, words)]`` in priority order with undecisive words removed."""
    rules = _ordered_rules(sport_keywords, positive, negative)
    earlier: list[str] = []          # words of categories already emitted
    out: list[tuple[str, list[str]]] = []
    for cat, words in rules:
        uniq = list(dict.fromkeys(w.lower() for w in words if w))
        keep = []
        for w in uniq:
            shadowed = any(v in w for v in earlier) or any(v != w and v in w for v in uniq)
            if not shadowed:
                keep.append(w)
        out.append((cat, keep))
        earlier.extend(keep)
    return out


def _any_contains(lower_text: Column, words: list[str]) -> Column:
    cond = None
    for w in words:
        c = lower_text.contains(w)
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)


def keyword_category(lower_text: Column, rules: list[tuple[str, list[str]]] | None = None) -> Column:
    """Category of an already lower-cased text column, null when nothing hits."""
    expr = None
    for cat, words in rules or keyword_rules():
        cond = _any_contains(lower_text, words)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr


def automaton_category(lower_text: Column, rules: list[tuple[str, list[str]]] | None = None) -> Column:
    """The same by one pass of an automaton over each text."""
    rules = rules or keyword_rules()
    names, ranked = [cat for cat, _ in rules], [(w, rank) for rank, (_, words) in reversed(list(enumerate(rules))) for w in words]

    def category(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick
        words = ahocorasick.Automaton()
        for w, rank in ranked:                       # of equal words the best rank is added last and stays
            words.add_word(w, rank)
        words.make_automaton()

        def best(text: str | None) -> str | None:
            low = len(names)
            if text and ranked:
                for _, rank in words.iter(text):
                    if rank < low:
                        low = rank
                        if not low:
                            break
            return names[low] if low < len(names) else None

        for col in batches:
            yield pa.chunked_array([pa.array(map(best, col.slice(at, 256).to_pylist()), pa.string())
                                    for at in range(0, len(col), 256)], pa.string()).combine_chunks()

    return F.arrow_udf(category, "string")(lower_text)


def classify_text(text: Column, rules=None, native: bool = False) -> Column:
    """Keyword category of a raw text column (null when nothing hits).

    The native form binds the lower-cased text once as a lambda variable: a
    plain projected alias would be substituted back into every arm when a
    filter on the category is pushed down, and ``lower`` run once per word.
    """
    if native:
        return F.element_at(F.transform(F.array(F.lower(text)), lambda t: keyword_category(t, rules)), 1)
    return automaton_category(F.lower(text), rules)


def with_keyword_category(df: DataFrame, text_col: str = "text", out: str = "sport_category",
                          fill: str | None = "other", rules=None, native: bool = False) -> DataFrame:
    """Add (or overwrite) ``out`` with the keyword category of ``text_col``.

    A null text classifies as null (then ``fill``)."""
    cat = classify_text(F.col(text_col), rules, native)
    if fill is not None:
        cat = F.coalesce(cat, F.lit(fill))
    return df.withColumn(out, cat)
