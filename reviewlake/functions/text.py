"""String column functions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def contains_any(col: Column, words: list[str]) -> Column:
    """True when ``col`` contains any of ``words`` (substring, case as given);
    no words: false."""
    hit = F.lit(False)
    for w in dict.fromkeys(words):
        hit = hit | col.contains(w)
    return hit


def length_cp(col: Column) -> Column:
    """Length in code points."""
    return F.length(col)


def prefix(col: Column, n: int) -> Column:
    """First ``n`` code points (``s[:n]``)."""
    return F.substring(col, 1, n)


def preview(col: Column, n: int) -> Column:
    """``s[:n] + '...'`` as printed in reports."""
    return F.concat(F.substring(col, 1, n), F.lit("..."))


def strip_chars(col: Column, chars: str) -> Column:
    """Strip any of ``chars`` from both ends (``str.strip(chars)``)."""
    return F.btrim(col, F.lit(chars))


def nullif_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def zero_pad(col: Column, width: int) -> Column:
    """``f"{i:0{width}d}"`` — grows past ``width`` instead of truncating."""
    return F.format_string(f"%0{width}d", col)


def title_case(col: Column) -> Column:
    """Python ``str.title()`` for letter runs: each run of letters gets an
    upper-case first letter and lower-case rest; other characters stay."""
    pieces = F.split(col, r"(?<=[^\p{L}])|(?=[^\p{L}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))),
        "",
    )


def bar(count: Column, char: str = "█") -> Column:
    """``char * int(count)``; negative or null counts give an empty string."""
    n = F.coalesce(count.cast("int"), F.lit(0))
    return F.repeat(F.lit(char), F.greatest(n, F.lit(0)))


def ljust(col: Column, width: int) -> Column:
    """``f"{s:<width}"``: pad with spaces only when shorter (never truncates)."""
    return F.when(F.length(col) < width, F.rpad(col, width, " ")).otherwise(col)


def leading_int(col: Column) -> Column:
    """Integer in front of the first space (``int("4 stars".split()[0])``); null if not a number."""
    return F.element_at(F.split(F.trim(col), r"\s+"), 1).try_cast("int")


def hash_id(prefix_: str, col: Column) -> Column:
    """Deterministic id: prefix + MD5 hex of a text column.

    Same input → same id in every run, process, batch or stream (unlike a
    per-process salted hash), 128 bits wide (no bucket collisions), and
    reproducible by any SQL engine that has ``md5``."""
    return F.concat(F.lit(prefix_), F.md5(col.cast("string")))


def pick(values: Column, index: Column) -> Column:
    """``values[index]`` (1-based), null when the index is null.

    Guarded on purpose: in this Spark build ``element_at`` over a literal
    array returned the *last* element for a null index (see
    tests/test_functions.py::test_pick_null_index)."""
    return F.when(index.isNotNull(), F.element_at(values, index))
