"""A large lexicon by rule, for checks of lexicons beyond a few words."""

from __future__ import annotations

from string import ascii_lowercase

from reviewlake import config as C


def big_lexicon() -> dict[str, float]:
    """The default lexicon, then every two-letter token and its doubling
    (``ab``, ``abab``) with a polarity that follows from its letters."""
    out = dict(C.DEFAULT_LEXICON)
    for i, a in enumerate(ascii_lowercase):
        for j, b in enumerate(ascii_lowercase):
            for w in (a + b, (a + b) * 2):
                out.setdefault(w, ((7 * i + 3 * j + len(w)) % 21 - 10) / 10)
    return out
