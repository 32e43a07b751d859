"""Scorers of the factory contract, for tests of the scoring path only."""

from __future__ import annotations

from reviewlake import config as C


def letter_stars_factory():
    """"N stars" with N = 1 + (number of 'e' in the text) mod 5."""
    def score(texts):
        return [f"{1 + t.count('e') % 5} stars" for t in texts]
    return score


def length_topic_factory():
    """Candidate label by text length; texts containing '1' make the scorer
    raise (exercises the per-row failure path → "other")."""
    labels = list(C.ZERO_SHOT_LABELS)

    def score(texts):
        out = []
        for t in texts:
            if "1" in t:
                raise ValueError("unscorable text")
            out.append(labels[len(t) % len(labels)])
        return out
    return score
