"""Script blocks of HTML pages, found by a tokenizer over Arrow batches.

A page is read once, from one ``<`` to the next that opens something:

* a comment (``<!--`` to ``-->`` or ``--!>``), a declaration or a processing
  instruction is passed over whole;
* a tag ends at the first ``>`` outside quoted attribute values; attributes
  are quoted with ``"`` or ``'``, bare, or have no value, and names are
  compared in any case; of repeated attributes the first counts;
* what follows ``<script>``, ``<style>``, ``<title>``, ``<textarea>``,
  ``<xmp>``, ``<iframe>``, ``<noembed>`` or ``<noframes>`` is text up to the
  element's own end tag (``</script >`` and ``</SCRIPT>`` are end tags).

A script that is never closed runs to the end of the page; a page that ends
inside a tag holds nothing after it.  A null page gives null, an empty one
an empty array.  Every pattern is possessive and every search goes forward,
so the work is linear in the page whatever it holds.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_TEXT = ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes")

_SPACE = r"[ \t\n\f\r]"
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_QUOTED, _APOSTROPHES, _BARE = r'[^"]*+', r"[^']*+", r"""[^ \t\n\f\r>"'][^ \t\n\f\r>]*+"""


def _attribute(group: str) -> str:
    """Pattern of one attribute; ``group`` opens its name and values."""
    value = rf"""(?:"{group}{_QUOTED})(?:"|\Z)|'{group}{_APOSTROPHES})(?:'|\Z)|{group}{_BARE})|(?=>)|\Z)"""
    return rf"[ \t\n\f\r/]*+{group}{_NAME})(?:{_SPACE}*+={_SPACE}*+{value})?+"


_ATTRIBUTE = re.compile(_attribute("("))
_OPENS = re.compile(r"<(?:!--|[!?]|/?([A-Za-z][^ \t\n\f\r/>]*+)|/)")
_TAG_REST = re.compile(rf"(?:{_attribute('(?:')})*+[ \t\n\f\r/]*+>")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[ \t\n\f\r/>])", re.IGNORECASE) for name in RAW_TEXT}


def attributes(text: str, at: int, end: int) -> dict[str, str]:
    """Attributes of the tag whose name ends at ``at`` and whose ``>`` stands before ``end``."""
    out: dict[str, str] = {}
    while (m := _ATTRIBUTE.match(text, at, end - 1)) is not None:
        value = next((v for v in m.groups()[1:] if v is not None), "")
        out.setdefault(m.group(1).lower(), html.unescape(value))
        at = m.end()
    return out


def scripts(text: str, media_type: str) -> list[str]:
    """Bodies of the script elements whose ``type`` is ``media_type``."""
    out, at = [], 0
    while (m := _OPENS.search(text, at)) is not None:
        at = m.end()
        name = m.group(1)
        if name is None:
            if text.startswith("<!--", m.start()):
                if text.startswith((">", "->"), at):
                    at = text.index(">", at) + 1
                    continue
                stop = _COMMENT_END.search(text, at)
                at = stop.end() if stop else len(text)
            else:
                at = (text.find(">", at) + 1) or len(text)
            continue
        tag = _TAG_REST.match(text, at)
        if tag is None:                                   # the page ends inside a tag
            break
        after, name = tag.end(), name.lower()
        if text[m.start() + 1] != "/" and name in _RAW_END:
            stop = _RAW_END[name].search(text, after)
            body = stop.start() if stop else len(text)
            if name == "script" and attributes(text, at, after).get("type", "").strip().lower() == media_type:
                out.append(text[after:body])
            after = body
        at = after
    return out


# Characters of script bodies that a worker holds as Python strings at a time
# (and the page being read): a batch of pages is never decoded whole.
HELD_CHARS = 1 << 20


def found_scripts(batches: Iterator[pa.Array], media_type: str) -> Iterator[pa.Array]:
    """The scripts of each page, in arrays that end once they hold ``HELD_CHARS``."""
    for col in batches:
        found, held = [], 0
        for page in col:
            text = page.as_py()
            found.append(None if text is None else scripts(text, media_type))
            held += sum(map(len, found[-1] or ()))
            if held >= HELD_CHARS:
                yield pa.array(found, pa.list_(pa.string()))
                found, held = [], 0
        yield pa.array(found, pa.list_(pa.string()))


def script_blocks(page: Column, media_type: str = "application/ld+json") -> Column:
    """All script bodies of one type of an HTML page, as an array of strings."""

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return found_scripts(batches, media_type)

    return F.arrow_udf(find, "array<string>")(page)
