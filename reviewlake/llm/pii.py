"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, schemes,
obfuscated at-signs, street words and identifier cues.  A local parser for
each anchor expands left and right, and validates what it found:

========  =====================================================================
email     local part left of an at-sign, dotted domain right of it
ip        four dotted numbers, each at most 255
card      14 to 19 digits, single spaces or hyphens between, Luhn check digit
phone     a plus sign and 10 to 15 digits with usual separators
address   ``mailto:`` / ``tel:`` links, user names in URLs, "name (at) host (dot)
          tld", and house number with street name
account   IBAN (mod 97), Spanish tax and identity numbers (check letter), the
          identifier or secret that follows a cue such as "account", "SSN",
          "tax id", "token", "pwd", "Bearer", "access key", and what shows
          itself as a secret: private keys in PEM blocks, web tokens
          (``eyJ...``), keys with a known prefix (AKIA, ``ghp_``, ``sk_live_``, ``xoxb-``)
========  =====================================================================

The first four are the base kinds: per kind leftmost and non-overlapping,
a match that fails its check is passed over whole.  Of the other two the
parts outside base spans are added, except a bare scheme and parts without
letters and digits.

Cues and schemes are found in any case (street words as written).  What follows a cue is
taken to its end, however long: an identifier to the first sign that is no
letter, digit, underscore or hyphen, a secret (token, secret, password, API
key) to white space or one of ``"'`,;:&|<>()[]{}\\``, in quotes to white space or the closing
quote; groups of two to four digits or capitals may follow.  Taken are

* identifiers of six or more characters with four or more digits;
* secrets like them; behind ``:``, ``=``, a quote or "Bearer" also those of eight or
  more characters with a letter and a digit, anywhere those of sixteen or more;
* passwords (password, passwd, pwd, passphrase) behind ``:`` or ``=`` whatever their
  signs, of twelve or more characters, or of six or more in quotes.

A PEM block without its end line reaches to its last line of 16 or more
base64 signs.  A house number is looked for in the 80 characters before the street word;
before an abbreviation (St., Ave., Rd., Blvd., Ln.) the street's names begin
with capitals.

Each anchor is visited once and parsers stop at the previous match of their
kind (cues keep the run that they last saw), so the work is linear in the text.  Cases: a null or empty text has no
spans; rows that repeat an id each give a row; an empty table gives an
empty result; ``redact`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import map_arrow, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "address", "account")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_SCHEMES = ("mailto:", "tel:", "http://", "https://", "ftp://", "ssh://")
_AT_WORDS = ("(at)", "[at]", "{at}")
_STREETS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Straße", "straße", "Calle", "Rue ", "rue ", "St.", "Ave.", "Rd.", "Blvd.", "Ln.")
_PASSWORDS = ("password", "passwd", "pwd", "passphrase")
_SECRETS = ("token", "secret", "api_key", "api key", "api-key", "apikey", "access_key", "access key", "access-key", "accesskey", "bearer", *_PASSWORDS)
_SPANISH = ("nif", "nie", "dni")
_CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn", "passport", "tax id", "tax_id", "taxpayer id",
         "steuer-id", "steuernummer", "national id", "national insurance", *_SPANISH, *_SECRETS)
#: Prefixes of keys that services hand out, with the signs that follow.
_KEYS = {"akia": r"AKIA[0-9A-Z]{16,}", "asia": r"ASIA[0-9A-Z]{16,}", "ghp_": r"ghp_[A-Za-z0-9]{20,}", "gho_": r"gho_[A-Za-z0-9]{20,}",
         "ghs_": r"ghs_[A-Za-z0-9]{20,}", "ghu_": r"ghu_[A-Za-z0-9]{20,}", "github_pat_": r"github_pat_\w{20,}", "sk_live_": r"sk_live_[A-Za-z0-9]{16,}",
         "rk_live_": r"rk_live_[A-Za-z0-9]{16,}", "xoxb-": r"xoxb-[A-Za-z0-9-]{16,}", "xoxp-": r"xoxp-[A-Za-z0-9-]{16,}", "aiza": r"AIza[A-Za-z0-9_-]{30,}",
         "eyj": r"eyJ[A-Za-z0-9_-]{5,}\.eyJ[A-Za-z0-9_-]{5,}(?:\.[A-Za-z0-9_-]*)?",
         "-----begin ": r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:(?:[^-]|-(?!----))*+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"
                        r"|(?:\s+[A-Za-z0-9+/=]{16,})*)"}
_MAILTO = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+|\+?[0-9][0-9().\x20-]{5,}[0-9]")
_USERINFO = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9.-]+")
_DOT_WORD = re.compile(r"[\x20]?[\x20]?([A-Za-z0-9-]+(?:(?:\x20?[(\[{]dot[)\]}]\x20?|\.)[A-Za-z0-9-]+)+)")
_NUMBER_LEFT = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]?,?(?:\x20[^\W\d_][\w.'-]*){1,3}\x20$")
_NUMBER_LEFT_CAPITALS = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]?,?(?:\x20[^\W\d_a-z][\w'-]*){1,3}\x20$")
_NUMBER_LEFT_JOINED = re.compile(r"(?<!\w)[^\W\d_][\w.'-]*$")
_STREET_RIGHT = re.compile(r"(?:\x20[^\W\d_][\w.'-]*){1,3},?\x20[0-9]{1,5}(?![0-9])")
_NUMBER_RIGHT = re.compile(r"\x20[0-9]{1,5}[A-Za-z]?(?![0-9A-Za-z])")
_NAMED = r"(?i:[\x20_-]?(?:number|nummer|num|nr|no|id|key)\.?)?(?![^\W\d_])"
_LEAD = _NAMED + r"\x20?[:=#]?\x20?[\"']?"
_FIRST = re.compile(_LEAD + r"(?=[A-Za-z0-9](?:[A-Za-z0-9_-]|\x20(?=[0-9A-Z]{2,4}\b)){5})")
_FIRST_SECRET = re.compile(_LEAD + r"(?=[A-Za-z0-9](?:[!#$%*+./0-9=?@A-Z^_a-z~-]|\x20(?=[0-9A-Z]{2,4}\b)){5})"
                           r"|" + _NAMED + r"\x20?(?:[:=]\x20?(?=[!#$%*+./0-9=?@A-Z^_a-z~-]{6})"
                           r"|[:=#]?\x20?(?:\"(?=[^\s\"]{6})|'(?=[^\s']{6})))")
_PLAIN = re.compile(r"[A-Za-z0-9_-]*")
_SECRET = re.compile(r"[!#$%*+./0-9=?@A-Z^_a-z~-]*")
_QUOTED = {q: re.compile(rf"[^\s{q}]*") for q in "\"'"}      # a secret in quotes may hold any other sign
_GROUPS = re.compile(r"(?:\x20(?=[0-9A-Z]{2,4}\b)[A-Za-z0-9_-]+)*")
_SPANISH_ID = re.compile(_LEAD + r"([XYZxyz]?)-?([0-9]{7,8})[\x20-]?([A-Za-z])(?![A-Za-z0-9])")
_LETTER = re.compile(r"[^\W\d_]")


def _folded(text: str) -> str:
    """The text in lower case, every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for c in _DIGITS:
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    for kind, words in (("scheme", _SCHEMES), ("at_word", _AT_WORDS), ("street", _STREETS)):
        for w in words:
            a.add_word(_folded(w), (kind, len(w)))
    for w in _CUES:
        a.add_word(w, ("cue", len(w)))
    for w in _KEYS:
        a.add_word(w, ("key", len(w)))
    a.make_automaton()
    return a


_AUTOMATON = None
_KEY = {w: re.compile(p) for w, p in _KEYS.items()}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(s: str) -> bool:
    s = s.replace(" ", "").replace("-", "").upper()
    if not (15 <= len(s) <= 34 and s.isascii() and s.isalnum() and s[:2].isalpha() and s[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def spanish_id(first: str, digits: str, letter: str) -> bool:
    """Check letter of a Spanish tax or identity number."""
    if len(first + digits) != 8:
        return False
    return "TRWAGMYFPDXBNJZSQVHLCKE"[int(str("XYZ".index(first.upper())) + digits if first else digits) % 23] == letter.upper()


def base_and_added(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((start, kind number, end) of base spans, the same of added ones)."""
    global _AUTOMATON
    if _AUTOMATON is None:
        _AUTOMATON = _automaton()
    base: list[tuple[int, int, int]] = []
    more: list[tuple[int, int, int]] = []
    past = [0] * len(KINDS)                  # end of the last match of each kind, also of failed ones
    last_digit, runs = -2, {}
    for last, (anchor, n) in _AUTOMATON.iter(_folded(text)):
        at = last - n + 1
        if anchor == "digit":
            begins, last_digit = at != last_digit + 1, at
            if begins:
                if at >= past[1] and (m := _IP.match(text, at)):
                    past[1] = m.end()
                    if all(int(x[-4:]) <= 255 and len(x.lstrip("0")) <= 3 for x in m.group().split(".")):
                        base.append((at, 1, m.end()))
                if at >= past[2] and (m := _CARD.match(text, at)):
                    past[2] = m.end()
                    if m.end() - at >= 14:
                        digits = _NOT_DIGIT.sub("", m.group())
                        if 14 <= len(digits) <= 19 and luhn(digits):
                            base.append((at, 2, m.end()))
        elif anchor == "at":
            lo = at
            while lo > past[0] and text[lo - 1] in _LOCAL:
                lo -= 1
            if lo < at and (m := _DOMAIN.match(text, at)):
                past[0] = m.end()
                base.append((lo, 0, m.end()))
        elif anchor == "plus":
            if at >= past[3] and (m := _PHONE.match(text, at)):
                past[3] = m.end()
                if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    base.append((at, 3, m.end()))
        else:
            span = _cue(text, at, last + 1, runs) if anchor == "cue" else _ADDED[anchor](text, at, last + 1)
            if span and span[0] >= past[span[1]]:
                past[span[1]] = span[2]
                more.append(span)
    base.sort()
    return base, _apart(text, base, more)


def _scheme(text: str, at: int, end: int):
    pattern = _MAILTO if text[at:end].lower() in ("mailto:", "tel:") else _USERINFO
    m = pattern.match(text, end)
    return (at, 4, m.end()) if m else None


def _at_word(text: str, at: int, end: int):
    lo = at - 1 if at and text[at - 1] == " " else at
    stop = lo
    while lo and text[lo - 1] in _LOCAL:
        lo -= 1
    m = _DOT_WORD.match(text, end)
    return (lo, 4, m.end()) if lo < stop and m else None


def _street(text: str, at: int, end: int):
    word, left = text[at:end], text[max(0, at - 80):at]
    if word not in _STREETS:
        return None
    if word in ("Calle", "Rue ", "rue "):
        m = _STREET_RIGHT.match(text, end - word.endswith(" "))
        if m:
            return at, 4, m.end()
        n = re.search(r"(?<![0-9A-Za-z])[0-9]{1,5},?\x20$", left) if word != "Calle" else None
        m = re.compile(r"[^\W\d_][\w'-]*(?:\x20[^\W\d_][\w'-]*){0,2}").match(text, end) if n else None
        return (at - (n.end() - n.start()), 4, m.end()) if m else None
    if word.lower() == "straße":
        n, m = _NUMBER_LEFT_JOINED.search(left), _NUMBER_RIGHT.match(text, end)
        return (at - (len(n.group()) if n else 0), 4, m.end()) if m else None
    n = (_NUMBER_LEFT_CAPITALS if word.endswith(".") else _NUMBER_LEFT).search(left)
    return (at - len(n.group()), 4, end) if n and (end == len(text) or not text[end].isalnum()) else None


def _key(text: str, at: int, end: int):
    if at and text[at - 1].isalnum():
        return None
    m = _KEY[text[at:end].lower()].match(text, at)
    return (at, 5, m.end()) if m else None


def _run(text: str, at: int, pattern: re.Pattern, runs: dict) -> tuple[int, list[int], int]:
    """(end, places of the last four digits, place of the last letter) of the
    run of the pattern's signs around ``at``.  The last run of each pattern is
    kept, as cues inside a run all end with it."""
    lo, end, digits, letter = runs.get(pattern, (0, 0, [], -1))
    if not lo <= at < end:
        end, digits, letter = pattern.match(text, at).end(), [], -1
        k = end
        while k > at and (len(digits) < 4 or letter < 0):
            k -= 1
            if text[k] in _DIGITS:
                digits.append(k)
            elif letter < 0 and text[k].isalpha():
                letter = k
        digits = digits[:4]
        runs[pattern] = (at, end, digits, letter)
    return end, digits, letter


def _cue(text: str, at: int, end: int, runs: dict):
    if at and text[at - 1].isalnum():
        return None
    cue = text[at:end].lower()
    if cue in _SPANISH:
        m = _SPANISH_ID.match(text, end)
        return (m.start(1), 5, m.end()) if m and spanish_id(*m.groups()) else None
    m = (_FIRST_SECRET if cue in _SECRETS else _FIRST).match(text, end)
    if not m:
        return None
    lo = m.end()
    stop, digits, letter = _run(text, lo, _PLAIN, runs)
    quote = None
    if cue in _SECRETS:
        quote = text[lo - 1] if text[lo - 1] in _QUOTED else None
        far, more, last = _run(text, lo, _QUOTED[quote] if quote else _SECRET, runs)
        if not quote:
            while far > stop and text[far - 1] in ".!?":         # ends the sentence, not the secret
                far -= 1
        # a date or amount with dots or slashes is no secret: what its plain part does not show needs a letter
        if far > stop and (stop - lo >= 6 and sum(d >= lo for d in digits) >= 4 or _LETTER.search(text, lo, far)):
            stop, digits, letter = far, more, last
    size, n, whole = stop - lo, sum(d >= lo for d in digits), stop
    stop, digits, _ = _run(text, whole, _GROUPS, runs)
    mixed, n = n and letter >= lo, n + sum(d >= whole for d in digits)
    if cue == "iban":
        value = text[lo:min(stop, lo + 67)]                       # 34 characters and what may part them
        for k in range(len(value), 14, -1):
            if iban(value[:k]) and value[k - 1] != " ":
                return lo, 5, lo + k
        return None
    if n >= 4 and stop - lo >= 6:
        return lo, 5, stop
    if cue not in _SECRETS:
        return None
    told = set(":=\"'") & set(m.group())
    if mixed and (size >= 16 or size >= 8 and (told or cue == "bearer")):
        return lo, 5, whole
    return (lo, 5, whole) if cue in _PASSWORDS and told & {":", "="} and size >= (6 if quote else 12) else None


_ADDED = {"scheme": _scheme, "at_word": _at_word, "street": _street, "key": _key}


def _apart(text: str, base: list, more: list) -> list:
    """The parts of the added spans outside base spans."""
    taken: list[tuple[int, int]] = []
    for s, _, e in base:                     # sorted; base kinds may overlap each other
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(taken[-1][1], e))
        else:
            taken.append((s, e))
    ends, out = [e for _, e in taken], []
    for start, kind, end in more:
        at, k = start, bisect_right(ends, start)
        while at < end:
            lo, hi = taken[k] if k < len(taken) else (end, end)
            part = text[at:min(lo, end)]
            if any(map(str.isalnum, part)) and part.lower() not in _SCHEMES:
                out.append((at, kind, at + len(part)))
            at, k = max(at, hi), k + 1
    return out


def span_string(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans become one, named by the first."""
    base, more = base_and_added(text)
    out, at = [], 0
    for s, k, e in sorted(base + more):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts and digest of the base spans
    and all spans as ``kind:start:end`` (code points, end exclusive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, digest, spans = np.zeros((b.num_rows, len(BASE)), np.int64), [], []
            for r, t in enumerate(texts(b.column(1)).to_pylist()):
                base, more = base_and_added(t)
                for _, k, _ in base:
                    counts[r, k] += 1
                digest.append(hashlib.sha256(span_string(base).encode()).hexdigest())
                spans.append(span_string(base + more))
            yield pa.record_batch([b.column(0), *map(pa.array, counts.T.copy()), pa.array(digest), pa.array(spans, pa.string())], names=names)

    names = ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"]
    out = map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run,
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return out.withColumnRenamed("doc_id", id_col)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col`` (null stays null)
    and ``length_col``, if there is such a column, set to the new length of
    the texts that changed."""
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols, old = list(b.columns), b.column(at)
            new = [t if t is None else redacted(t) for t in old.to_pylist()]
            cols[at] = pa.array(new, old.type)
            if length is not None:
                changed = pc.fill_null(pc.not_equal(cols[at], old), False)
                cols[length] = pc.if_else(changed, pc.utf8_length(cols[at]).cast(cols[length].type), cols[length])
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return map_arrow(docs, run, docs.schema)
