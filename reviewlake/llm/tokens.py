"""Exact tokenization of Arrow text batches with the tokenizers library.

A text is cut where the tokenizer's own pre-tokenizer always cuts (between
a word and the white space after it), the distinct pieces of a batch are
encoded by the library, and the ids are gathered back with numpy.  The ids
are those of encoding each whole text; only repeated pieces are not encoded
twice.  A memo, bounded in pieces, ids and the length of a piece, keeps them
between batches; what one batch adds beyond it is written over by the next.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reviewlake.llm.common import texts

# What a worker's memo may hold: pieces (about 120 MB), ids of them (32 MB),
# and characters of one piece, so that unbroken texts do not stay in it.
MEMO_PIECES, MEMO_IDS, MEMO_LONGEST = 600_000, 8_000_000, 64
# White space as the tokenizers' patterns see it: str.isspace without the
# four ASCII separators.
_SPACE, _OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_PIECE = re.compile(f"{_SPACE}*{_OTHER}+|{_SPACE}+")
# Where the patterns always cut: between a letter and closing punctuation
# before white space, and before a single white-space character.  Only
# letters that no normal form or lower-casing takes apart are listed.
_CLOSING = r"([a-z\x{DF}-\x{F6}\x{F8}-\x{FF}])([.,;:!?]+)(\s|\x1e|$)"
_MARK = "\x1e"
_UNSAFE = r"[\s\x0B\x{85}\pZ][\s\x0B\x{85}\pZ]|\x1e"       # longer white space, or the mark itself


def tokenizer_json(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class PieceEncoder:
    """``keeps_space``: white space belongs to the tokens (byte-level BPE);
    otherwise the tokenizer drops it."""

    def __init__(self, json_text: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(json_text)
        self.keeps_space = keeps_space
        self.codes: dict[str, int] = {}
        self.pool, self.used = np.zeros(0, np.uint32), 0      # ids of all pieces in the memo, one after the other
        self.stale = False                                    # memo and pool start anew with the next batch

    def _pieces(self, col: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Pieces of each text: counts and flat strings."""
        if not self.keeps_space:
            cut = pc.ascii_split_whitespace(pc.replace_substring_regex(col, _CLOSING, r"\1 \2\3"))
            return np.diff(cut.offsets.to_numpy()), cut.flatten()
        marked = col
        for space in (" ", "\n"):
            marked = pc.replace_substring(marked, space, _MARK + space)
        cut = pc.split_pattern(pc.replace_substring_regex(marked, _CLOSING, rf"\1{_MARK}\2\3"), _MARK)
        counts, flat = np.diff(cut.offsets.to_numpy()).astype(np.int64), cut.flatten()
        unsafe = pc.match_substring_regex(col, _UNSAFE).to_numpy(zero_copy_only=False)
        if not unsafe.any():
            return counts, flat
        starts = np.cumsum(counts) - counts
        parts, at = [], 0
        for i, text in zip(np.flatnonzero(unsafe), col.filter(pa.array(unsafe)).to_pylist()):
            own = _PIECE.findall(text)
            parts += [flat.slice(at, starts[i] - at), pa.array(own, flat.type)]
            at, counts[i] = starts[i] + counts[i], len(own)
        parts.append(flat.slice(at))
        return counts, pa.concat_arrays(parts)

    def _lookup(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(first id in the pool, ids) of each piece."""
        if self.stale:                                 # the memo holds other words than the text does now
            self.codes, self.pool, self.used, self.stale = {}, np.zeros(0, np.uint32), 0, False
        codes = list(map(self.codes.get, pieces))
        unknown = [i for i, c in enumerate(codes) if c is None]
        if unknown:
            unknown.sort(key=lambda i: len(pieces[i]) > MEMO_LONGEST)         # those that may stay come first
            ids = [e.ids for e in self.tok.encode_batch_fast([pieces[i] for i in unknown], add_special_tokens=False)]
            size = list(map(len, ids))
            at, more = self.used, sum(size)
            if at + more > len(self.pool):
                self.pool = np.concatenate([self.pool[:at], np.zeros(at + 2 * more, np.uint32)])
            self.pool[at:at + more] = np.fromiter(chain.from_iterable(ids), np.uint32, more)
            room = MEMO_PIECES - len(self.codes)
            for k, (i, n) in enumerate(zip(unknown, size)):
                codes[i] = code = at << 24 | n         # a piece has fewer than 2^24 ids
                at += n
                if k < room and at <= MEMO_IDS and len(pieces[i]) <= MEMO_LONGEST:
                    self.codes[pieces[i]] = code
                    self.used = at
            full = len(self.codes) >= MEMO_PIECES or self.used + MEMO_LONGEST >= MEMO_IDS
            self.stale = full and len(unknown) > len(pieces) // 2
        codes = np.fromiter(codes, np.int64, len(codes))
        return codes >> 24, codes & 0xFFFFFF

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, all ids as uint32) of a string array (null: empty)."""
        col = texts(col)
        counts, flat = self._pieces(col)
        if not len(flat):
            return np.zeros(len(col), np.int64), np.zeros(0, np.uint32)
        enc = flat.dictionary_encode()
        begin, size = self._lookup(enc.dictionary.to_pylist())
        which = enc.indices.to_numpy()
        n = size[which]
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(begin[which] - total[:-1], n)
        at += np.arange(total[-1])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(total[ends]), self.pool[at]


_ENCODERS: dict[tuple[int, bool], PieceEncoder] = {}


def encoder(json_text: str, keeps_space: bool) -> PieceEncoder:
    """One encoder for each tokenizer in a worker process."""
    key = (hash(json_text), keeps_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(json_text, keeps_space)
    return _ENCODERS[key]


def append_end(per_text: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    ends = np.cumsum(per_text)
    return per_text + 1, np.insert(ids, ends, np.uint32(end_id))
