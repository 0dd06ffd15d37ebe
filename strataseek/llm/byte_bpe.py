"""Byte-level BPE ids of whole texts with the tokenizers library, distinct word spans only once.

A text may be cut wherever the pre-tokenizer always starts a new piece, as pieces are encoded
apart: before blanks that follow a letter, digit or ASCII sign, and before an ASCII sign that
follows a letter. Runs of other blanks and other scripts stay in one span.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from strataseek.llm.common import BLANK
from strataseek.llm.spans import SpanTable, gather, per_row

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = True
_SIGN &= ~_LETTER & ~_DIGIT
#: The second byte of the letters U+00C0 - U+00FF (all but the signs of times and division).
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False

#: Below it every library has the same notion of a letter.
_FEWER_LETTERS = "\u0250"


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions where a span starts."""
    start = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        before, here = data[:-1], data[1:]
        letter = _LETTER[before]
        letter[1:] |= (data[:-2] == 0xC3) & _LATIN[before[1:]]
        solid = letter | _DIGIT[before] | _SIGN[before]
        start[1:-1] = (BLANK[here] & solid) | (_SIGN[here] & letter)
    start[offsets] = True
    return np.flatnonzero(start[:-1])


class ByteBpe:
    """Encoder of one worker; ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._letters = {b: chr(c) for b, c in enumerate(_byte_letters())}
        self._special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spans = SpanTable(self._fill, self.dtype)

    def _fill(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        one_piece = self.tokenizer.model.tokenize
        out: list[list[int] | None] = [None] * len(spans)
        other = []
        for i, span in enumerate(spans):
            word = span.decode()
            body = word[1:] if word[:1] == " " else word
            if body.isalpha() and max(body) < _FEWER_LETTERS:  # letters after at most one space are one piece
                out[i] = [t.id for t in one_piece(span.decode("latin-1").translate(self._letters))]
            else:
                other.append(i)
        encoded = self.tokenizer.encode_batch_fast([spans[i].decode() for i in other], add_special_tokens=False)
        for i, encoding in zip(other, encoded):
            out[i] = encoding.ids
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return sizes, np.fromiter(chain.from_iterable(out), self.dtype, int(sizes.sum()))

    def _outside_special(self, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """No cut inside the text of a special token, which the library takes as one id."""
        raw = data.tobytes()
        for token in self._special:
            place = raw.find(token)
            while place >= 0:
                inside = (starts > place) & (starts < place + len(token)) & ~np.isin(starts, offsets)
                starts = starts[~inside]
                place = raw.find(token, place + 1)
        return starts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all rows in one array, and the number of ids of each row."""
        n_rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(n_rows, np.int64)
        starts = self._outside_special(data, offsets, cuts(data, offsets))
        ends = np.append(starts[1:], len(data))
        at, size = self.spans.look_up(data, starts, ends)
        rows = np.searchsorted(offsets, starts, side="right") - 1
        return gather(self.spans.pool, at, size), per_row(rows, size, n_rows)


def _byte_letters() -> list[int]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [b if b in plain else next(others) for b in range(256)]
