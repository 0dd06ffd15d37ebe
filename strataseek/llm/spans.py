"""Values of byte spans, computed once per distinct span.

A tokenizer is slow and most words repeat. A batch is cut into spans, each distinct span is handed
to the tokenizer once, and the answers are spread over the batch by numpy. Known spans stay in a
table of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from strataseek.llm.common import mix, span_hashes

MAX_KNOWN = 1_000_000

#: One value per byte, so that spans that differ in case differ too.
_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class SpanTable:
    """``fill`` gets a list of spans (bytes) and returns (length of each answer, all answers in one array)."""

    def __init__(self, fill: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype, most: int = MAX_KNOWN):
        self.fill, self.dtype, self.most = fill, dtype, most
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.at = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, self.dtype)
        self.used = 0

    def _learn(self, keys: list[int], spans: list[bytes]) -> None:
        sizes, flat = self.fill(spans)
        low, high = len(self.known), len(self.known) + len(keys)
        while high > len(self.at):
            self.at, self.size = np.tile(self.at, 2), np.tile(self.size, 2)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.tile(self.pool, 2)
        self.size[low:high] = sizes
        self.at[low:high] = self.used + np.cumsum(sizes) - sizes
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        self.known.update(zip(keys, range(low, high)))

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                marks: np.ndarray | None = None, prefix: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Place and length in ``pool`` of the answer for each span.

        Spans with a true ``marks`` are handed to ``fill`` with ``prefix`` before them.
        """
        hashes = span_hashes(data, starts, ends, _EXACT)
        if marks is not None:
            hashes[marks] = mix(hashes[marks] ^ np.uint64(0xA0761D6478BD642F))
        keys, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > self.most:
            self._clear()
        listed = keys.tolist()
        new = [i for i, key in enumerate(listed) if key not in self.known]
        if new:
            chosen = first[new]
            raw = data.tobytes()
            spans = [raw[a:b] for a, b in zip(starts[chosen].tolist(), ends[chosen].tolist())]
            if marks is not None:
                spans = [prefix + s if m else s for s, m in zip(spans, marks[chosen].tolist())]
            self._learn([listed[i] for i in new], spans)
        found = np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))
        return self.at[found][back], self.size[found][back]


def gather(pool: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``pool[at[i]:at[i] + size[i]]`` for all i, one after the other."""
    total = int(size.sum())
    if not total:
        return pool[:0]
    shift = at - (np.cumsum(size) - size)
    return pool[np.repeat(shift, size) + np.arange(total)]


def per_row(rows: np.ndarray, size: np.ndarray, n_rows: int) -> np.ndarray:
    """Sum of ``size`` per row."""
    return np.bincount(rows, weights=size, minlength=n_rows).astype(np.int64)
