"""Word-piece counts by a linear longest-match automaton (operator 5).

The vocabulary is a trie over bytes: pieces that start a word hang from its root, pieces that go
on within a word from a second root. Where a match cannot grow, a failure link jumps to the trie
node of what is left after the longest pieces have been taken, and a number made beforehand says
how many pieces that takes. So a word's number of greedy longest-match pieces comes out of one
pass over its bytes, and no piece is built. The automaton steps all distinct words of a batch at
once; known words stay in a table.

Words are maximal runs of bytes other than space and 0x09-0x0D, in their own case. A word that the
pieces cannot cover counts as one unknown piece. Null and empty texts have no words. Rows without
doc_id, repeated rows and ties are counted like any other row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataseek.llm.common import buffers, slices, with_bytes, word_spans
from strataseek.llm.sentencepiece_model import MARK, NORMAL, USER, Model
from strataseek.llm.spans import SpanTable, per_row

_NONE = -1
FEW = 16
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown long"


def pieces_of(model_file: str) -> tuple[list[str], list[str]]:
    """Pieces that start a word and pieces that go on in one, from a SentencePiece model."""
    with open(model_file, "rb") as stream:
        model = Model.parse(stream.read())
    words = [p for p, _, kind in model.pieces if kind in (NORMAL, USER)]
    return ([p[1:] for p in words if p[:1] == MARK and len(p) > 1 and MARK not in p[1:]],
            [p for p in words if MARK not in p])


class LongestMatch:
    def __init__(self, first: list[str], later: list[str]):
        children: list[dict[int, int]] = [{}, {}]  # node 0: root of first pieces, node 1: of later ones
        is_piece = [False, False]
        for root, pieces in ((0, first), (1, later)):
            for piece in pieces:
                node = root
                for byte in piece.encode():
                    if byte not in children[node]:
                        children[node][byte] = len(children)
                        children.append({})
                        is_piece.append(False)
                    node = children[node][byte]
                is_piece[node] = is_piece[node] or node > 1
        link, popped = [_NONE] * len(children), [0] * len(children)
        level = [0, 1]
        while level:  # a node's link needs only nodes nearer to the roots
            below = []
            for node in level:
                for byte, child in children[node].items():
                    if is_piece[child]:
                        link[child], popped[child] = 1, 1
                    else:
                        z, n = link[node], popped[node]
                        while z != _NONE and byte not in children[z]:
                            n += popped[z]
                            z = link[z]
                        if z != _NONE:
                            link[child], popped[child] = children[z][byte], n
                    below.append(child)
            level = below
        self.link, self.popped = np.array(link, np.int64), np.array(popped, np.int64)
        self.children = children
        keys = sorted((node << 8 | byte, child) for node, kids in enumerate(children) for byte, child in kids.items())
        self.edges = np.array([k for k, _ in keys], np.int64)
        self.to = np.array([c for _, c in keys], np.int64)

    def _child(self, nodes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        keys = nodes << 8 | byte
        at = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
        return np.where(self.edges[at] == keys, self.to[at], _NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of pieces of each word; -1 where the pieces cannot cover it."""
        if not len(self.edges):
            return np.full(len(words), -1, np.int64)
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        at = np.cumsum(size) - size
        end = at + size
        out = np.full(len(words), -1, np.int64)
        live = np.flatnonzero(size)
        node, total, place = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), at[live]
        last = end[live]
        while len(live) > FEW:
            reading = place < last
            step = np.full(len(live), _NONE)
            step[reading] = self._child(node[reading], data[place[reading]])
            grow = step != _NONE
            done = ~reading & (node == 1)
            out[live[done]] = total[done]
            total = np.where(grow, total, total + self.popped[node])
            node = np.where(grow, step, self.link[node])
            place = place + grow
            stay = ~done & (node != _NONE)
            live, node, total, place, last = live[stay], node[stay], total[stay], place[stay], last[stay]
        for i, *state in zip(live.tolist(), node.tolist(), total.tolist(), place.tolist(), last.tolist()):
            out[i] = self._finish(data, *state)
        return out

    def _finish(self, data: np.ndarray, node: int, total: int, place: int, last: int) -> int:
        """The rest of one word, a byte at a time: cheaper than arrays when few words are left."""
        word, at = data[place:last].tolist(), 0
        while True:
            step = self.children[node].get(word[at]) if at < len(word) else None
            if step is not None:
                node, at = step, at + 1
            elif at == len(word) and node == 1:
                return total
            else:
                total, node = total + int(self.popped[node]), int(self.link[node])
                if node == _NONE:
                    return -1


def word_piece_counts(documents: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_words, n_tokens (an unknown word is one token), n_unknown of every document."""
    def run(batches):
        automaton = LongestMatch(*pieces_of(model_file))

        def fill(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            return np.ones(len(words), np.int64), automaton.counts(words)

        known = SpanTable(fill, np.int64)
        for batch in slices(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            n_rows = batch.num_rows
            starts, ends, rows = word_spans(data, offsets)
            found = np.zeros(0, np.int64)
            if len(starts):
                at, _ = known.look_up(data, starts, ends)
                found = known.pool[at]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.bincount(rows, minlength=n_rows).astype(np.int64)),
                pa.array(per_row(rows, np.where(found < 0, 1, found), n_rows)),
                pa.array(per_row(rows, found < 0, n_rows))],
                names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    return with_bytes(documents).mapInArrow(run, SCHEMA)


