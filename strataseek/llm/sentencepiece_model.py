"""The model file of SentencePiece, read without its library (a protobuf message).

Only the fields that decide about encoding and decoding are kept. ``rebuild`` makes the same
tokenizer with the tokenizers library: normaliser, marker for spaces, merges or unigram scores,
bytes for unknown characters, and the decoder.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

# Fixed values of the public model format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
UNIGRAM, MERGES = 1, 2


def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(raw: bytes):
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        number, kind = key >> 3, key & 7
        if kind == 0:
            value, at = _varint(raw, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = raw[at:at + size], at + size
        elif kind == 2:
            size, at = _varint(raw, at)
            value, at = raw[at:at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield number, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    suffix_mark: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, raw: bytes) -> "Model":
        model = cls()
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
                model.unk_id = trainer.get(40, 0)
                model.suffix_mark = bool(trainer.get(24, 0))
            elif number == 3:
                rules = dict(_fields(value))
                model.charsmap = rules.get(2, b"")
                model.dummy_prefix = bool(rules.get(3, 1))
                model.trim_spaces = bool(rules.get(4, 1))
                model.escape_spaces = bool(rules.get(5, 1))
        if model.suffix_mark:
            raise ValueError("models with the marker after the word are not supported")
        return model

    def vocabulary(self) -> dict[str, int]:
        return {piece: i for i, (piece, _, _) in enumerate(self.pieces)}

    def merges(self) -> list[tuple[str, str]]:
        """Pairs whose union is a piece, best score first.

        Runs of the marker all have one score; the library then joins the leftmost pair, which
        grows one run at a time. The same comes out if longer runs go first and only runs that
        such growth meets are joined: one marker at the right, or the two halves of a power of two's gap.
        """
        joined = {p for p, _, kind in self.pieces if kind in (NORMAL, USER, UNUSED)}
        ranked = []
        for rank, (piece, score, kind) in enumerate(self.pieces):
            if kind not in (NORMAL, USER) or len(piece) < 2:
                continue
            run = set(piece) == {MARK}
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in joined and right in joined:
                    if run and len(right) > 1 and MARK * (len(piece) - 1) in joined:
                        continue
                    ranked.append((-score, -len(piece) if run else rank, cut, left, right))
        return [(left, right) for *_, left, right in sorted(ranked)]

    def inner_pairs(self):
        """(byte, byte) table: true where two neighbouring bytes occur within some piece."""
        import numpy as np

        table = np.zeros((256, 256), bool)
        for piece, _, kind in self.pieces:
            if kind in (NORMAL, USER, UNUSED):
                raw = np.frombuffer(piece.replace(MARK, " ").encode(), np.uint8)
                table[raw[:-1], raw[1:]] = True
        table[:, 0x80:0xC0] = True  # never inside a character
        return table


def rebuild(model: Model, whole_text: bool = True):
    """A ``tokenizers.Tokenizer``; with ``whole_text`` false it takes normalised pieces of a text."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    unknown = model.pieces[model.unk_id][0]
    if model.kind == MERGES:
        inner = models.BPE(vocab=model.vocabulary(), merges=model.merges(), unk_token=unknown,
                           fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        inner = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is not supported")
    tokenizer = Tokenizer(inner)
    if whole_text:
        steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
        if model.trim_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        if model.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        if model.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        + ([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []))
    return tokenizer
