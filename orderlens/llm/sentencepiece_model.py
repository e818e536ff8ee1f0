"""A SentencePiece model file: protobuf fields, normaliser, and what segmentation needs of them.

Field numbers are those of the public ``sentencepiece_model.proto``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from tokenizers import Regex, normalizers

# Fixed values of the format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"


@dataclass(frozen=True)
class Piece:
    text: str
    score: float
    kind: int

    @property
    def normal(self) -> bool:
        return self.kind == NORMAL

    @property
    def user_defined(self) -> bool:
        return self.kind == USER_DEFINED

    @property
    def matchable(self) -> bool:
        return self.kind in (NORMAL, USER_DEFINED)


@dataclass
class PieceModel:
    pieces: list[Piece] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_space: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @property
    def unknown_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p.kind == UNKNOWN)

    @property
    def splits_at_words(self) -> bool:
        """No piece goes on beyond a space mark that follows another character."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", p.text) for p in self.pieces if p.matchable)


def read_file(path: str) -> bytes:
    """The model file, read once on the driver; it is a few MB at most and travels as a broadcast value."""
    with open(path, "rb") as file:
        return file.read()


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(data, at)
        elif wire == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"not a model file: wire type {wire}")
        yield key >> 3, value


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for inner, part in _fields(value):
                if inner == 1:
                    text = part.decode()
                elif inner == 2:
                    score = struct.unpack("<f", part)[0]
                elif inner == 3:
                    kind = part
            model.pieces.append(Piece(text, score, kind))
        elif number == 2:
            found = dict(_fields(value))
            model.kind = found.get(3, UNIGRAM)
            model.suffix_space = bool(found.get(24, 0))
            model.byte_fallback = bool(found.get(35, 0))
        elif number == 3:
            found = dict(_fields(value))
            model.charsmap = found.get(2, b"")
            model.dummy_prefix = bool(found.get(3, 1))
            model.squeeze_spaces = bool(found.get(4, 1))
            model.escape_spaces = bool(found.get(5, 1))
    if not model.pieces:
        raise ValueError("not a model file: it has no pieces")
    if model.kind not in (UNIGRAM, BPE) or model.suffix_space or not model.escape_spaces:
        raise ValueError("only unigram and BPE models with leading space marks are supported")
    return model


def normalizer(model: PieceModel) -> normalizers.Normalizer:
    """The model's normaliser in terms of the tokenizers library."""
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    return normalizers.Sequence(steps)


def normaliser(model: PieceModel) -> Callable[[str], str]:
    """Text -> normalised text with space marks; the plain case avoids the library call."""
    if not model.charsmap and not model.squeeze_spaces:
        prefix = SPACE if model.dummy_prefix else ""
        return lambda text: prefix + text.replace(" ", SPACE) if text else ""
    steps = normalizer(model)
    return steps.normalize_str
