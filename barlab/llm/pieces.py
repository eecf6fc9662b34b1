"""Reading a SentencePiece model file: pieces, scores and normaliser settings, without the library."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# Place of the public model; a parameter everywhere, never copied into the repository.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class PieceModel:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model: int
    dummy_prefix: bool
    squeeze_spaces: bool
    escape_spaces: bool


def _fields(raw: bytes):
    """(number, value) of each field of a protocol buffer message; nested messages stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind)
            size = varint() if size is None else size
            yield tag >> 3, raw[at:at + size]
            at += size


def parse(raw: bytes) -> PieceModel:
    import struct

    pieces, scores, kinds, model, normal = [], [], [], UNIGRAM, {}
    for number, value in _fields(raw):
        if number == 1:
            one = dict(_fields(value))
            pieces.append(one.get(1, b"").decode("utf-8"))
            scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
            kinds.append(one.get(3, NORMAL))
        elif number == 2:
            model = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            normal = dict(_fields(value))
    if normal.get(2):
        raise ValueError("models with a table of character replacements are not supported")
    return PieceModel(tuple(pieces), tuple(scores), tuple(kinds), model, bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(normal.get(5, 1)))


def load(spark: SparkSession, path: str = PIECE_MODEL) -> PieceModel:
    """The model, read on the driver (half a megabyte) and handed to the tasks inside their functions."""
    if "://" in path and not path.startswith("file://"):
        return parse(bytes(spark.read.format("binaryFile").load(path).first()["content"]))
    with open(path.removeprefix("file://"), "rb") as f:
        return parse(f.read())
