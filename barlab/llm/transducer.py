"""SentencePiece encoding and decoding as a weighted finite-state transducer.

normaliser o pieces o byte fallback: white space becomes a sign of its own (with one in front), arcs consume the
characters of a piece and emit its id, and a character outside all pieces has an arc that emits its UTF-8
bytes. The input is composed with the machine position by position, and the tropical semiring (minimum,
plus) keeps the best path. Weights:

* unigram models: minus the score of the piece; an arc state remembers nothing.
* merge (BPE) models: the state is the last piece. An arc from piece a to piece b weighs 0 if merging would
  leave the border between them standing, and infinity otherwise. Exactly one path of every input has a
  finite weight, and it is the one the merges give: a border stands if no piece over it could have formed
  before the pieces on either side were finished. The best state of each prefix is then unique.

No piece of such models goes on after a word's last letter into white space, so the composition falls apart
at word starts, and the best path of each word may be kept and used again.
"""
from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barlab.llm.common import lean, need, parts
from barlab.llm.pieces import BPE, BYTE, NORMAL, SPACE, USER, PieceModel

# What a worker keeps lies in two generations: when the young one is full it becomes the old one, and what is
# asked for again comes back from there, so frequent words and pairs stay.
KEPT_BYTES = 70_000_000  # of best paths in a generation
ENTRY = 150  # bytes of a kept path beside its word and ids: two objects and their place
KEPT_PAIRS = 350_000  # pairs of pieces in a generation, about 100 bytes each
SHORT = 40  # longer words are not kept
UNKNOWN_COST = 10.0  # unigram models: below the worst score by this


class Transducer:
    def __init__(self, model: PieceModel):
        self.model = model
        real = [i for i, k in enumerate(model.kinds) if k in (NORMAL, USER) and model.pieces[i]]
        self.id = {model.pieces[i]: i for i in real}
        self.byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == BYTE}
        self.unknown = model.kinds.index(2) if 2 in model.kinds else 0
        # id of a piece, -1 for what only ends one
        self.arcs = dict.fromkeys((p[i:] for p in self.id for i in range(1, len(p))), -1) | self.id
        self.size = len(model.pieces)
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.unit = re.compile(".+" if crossing else f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
        self.merges = model.model == BPE
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.held = 0
        self.pairs: dict[int, bool] = {}
        self.old_pairs: dict[int, bool] = {}
        self.spines: dict[str, tuple[list, list]] = {}
        self.floor = min((model.scores[i] for i in real), default=0.0) - UNKNOWN_COST
        self.text_of = [self._emit(i) for i in range(len(model.pieces))]

    # -- weights of a merge model -------------------------------------------------------------

    def _spine(self, piece: str) -> tuple[list, list]:
        """How merging builds a piece: its left and right edges over time, as (part, score when formed)."""
        got = self.spines.get(piece)
        if got is not None:
            return got
        parts = [(c, float("inf")) for c in piece]
        left, right = [parts[0]], [parts[-1]]
        score = self.model.scores
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                k = self.id.get(parts[i][0] + parts[i + 1][0])
                if k is not None and (best is None or score[k] > best[0]):
                    best = (score[k], i)
            if best is None:  # merging never reaches this piece
                left = right = []
                break
            s, i = best
            parts[i:i + 2] = [(parts[i][0] + parts[i + 1][0], s)]
            if i == 0:
                left.append(parts[0])
            if i == len(parts) - 1:
                right.append(parts[-1])
        self.spines[piece] = left, right
        return left, right

    def _stands(self, a: str, b: str) -> bool:
        """Whether the border between pieces a and b survives merging."""
        right, left = self._spine(a)[1], self._spine(b)[0]
        for i, (x, _) in enumerate(right):
            grows = right[i + 1][1] if i + 1 < len(right) else -np.inf
            for j, (y, _) in enumerate(left):
                k = self.id.get(x + y)
                if k is None:
                    continue
                s = self.model.scores[k]
                after = left[j + 1][1] if j + 1 < len(left) else -np.inf
                # ties go to the leftmost pair: a's own merge comes first, b's own one later
                if s > grows and s >= after:
                    return False
        return True

    def _arc(self, before: int, k: int) -> bool:
        """Whether the arc from piece `before` (-1: none) to piece k weighs 0; remembered in pairs."""
        key = before * self.size + k
        ok = self.old_pairs.get(key)
        if ok is None:
            piece = self.model.pieces[k]
            ok = bool(self._spine(piece)[0]) and (before < 0 or self._stands(self.model.pieces[before], piece))
        if len(self.pairs) >= KEPT_PAIRS:
            self.old_pairs = dict(self.pairs)
            self.pairs.clear()  # the same object: _merged holds its lookup
        self.pairs[key] = ok
        return ok

    # -- composition and shortest path --------------------------------------------------------

    def _merged(self, word: str) -> list[int]:
        """Where the pieces of the one path of finite weight end, backwards from the end of the word."""
        look, pairs, size = self.arcs.get, self.pairs.get, self.size
        state, begin = [-1], [0]
        for end in range(1, len(word) + 1):
            for start in range(end - 1, -1, -1):
                k = look(word[start:end])
                if k is None:  # ends no piece, and so does whatever is longer
                    start = -1
                    break
                if k >= 0:
                    before = state[start]
                    ok = pairs(before * size + k)
                    if ok or (ok is None and self._arc(before, k)):
                        state.append(k)
                        begin.append(start)
                        break
            else:
                start = -1
            if start < 0:  # a character of its own; no merge crosses it
                state.append(-1)
                begin.append(end - 1)
        return begin

    def _cheapest(self, word: str) -> list[int]:
        """The same for a unigram model, by the sums of the weights."""
        weight, begin = [0.0], [0]
        for end in range(1, len(word) + 1):
            best, at = weight[end - 1] - self.floor, end - 1
            for start in range(end - 1, -1, -1):
                k = self.arcs.get(word[start:end])
                if k is None:
                    break
                if k >= 0 and (w := weight[start] - self.model.scores[k]) < best:
                    best, at = w, start
            weight.append(best)
            begin.append(at)
        return begin

    def path(self, word: str) -> list[str]:
        """The pieces along the best path of a word."""
        begin = self._merged(word) if self.merges else self._cheapest(word)
        out, end = [], len(word)
        while end:
            out.append(word[begin[end]:end])
            end = begin[end]
        return out[::-1]

    def _ids(self, piece: str) -> list[int]:
        k = self.id.get(piece)
        if k is not None:
            return [k]
        raw = piece.encode("utf-8", "surrogatepass")
        return [self.byte.get(b, self.unknown) for b in raw] if self.byte else [self.unknown]

    def normalise(self, text: str) -> str:
        m = self.model
        if m.squeeze_spaces:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        text = (" " if m.dummy_prefix else "") + text
        return text.replace(" ", SPACE) if m.escape_spaces else text

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a text, int32."""
        words, found = self.words, []
        for unit in self.unit.findall(self.normalise(text)):
            got = words.get(unit)
            if got is None:
                got = self.old_words.get(unit)
                if got is None:
                    got = array("i", [k for p in self.path(unit) for k in self._ids(p)]).tobytes()
                if len(unit) <= SHORT:
                    self.held += ENTRY + 2 * len(unit) + len(got)
                    if self.held > KEPT_BYTES:
                        self.old_words, self.held = words, 0
                        self.words = words = {}
                    words[unit] = got
            found.append(got)
        return np.frombuffer(b"".join(found), np.int32)

    def forget(self) -> None:
        """Drop the kept paths."""
        self.words, self.old_words, self.held = {}, {}, 0

    # -- the machine read backwards -----------------------------------------------------------

    def _emit(self, i: int) -> bytes:
        kind, piece = self.model.kinds[i], self.model.pieces[i]
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == 3:
            return b""
        if kind == 2:
            return " ⁇ ".encode()
        return piece.replace(SPACE, " ").encode("utf-8", "surrogatepass")

    def decode(self, ids) -> str:
        """The text of a list of ids; bytes that form no UTF-8 become the replacement sign."""
        raw = b"".join(map(self.text_of.__getitem__, ids))
        if self.model.dummy_prefix and raw[:1] == b" " and len(ids) and self.model.kinds[ids[0]] == NORMAL:
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def machine_of(model: PieceModel) -> Transducer:
    """One machine a worker process."""
    return Transducer(model)


OUTPUT = "doc_id bigint, n_tokens bigint, n_bytes bigint, ids array<int>, text_sha256 string, round_trip boolean"


def encode(docs: DataFrame, model: PieceModel) -> DataFrame:
    """Every document's ids with what decoding them gives.

    n_tokens: number of ids; n_bytes: how many of them stand for single bytes; text_sha256: of the decoded
    text; round_trip: decoding gives the text back (not so where a text holds the white-space sign U+2581
    itself, which decodes to a space). Null counts as empty: no ids. Texts are taken whole; repeated rows and
    ids give repeated results.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("text_sha256", pa.string()), ("round_trip", pa.bool_())])

    def run(batches):
        machine = machine_of(model)
        is_byte = np.array([k == BYTE for k in model.kinds])
        for batch in parts(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [machine.encode(t) for t in texts]
            back = [machine.decode(i.tolist()) for i in ids]
            flat = np.concatenate(ids)
            offsets = np.fromiter(accumulate(map(len, ids), initial=0), np.int32, len(ids) + 1)
            marked = np.concatenate([[0], np.cumsum(is_byte[flat])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(np.diff(marked[offsets]), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                pa.array([hashlib.sha256(b.encode("utf-8", "surrogatepass")).hexdigest() for b in back]),
                pa.array([b == t for b, t in zip(back, texts)])], schema=schema)

    return need(docs, "doc_id", "text").mapInArrow(lean(run), OUTPUT)
