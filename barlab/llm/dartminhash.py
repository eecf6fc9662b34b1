"""DartMinHash signatures of weighted word-shingle sets, for whole batches of texts in numpy.

An element of weight w is a region of width w. Darts fall on it as a Poisson process over (width, rank): every
unit cell of an element has its own sequence of arrivals, drawn from a hash of element and cell, so equal
cells of different texts are hit by equal darts. Each dart belongs to one of the coordinates, and the earliest
per coordinate is the signature; two signatures agree in a coordinate with the weighted Jaccard similarity of
their sets. Only darts up to a rank are thrown, chosen by the total weight so that their number is about the
same for every text: coordinates * (ln coordinates + 2). A text that leaves a coordinate empty throws on.
Weights here are the counts of shingles, so cells are whole.
"""
from __future__ import annotations

import numpy as np

SHINGLE = 5
BANDS, ROWS = 32, 6
COORDINATES = BANDS * ROWS

_IS_WORD = np.ones(256, bool)  # of lower-cased UTF-8
_IS_WORD[:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of lower-cased texts, and which text each belongs to."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = _IS_WORD[data]
    change = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0))
    starts, ends = change[::2], change[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = ends - starts
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    place = np.arange(size.sum()) - np.repeat(first, size)
    powers = np.cumprod(np.full(int(size.max()), _ODD))
    value = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    h = mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _GOLD)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    return h, np.searchsorted(ends_of_text, starts, side="right")


def cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every unit cell of every shingle of every text, and the text's number.

    A text of fewer words than a shingle, but not none, is one shingle.
    """
    h, doc = word_hashes(texts)
    if not len(h):
        return h, doc
    n_words = np.bincount(doc, minlength=len(texts))
    start_of = np.concatenate([[0], np.cumsum(n_words)])
    size = np.minimum(SHINGLE, n_words)[doc]
    at = np.arange(len(h))
    keep = at + size <= start_of[doc + 1]
    at, doc, size = at[keep], doc[keep], size[keep]
    s = np.zeros(len(at), np.uint64)
    for i in range(SHINGLE):
        part = h[np.minimum(at + i, len(h) - 1)] * _ODD + np.uint64(i + 1)
        s = np.where(i < size, mix(s * _GOLD + part), s)
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    same = np.concatenate([[False], (s[1:] == s[:-1]) & (doc[1:] == doc[:-1])])
    run = np.arange(len(s)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(s))))
    return mix(s + run.astype(np.uint64) * _GOLD), doc


def signatures(texts: list[bytes], k: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """Signature of each text (one row each) and its total weight; a text without words has weight 0."""
    cell, doc = cells(texts)
    weight = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    out = np.zeros((len(texts), k), np.uint64)
    reach = k * (np.log(k) + 2) / np.maximum(weight, 1)
    todo = np.flatnonzero(weight)
    while len(todo):
        number = np.full(len(texts), -1)
        number[todo] = np.arange(len(todo))
        mine = number[doc] >= 0
        x, owner, limit = cell[mine], number[doc[mine]], reach[doc[mine]]
        rank = np.zeros(len(x))
        darts_at, darts_rank, darts_id = [], [], []
        while len(x):
            x = mix(x + _GOLD)
            rank = rank - np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
            hit = rank <= limit
            x, owner, limit, rank = x[hit], owner[hit], limit[hit], rank[hit]
            darts_at.append(owner * k + (mix(x ^ _ODD) % np.uint64(k)).astype(np.int64))
            darts_rank.append(rank)
            darts_id.append(x)
        at, rank, x = map(np.concatenate, (darts_at, darts_rank, darts_id))
        first = np.full(len(todo) * k, np.inf)
        np.minimum.at(first, at, rank)
        won = rank == first[at]
        got = np.zeros(len(todo) * k, np.uint64)
        got[at[won]] = x[won]
        full = np.isfinite(first).reshape(len(todo), k).all(1)
        out[todo[full]] = got.reshape(len(todo), k)[full]
        todo = todo[~full]
        reach[todo] *= 2
    return out, weight


def bands(signature: np.ndarray) -> np.ndarray:
    """One hash per band of each signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        h = mix(h * _GOLD + parts[:, :, r])
    return h


def sketch(signature: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen coordinates to a 64-bit number."""
    lanes = (mix(signature ^ _GOLD) >> np.uint64(60)).reshape(len(signature), -1, 16)
    return np.bitwise_or.reduce(lanes << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=2)
