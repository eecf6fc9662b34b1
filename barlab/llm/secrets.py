"""Secrets in texts: fixed patterns, and formats learned by grammar inference.

Base spans of three kinds (assign, access, hex) are found by fixed patterns and always kept. Their
values are the labelled credentials from which one probabilistic automaton a kind is inferred; other long
tokens give the automaton of what is no secret. Every further candidate token is scored by how much
likelier a credential format makes it, and taken beyond a threshold calibrated on held-out tokens.
"""
from __future__ import annotations

import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from barlab.llm.automata import Automaton
from barlab.llm.boosting import calibrated
from barlab.llm.common import clear_of, hash_below, map_rows, need

KINDS = ("assign", "access", "hex")
# Bounds of the fitted sample: documents looked at (expected), strings of each class, symbols of a string.
TRAIN_DOCS = 30_000
TRAIN_STRINGS = 2_000
TRAIN_LENGTH = 64
PRECISION = 0.995

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]{12,}")
SYMBOLS = "dxlU+/_.=-"  # digit, letter a-f, other small letter, capital, signs
SHAPE = str.maketrans({**{c: "d" for c in "0123456789"}, **{c: "x" for c in "abcdef"}, **{c: "l" for c in "ghijklmnopqrstuvwxyz"},
                       **{c: "U" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}})


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind; code points, end exclusive."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def value(text: str, kind: str, s: int, e: int) -> str:
    return ASSIGN.match(text, s, e)[2] if kind == "assign" else text[s:e]


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Long tokens with a digit and a letter that touch no base span."""
    out = []
    for m in TOKEN.finditer(text):
        token = m[0].rstrip(".=-")
        if len(token) >= 12 and not token.isalpha() and any("0" <= c <= "9" for c in token) and any(c.isalpha() for c in token):
            out.append((m.start(), m.start() + len(token)))
    return clear_of(out, [(s, e) for _, s, e in taken])


class Formats:
    """An automaton for each kind of credential and one for other tokens."""

    def __init__(self, strings: dict[str, list[str]]):
        self.known: dict[str, Automaton] = {}
        for kind, values in strings.items():
            if values:
                a = Automaton(SYMBOLS)
                for v in values:
                    a.add(v.translate(SHAPE)[:TRAIN_LENGTH])
                self.known[kind] = a.merge()
        self.other = self.known.pop("", None)
        self.cut = math.inf

    def score(self, token: str) -> tuple[float, str]:
        """How much likelier, per symbol, the best format makes the token than no secret; the format's kind."""
        shape = token.translate(SHAPE)
        none = self.other.score(shape) if self.other else -math.log(len(SYMBOLS) + 1) * (len(shape) + 1)
        return max(((a.score(shape) - none) / (len(shape) + 1), k) for k, a in self.known.items())


def fit(docs: DataFrame) -> Formats | None:
    """Automata and threshold from a bounded sample; None if the sample holds no credential.

    About TRAIN_DOCS documents chosen by a hash of the text, of them at most 2 * TRAIN_STRINGS distinct
    strings of each class (smallest hashes); every third is held out for the threshold.
    """
    texts = need(docs, "text").where("text is not null")
    share = min(1.0, TRAIN_DOCS / max(1, texts.count()))
    picked = texts.where(hash_below("text", share))

    def step(batch):
        out = []
        for r in batch:
            t = r["text"]
            base = base_spans(t)
            out += [{"kind": k, "token": value(t, k, s, e)[:4 * TRAIN_LENGTH]} for k, s, e in base]
            out += [{"kind": "", "token": t[s:e][:4 * TRAIN_LENGTH]} for s, e in candidates(t, base)]
        return out

    seen = map_rows(picked, lambda: step, "kind string, token string").distinct().withColumn("h", F.xxhash64("token"))
    # Spark keeps only the first rows of each class on the map side
    order = F.row_number().over(Window.partitionBy("kind").orderBy("h", "token"))
    rows = seen.withColumn("place", order).where(F.col("place") <= 2 * TRAIN_STRINGS).orderBy("kind", "place").collect()
    train = {k: [r["token"] for r in rows if r["kind"] == k and r["h"] % 3 != 0][:TRAIN_STRINGS] for k in ("", *KINDS)}
    formats = Formats(train)
    if not formats.known:
        return None
    held = [r for r in rows if r["h"] % 3 == 0]
    scores = np.array([formats.score(r["token"])[0] for r in held])
    truth = np.array([r["kind"] != "" for r in held], float)
    if truth.sum() >= 10:
        formats.cut = max(0.0, calibrated(scores, truth, PRECISION, 10))
    return formats


def all_spans(text: str, formats: Formats | None) -> tuple[list, list]:
    base = base_spans(text)
    if formats is None:
        return base, base
    added = []
    for s, e in candidates(text, base):
        score, kind = formats.score(text[s:e])
        if score >= formats.cut:
            added.append((kind, s, e))
    return base, sorted([*base, *added], key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame) -> DataFrame:
    """Per document: n_assign, n_access, n_hex and base_sha256 of the base spans; all spans.

    A span covers the whole match. Null text counts as empty: no spans. Texts are taken whole, however long;
    repeated rows and ids give repeated results.
    """
    formats = fit(docs)

    def make():
        def step(batch):
            out = []
            for r in batch:
                base, every = all_spans(r["text"] or "", formats)
                out.append({"doc_id": r["doc_id"], **{f"n_{k}": sum(s[0] == k for s in base) for k in KINDS},
                            "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(every)})
            return out
        return step

    return map_rows(need(docs, "doc_id", "text"), make,
                    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
