"""Personal data: high-recall candidate spans, boosted trees on format and context, calibrated thresholds.

Base spans of four kinds (email, ip, card, phone) are found by fixed patterns and always kept. Generators
propose further, overlapping spans; one tree model per kind, fitted on all documents, decides on them.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, functions as F

from barlab.llm.boosting import Boosted, binned, calibrated, fit_all, held_cells, quantile_cuts
from barlab.llm.common import clear_of, map_rows, need
from barlab.session import materialize

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.995  # on held-out candidates, for a span beyond the base ones

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A quad starts where a run of digits starts, so long runs are walked once.
QUAD = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MAYBE_MAIL = re.compile(r"(?<!\S)[^\s@]{1,64}(?:@| ?[\[(](?:at|AT)[\])] ?)[^\s@]{3,80}")
MAYBE_NUMBER = re.compile(r"(?<![0-9A-Za-z])[+(]?[0-9](?:[ ().\-/]{0,2}[0-9]){6,24}(?![0-9A-Za-z])")
HINTS = {w: i + 1 for i, group in enumerate((("mail", "email", "e-mail"), ("tel", "phone", "call", "mobile", "fax"),
                                             ("card", "visa", "credit"), ("ip", "host", "address", "addr")))
         for w in group}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses. Walks from one @ to the next, so a long run of letters is seen once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if (m := DOMAIN.match(text, at + 1)) and at > done:
            low = max(done, at - 256)
            while True:  # the whole run before the sign, however long
                part = text[low:at]
                run = len(part) - len(part.rstrip(LOCAL))
                if run < len(part) or low == done:
                    break
                low = max(done, at - 4 * (at - low))
            if run:
                out.append((at - run, m.end()))
                done = m.end()
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by kind, then start; code points, end exclusive."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in mails(text)]
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in QUAD.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that could be personal data in some format; they may overlap."""
    out = [(m.start(), m.end()) for m in MAYBE_NUMBER.finditer(text)]
    if "@" in text or "at" in text or "AT" in text:
        out += [(m.start(), m.end()) for m in MAYBE_MAIL.finditer(text)]
    return out


def features(text: str, s: int, e: int) -> list[float]:
    """Format of the span and what stands around it."""
    span = text[s:e]
    digits = "".join(c for c in span if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", span) or [""]
    sizes = [len(g) for g in groups]
    before = re.findall(r"[A-Za-z-]+", text[max(0, s - 24):s].lower())
    left, right = text[s - 1:s], text[e:e + 1]
    where = lambda c: 0 if not c or c.isspace() else 1 if c.isalnum() else 2
    domain = span.rpartition("@")[2] if "@" in span else ""
    return [len(span), len(digits), sum(c.isalpha() for c in span), len(groups), max(sizes), min(sizes), span[:1] == "+",
            "(" in span, span.count("."), span.count("-"), span.count(" "), span.count("/"),
            float(bool(digits) and luhn(digits)), float(all(len(g) <= 3 and int(g or 0) <= 255 for g in groups)), where(left), where(right),
            span.count("@"), domain.count("."), len(domain.rpartition(".")[2]), max((HINTS.get(w, 0) for w in before[-3:]), default=0)]


WIDTH = len(features("x 1", 2, 3))


def variants(kind: str, span: str) -> list[tuple[str, int]]:
    """Other spellings of a base span, and look-alikes that are none: (text, 1 or 0)."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "phone":
        return [(span[1:], 1), ("00" + digits, 1), (".".join(re.findall(r"[0-9]+", span)), 1), (digits[:8], 0), (f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}", 0)]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        quads = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [(".".join(quads), 1), ("/".join(quads), 1), (wrong, 0), (".".join([*quads[:-1], wrong[-(len(digits) - 1) % 4 - 1:]]), 0)]
    if kind == "ip":
        return [(".".join(str(int(g) + 300) for g in span.split(".")), 0), (span + ".7", 0)]
    return [(span.replace("@", " [at] "), 1), (span.replace("@", "(at)"), 1), (span.partition("@")[0] + "@" + "x", 0)]


def labelled(text: str) -> list[dict]:
    """Training rows of a text: each candidate with its kind by the fixed patterns, and its variants."""
    known = {(s, e): k for k, s, e in base_spans(text)}
    rows = [{"kind": known.get(c, ""), "x": [float(v) for v in features(text, *c)]} for c in set(candidates(text)) | set(known)]
    for (s, e), kind in known.items():
        for other, good in variants(kind, text[s:e]):
            framed = text[max(0, s - 24):s] + other + text[e:e + 1]
            at = s - max(0, s - 24)
            rows.append({"kind": kind if good else "", "x": [float(v) for v in features(framed, at, at + len(other))]})
    return rows


def fit(docs: DataFrame) -> dict[str, tuple[Boosted, float]]:
    """A tree model and its threshold per kind; a kind without enough labelled spans gets none.

    Every document counts: bins, trees and thresholds come from all distinct candidate rows, a third of them,
    by hash, held out for the threshold. Nulls are left out; an empty table gives no model.
    """
    texts = need(docs, "text").where("text is not null")
    rows = map_rows(texts, lambda: lambda batch: [r for d in batch for r in labelled(d["text"])], "kind string, x array<double>")
    rows = materialize(rows.distinct().withColumn("held", F.xxhash64("kind", "x") % 3 == 0), "labelled")
    train, held = rows.where("not held"), rows.where("held")
    count = lambda k: F.struct(*[F.count_if((F.col("kind") == k) & w).alias(n) for n, w in (("train", ~F.col("held")), ("held", F.col("held")))]).alias(k)
    found = rows.agg(F.count(F.lit(1)).alias("n"), *[count(k) for k in KINDS]).first()
    labels = [i for i, k in enumerate(KINDS) if found[k]["train"] >= 20 and found[k]["held"] >= 10 and sum(found[k]) < found["n"]]
    if not labels:
        return {}
    cuts = quantile_cuts(train, WIDTH)
    models = fit_all(materialize(binned(train, cuts, list(KINDS)), "binned"), cuts, labels)
    cells = held_cells(held.withColumn("k", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1), models)
    return {KINDS[i]: (m, max(0.5, calibrated(*cells[i][:2], PRECISION, 10, cells[i][2]))) for i, m in models.items()}


def all_spans(texts: list[str], models: dict) -> list[tuple[list, list]]:
    """For each text its base spans and, by kind and start, all spans."""
    found = [base_spans(t) for t in texts]
    extra: list[tuple[int, int, int]] = []
    for i, (t, base) in enumerate(zip(texts, found)):
        extra += [(i, s, e) for s, e in clear_of(list(dict.fromkeys(candidates(t))), [(s, e) for _, s, e in base])]
    added: dict[int, list] = {}
    ends: dict[int, list] = {}  # of a text, the starts and ends of the spans added, in order
    if extra and models:
        x = np.array([features(texts[i], s, e) for i, s, e in extra], float)
        scores = {k: np.where((p := m.predict(x)) >= cut, p, -1.0) for k, (m, cut) in models.items()}
        kinds = list(scores)
        table = np.stack([scores[k] for k in kinds])
        best = table.argmax(0)
        for j in np.argsort(-table.max(0), kind="stable"):
            if table[best[j], j] < 0:
                break
            i, s, e = extra[j]
            line = ends.setdefault(i, [])
            at = bisect_right(line, s)
            if at % 2 == 0 and (at == len(line) or line[at] >= e):  # of overlapping ones the best stays
                line[at:at] = (s, e)
                added.setdefault(i, []).append((kinds[best[j]], s, e))
    order = {k: n for n, k in enumerate(KINDS)}
    return [(b, sorted([*b, *added.get(i, [])], key=lambda x: (order[x[0]], x[1], x[2]))) for i, b in enumerate(found)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame) -> DataFrame:
    """Per document: n_email, n_ip, n_card, n_phone and base_sha256 of the base spans; all spans.

    Null text counts as empty: no spans. Repeated rows and ids give repeated results. Texts are
    taken whole, however long.
    """
    models = fit(docs)

    def make():
        def step(batch):
            spans = all_spans([r["text"] or "" for r in batch], models)
            return [{"doc_id": r["doc_id"], **{f"n_{k}": sum(s[0] == k for s in base) for k in KINDS},
                     "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(every)}
                    for r, (base, every) in zip(batch, spans)]
        return step

    return map_rows(need(docs, "doc_id", "text"), make, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named by the first."""
    out, done = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], x[2])):
        if s >= done:
            out += [text[done:s], f"[{kind.upper()}]"]
        done = max(done, e)
    return "".join(out) + text[done:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their spans replaced; all rows and columns stay, null text stays null."""
    models = fit(docs)

    def make():
        def step(batch):
            spans = all_spans([r["text"] or "" for r in batch], models)
            return [{**r, "text": r["text"] if r["text"] is None else redacted(r["text"], every)} for r, (_, every) in zip(batch, spans)]
        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return map_rows(docs, make, schema)
