"""Main text of HTML pages: a linear-chain conditional random field over DOM leaf blocks.

Each block is main text or not. Features are the tags and names above a block and the shape of its text;
neighbouring labels interact. Weights are fitted by stochastic gradient on the exact likelihood (forward and
backward sums) and pages are decoded by Viterbi.

The given pages carry no labels. Labelled pages are laid out from text blocks of a bounded sample of the given
pages: known layouts put these blocks into articles, menus, headers, sidebars, notices, adverts, forms,
comments and footers, in semantic elements or in plainly named boxes, so the label of each block is known.
"""
from __future__ import annotations

import html
import math
import random

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barlab.llm.common import need, parts
from barlab.llm.dom import ROOT, Block, Box, blocks

SAMPLE_PAGES = 200  # given pages whose blocks fill the layouts
LABELLED_PAGES = 700
EPOCHS = 6
RATE, DECAY = 0.5, 1e-4
MARK = "\ue000"  # private use; marks main text while labelled pages are laid out

# Names that boxes of either kind bear; parameters of the layouts.
ARTICLE = [("article", ""), ("main", ""), ("article", "post"), ("div", "article"), ("div", "content"), ("div", "post body"), ("section", "article body"),
           ("div", "entry content"), ("div", "main text"), ("div", "story"), ("main", "content"), ("div", "")]
OTHER = {"nav": [("nav", ""), ("div", "nav"), ("div", "menu"), ("ul", "menu"), ("div", "navbar"), ("div", "breadcrumbs"), ("nav", "main menu"), ("div", "navigation")],
         "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("div", "top bar"), ("div", "site header"), ("div", "banner")],
         "side": [("aside", ""), ("div", "sidebar"), ("div", "related"), ("div", "widget"), ("aside", "sidebar"), ("div", "recommended"), ("div", "share social"), ("section", "related posts")],
         "notice": [("div", "notice"), ("div", "cookie banner"), ("div", "consent"), ("div", "alert"), ("div", "popup modal"), ("div", "subscribe newsletter"), ("dialog", ""), ("div", "gdpr cookie notice")],
         "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("aside", "promo"), ("div", "ad slot"), ("ins", "adsbygoogle ad")],
         "form": [("form", ""), ("form", "search"), ("div", "form login"), ("form", "newsletter"), ("fieldset", "")],
         "comments": [("div", "comments"), ("section", "comments"), ("ol", "comment list"), ("div", "comment"), ("div", "replies"), ("div", "disqus thread"), ("section", "reader comments"), ("div", "discussion")],
         "footer": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("div", "site footer"), ("div", "bottom legal")]}


def features(found: list[Block]) -> list[list[str]]:
    """Feature names of each block."""
    return [[*box_features(b.box), *own] for b, own in zip(found, own_features(found))]


def own_features(found: list[Block]) -> list[list[str]]:
    """Features of a block's text and place."""
    out = []
    total = len(found)
    for i, b in enumerate(found):
        n = len(b.text)
        words = b.text.count(" ") + 1
        density = 4 * b.linked // max(1, n)
        own = ["bias", *nearest(b.box), f"len{min(8, int(math.log2(n)))}", f"words{min(6, int(math.log2(words)))}", f"link{min(4, density)}", f"end{b.text[-1] if not b.text[-1].isalnum() else 'w'}",
               f"stops{min(3, b.text.count('. ') + b.text.count(', '))}", f"at{'first' if i == 0 else 'last' if i == total - 1 else 4 * i // total}"]
        if "©" in b.text or "copyright" in b.text.lower():
            own.append("copyright")
        out.append(own)
    return out


def nearest(box: Box) -> tuple[str, str]:
    """The tag around a block, and the two innermost."""
    outer = box.around.tag if box.around is not None else ""
    return f"tag:{box.tag}", f"pair:{outer + '>' if outer else ''}{box.tag}"


def box_features(box: Box) -> list[str]:
    """Every mark of the elements around a block, once."""
    out: list[str] = []
    while box.around is not None:
        out += box.fresh
        box = box.around
    return out


def page_scores(chain: Chain, found: list[Block]) -> list[float]:
    """What chain.scores(features(found)) gives, with the sum over a box's marks taken once a box."""
    get = chain.weight.get
    summed: dict[int, float] = {id(ROOT): 0.0}

    def around(box: Box) -> float:
        open_: list[Box] = []
        while id(box) not in summed:
            open_.append(box)
            box = box.around
        total = summed[id(box)]
        for box in reversed(open_):
            total += sum(get(f, 0.0) for f in box.fresh)
            summed[id(box)] = total
        return total

    return [around(b.box) + own for b, own in zip(found, chain.scores(own_features(found)))]


class Chain:
    """Two labels (1: main text); a weight for each feature in favour of 1 and one for each pair of neighbours."""

    def __init__(self):
        self.weight: dict[str, float] = {}
        self.move = [[0.0, 0.0], [0.0, 0.0]]
        self.square: dict = {}

    def scores(self, rows: list) -> list[float]:
        get = self.weight.get
        return [sum(get(f, 0.0) for f in row) for row in rows]

    def _step(self, store, key, gradient: float) -> None:
        seen = self.square[store is self.move[0], store is self.move[1], key] = self.square.get((store is self.move[0], store is self.move[1], key), 1e-6) + gradient * gradient
        old = store.get(key, 0.0) if isinstance(store, dict) else store[key]
        store[key] = old + RATE / math.sqrt(seen + 1) * (gradient - DECAY * old)

    def learn(self, rows: list, labels: list[int]) -> float:
        """One gradient step on a page's log likelihood, which is returned."""
        u, t, n = self.scores(rows), self.move, len(rows)
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        ahead = [[0.0, u[0]]]
        for i in range(1, n):
            p = ahead[-1]
            ahead.append([add(p[0] + t[0][0], p[1] + t[1][0]), u[i] + add(p[0] + t[0][1], p[1] + t[1][1])])
        back = [[0.0, 0.0] for _ in range(n)]
        for i in range(n - 2, -1, -1):
            for y in (0, 1):
                back[i][y] = add(t[y][0] + back[i + 1][0], t[y][1] + u[i + 1] + back[i + 1][1])
        whole = add(*ahead[-1])
        like = sum(u[i] for i in range(n) if labels[i]) + sum(t[labels[i]][labels[i + 1]] for i in range(n - 1)) - whole
        moves = [[0.0, 0.0], [0.0, 0.0]]
        for i in range(n - 1):
            moves[labels[i]][labels[i + 1]] += 1
            for a in (0, 1):
                for b in (0, 1):
                    moves[a][b] -= math.exp(ahead[i][a] + t[a][b] + (u[i + 1] if b else 0.0) + back[i + 1][b] - whole)
        gradient: dict[str, float] = {}
        for i, row in enumerate(rows):
            d = labels[i] - math.exp(ahead[i][1] + back[i][1] - whole)
            for f in row:
                gradient[f] = gradient.get(f, 0.0) + d
        for f, g in gradient.items():
            self._step(self.weight, f, g)
        for a in (0, 1):
            for b in (0, 1):
                self._step(self.move[a], b, moves[a][b])
        return like

    def best(self, u: list[float]) -> list[int]:
        """Viterbi: the likeliest labels; ties go to main text."""
        if not u:
            return []
        t, trace = self.move, []
        off, on = 0.0, u[0]
        for x in u[1:]:
            a, b = off + t[0][0], on + t[1][0]
            c, d = off + t[0][1], on + t[1][1]
            trace.append((int(b > a), int(d >= c)))
            off, on = max(a, b), max(c, d) + x
        y = int(on >= off)
        out = [y]
        for step in reversed(trace):
            y = step[y]
            out.append(y)
        return out[::-1]


def _wrap(box: tuple[str, str], inner: str, rng: random.Random) -> str:
    tag, names = box
    how = rng.choice(("class", "class", "id"))
    name = f' {how}="{rng.choice(("-", " ", "_")).join(names.split())}"' if names else ""
    return f"<{tag}{name}>{inner}</{tag}>"


def layout(rng: random.Random, long: list[str], short: list[str]) -> str:
    """One labelled page; main text is marked by a private-use sign at its start."""
    say = lambda: html.escape(rng.choice(short))
    tell = lambda: html.escape(rng.choice(long))

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{say()}</a></li>' for i in range(n)) + "</ul>" if rng.random() < 0.7 else \
            " ".join(f'<a href="/{i}">{say()}</a>' for i in range(n))

    def other(kind: str) -> str:
        if kind in ("nav", "header"):
            inner = (f"<h1>{say()}</h1>" if kind == "header" and rng.random() < 0.5 else "") + links(rng.randint(2, 7))
        elif kind == "form":
            inner = f"<label>{say()}</label><input name=q><button>{say()}</button>" + (f"<p>{tell()}</p>" if rng.random() < 0.3 else "")
        elif kind == "comments":
            each = [_wrap(rng.choice([("div", "comment"), ("li", ""), ("p", ""), ("article", "comment")]), (f"<b>{say()}</b> " if rng.random() < 0.5 else "") + rng.choice((tell, say))(), rng)
                    for _ in range(rng.randint(1, 6))]
            inner = (f"<h3>{say()}</h3>" if rng.random() < 0.5 else "") + "".join(each)
        elif kind == "footer":
            inner = rng.choice(("&copy; ", "")) + say() + (f"<p>{tell()}</p>" if rng.random() < 0.4 else "") + (links(3) if rng.random() < 0.4 else "")
        elif kind == "side":
            inner = f"<h3>{say()}</h3>" + (links(rng.randint(2, 6)) if rng.random() < 0.6 else f"<p>{tell()}</p>")
        else:
            inner = rng.choice((say, tell))() if rng.random() < 0.6 else f"<p>{rng.choice((say, tell))()}</p>"
        return _wrap(rng.choice(OTHER[kind]), inner, rng)

    box = rng.choice(ARTICLE)
    parts = []
    if rng.random() < 0.85:
        parts.append(f"<h1>{MARK}{say()}</h1>")
    for _ in range(rng.randint(1, 14)):
        r = rng.random()
        text = MARK + rng.choice((tell, tell, say))()
        parts.append(f"<h2>{text}</h2>" if r < 0.08 else f"<blockquote>{text}</blockquote>" if r < 0.12 else f"<ul><li>{text}</li><li>{MARK}{say()}</li></ul>" if r < 0.17
                     else f"<p><b>{text}<br><p>{MARK}{tell()}</p>" if r < 0.25 else f'<p>{text} <a href="/x">{say()}</a> {say()}</p>' if r < 0.35
                     else f"<pre>{text}</pre>" if r < 0.38 else f"<table><tr><td>{text}</td><td>{MARK}{say()}</td></tr></table>" if r < 0.41 else f"<p>{text}</p>")
        if rng.random() < 0.06:
            parts.append(other(rng.choice(("ad", "side", "notice", "form"))))
    if rng.random() < 0.1:
        parts.append(other("comments"))
    body = _wrap(box, "".join(parts), rng)
    before = [other(k) for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.5]
    after = [other(k) for k in ("side", "ad", "comments", "form", "notice", "footer") if rng.random() < 0.5]
    rng.shuffle(before)
    page = "".join([*before, body, *after])
    if rng.random() < 0.4:
        page = _wrap(("div", rng.choice(("wrapper", "page", "container", "layout"))), page, rng)
    return f"<!DOCTYPE html><html><head><title>{say()}</title><style>p{{}}</style></head><body>{page}</body></html>"


def labelled(rng: random.Random, long: list[str], short: list[str]) -> tuple[list[Block], list[int]]:
    found = blocks(layout(rng, long, short))
    labels = [int(MARK in b.text) for b in found]
    for b in found:
        b.text = b.text.replace(MARK, "") or "."
    return found, labels


def fit(pages: DataFrame, n: int = LABELLED_PAGES, seed: int = 1) -> Chain:
    """The field's weights. Without any given text the layouts hold filler words."""
    given = need(pages, "html").where("html is not null")
    share = min(1.0, 3 * SAMPLE_PAGES / max(1, given.count()))  # so that no task sends many
    sample = given.where(F.pmod(F.xxhash64("html"), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)).orderBy(F.xxhash64("html", F.lit(1))).limit(SAMPLE_PAGES).collect()
    texts = sorted({b.text.replace(MARK, "") for r in sample for b in blocks(r["html"])} - {""})
    long = [t for t in texts if len(t) > 60][:2000] or ["Some words that make a sentence, and some more of them to go on."]
    short = [t for t in texts if len(t) <= 60][:2000] or ["Some words"]
    rng = random.Random(seed)
    short += [" ".join(rng.choice(long).split()[:rng.randint(1, 6)]) for _ in range(len(short))]
    pages_ = [labelled(rng, long, short) for _ in range(n)]
    rows = [(features(found), labels) for found, labels in pages_ if found]
    chain = Chain()
    for _ in range(EPOCHS):
        rng.shuffle(rows)
        for feats, labels in rows:
            chain.learn(feats, labels)
    return chain


def main_text(page: str, chain: Chain) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, chain.best(page_scores(chain, found))) if y)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (main text, blocks joined by line breaks; empty if none) and n_chars of every page.

    The whole html is read; null counts as empty. Repeated rows give repeated results; null ids and urls pass
    through.
    """
    chain = fit(pages)

    def run(batches):
        for batch in parts(batches, 2):
            texts = [main_text(h or "", chain) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return need(pages, "page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
