"""Leaf blocks of an HTML page: text between block-level tags, with the tags above it."""
from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Fixed values of the HTML standard: elements without content, raw text, and block-level boxes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section
select summary table tbody td tfoot th thead title tr ul textarea""".split())
# An opening tag of the left closes an open element of the right, within the nearest box.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCK - {"button", "body", "html", "head", "title", "option", "textarea"}
STOPS = frozenset("table ul ol dl select article section div main aside nav body html td th form".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)|<[!?/][^>]*>", re.S)
STOP = re.compile("""[>"']""")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass(slots=True, eq=False)
class Box:
    """An open element: its tag and the words of its class, id and role, and the element around it.

    Blocks share their boxes, so however deep a page is, a box costs what it adds. `fresh` are the marks
    (in:tag, name:word) that no element around it has.
    """
    around: Box | None
    tag: str
    full: str
    fresh: tuple[str, ...]


ROOT = Box(None, "", "", ())


@dataclass(slots=True)
class Block:
    box: Box  # the innermost open element
    text: str
    linked: int  # characters inside links
    index: int = 0

    @property
    def path(self) -> tuple[str, ...]:
        """Open elements, outermost first: tag, then words of class, id and role."""
        out, box = [], self.box
        while box.around is not None:
            out.append(box.full)
            box = box.around
        return tuple(reversed(out))


class Stack:
    """The open elements of a page, with how often each mark is open."""

    def __init__(self):
        self.boxes: list[Box] = [ROOT]
        self.open: dict[str, int] = {}

    def push(self, tag: str, full: str) -> None:
        marks = {f"in:{tag}": None} | {f"name:{w}": None for w in full.split()[1:]}
        self.boxes.append(Box(self.boxes[-1], tag, full, tuple(m for m in marks if not self.open.get(m))))
        for m in marks:
            self.open[m] = self.open.get(m, 0) + 1

    def holds(self, tag: str) -> bool:
        return bool(self.open.get(f"in:{tag}"))

    def pop(self) -> str:
        box = self.boxes.pop()
        for m in {f"in:{box.tag}", *[f"name:{w}" for w in box.full.split()[1:]]}:
            self.open[m] -= 1
        return box.tag

    def close(self, tag: str) -> None:
        """Close the innermost element of a tag and all inside it."""
        if self.holds(tag):
            while self.pop() != tag:
                pass

    def close_in(self, tags: set[str]) -> None:
        """Close the innermost of the tags unless a box stands in between."""
        if any(map(self.holds, tags)):
            for box in reversed(self.boxes):
                if box.tag in tags:
                    self.close(box.tag)
                    return
                if box.tag in STOPS:
                    return


def label(tag: str, attributes: str) -> str:
    """A tag with the words of its class, id and role."""
    if "=" not in attributes:
        return tag
    named = " ".join(a or b or c for _, a, b, c in NAMED.findall(attributes)).lower()
    return f"{tag} {' '.join(WORD.findall(named))}" if named else tag


def blocks(page: str) -> list[Block]:
    """The leaf blocks in page order; empty ones are left out.

    Comments, scripts and styles give nothing. References are decoded and white space inside a block is one
    space; a line break inside a block is white space too. Unclosed elements are closed by their box.
    """
    out: list[Block] = []
    stack = Stack()
    parts: list[str] = []
    linked = 0
    inside: Box | None = None

    def flush():
        nonlocal parts, linked, inside
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(inside or ROOT, text, linked, len(out)))
            parts, linked = [], 0
        inside = None

    def say(piece: str):
        nonlocal linked, inside
        if not piece:
            return
        if inside is None:
            if not piece.strip():
                if parts:
                    parts.append(" ")
                return
            inside = stack.boxes[-1]
        parts.append(piece)
        if any(box.tag == "a" for box in stack.boxes[-4:]):
            linked += len(piece.strip())

    at, size = 0, len(page)
    last = page.rfind(">")
    open_ended: set[int] = set()
    while at < size:
        m = TAG.search(page, at)
        while m is not None and m[2] and m.end() > last:  # no tag, as nothing ends it
            m = TAG.search(page, m.start() + 1)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        end = tag_end(page, at, open_ended)
        attributes, at = page[at:end], end + 1
        if m[1]:
            if tag in BLOCK:
                flush()
            stack.close(tag)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in RAW:
            end = raw_end(page, tag, at)
            if tag == "title":
                flush()
            at = size if end < 0 else end
            if end >= 0:
                close = page.find(">", end)
                at = size if close < 0 else close + 1
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                stack.close_in({"p"})
            if tag in CLOSES:
                stack.close_in(CLOSES[tag])
        if tag not in VOID and not attributes.endswith("/"):
            stack.push(tag, label(tag, attributes))
    flush()
    return out


def tag_end(page: str, at: int, open_ended: set[int]) -> int:
    """Position of the '>' that ends the tag whose attributes start at `at`, quoted values of any length passed
    over; if a quote is never closed, of the next '>'. There is one. open_ended: places met on such ways of the
    page, so that none is walked twice."""
    met, i = [], at
    while (m := STOP.search(page, i)) and m.start() not in open_ended:
        if m[0] == ">":
            return m.start()
        met.append(m.start())
        close = page.find(m[0], m.end())
        if close < 0:
            break
        i = close + 1
    open_ended.update(met)
    return page.find(">", at)


END = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}


def raw_end(page: str, tag: str, at: int) -> int:
    m = END[tag].search(page, at)
    return m.start() if m else -1
