import itertools
import math
import random
import re
import time
from html import unescape

import pytest
from conftest import prose

from barlab.llm import extract
from barlab.llm.dom import blocks

LONG = [prose(i, 30) for i in range(200)]
SHORT = [prose(i, 4) for i in range(200)]


@pytest.fixture(scope="module")
def chain(spark, tables):
    return extract.fit(spark.read.parquet(f"{tables}/pages.parquet"))


def test_blocks_of_broken_markup():
    page = """<html><head><title>T</title><script>var x="</p><p>no";</script></head><body><!-- <p>no</p> --><nav><a href='a>b'>Home</a></nav>
    <div>one &amp; <b>two<br>three</b>&nbsp;&#233;<p>four<ul><li>five<li>six</ul>tail<style>p{}</style></div><p>unclosed <i>it"""
    assert [b.text for b in blocks(page)] == ["Home", "one & two three é", "four", "five", "six", "tail", "unclosed it"]
    assert blocks(page)[0].linked == 4 and blocks(page)[0].path[-2:] == ("nav", "a")
    for odd in ("", "<", "<!--", "<script>", "a<b", "</p>", "<p", '<a href="' + "x" * 10_000, "plain", "<" * 5000):
        blocks(odd)


def test_long_attribute_values_are_read_whole():
    for quote in "\"'":
        for n in (100, 5000, 300_000):
            found = blocks(f"<div class=sidebar data-x={quote}a>b {'y' * n}{quote}>text</div><p id=m data-y={quote}{'>' * n}{quote} role=main>more")
            assert [(b.text, b.path) for b in found] == [("text", ("div sidebar",)), ("more", ("p m main",))]
    assert [(b.text, b.path) for b in blocks('<div class="menu" title=\'x>text')] == [("text", ("div menu",))]
    assert blocks("<p>" + "<a x='\">" * 40_000 + "t")[-1].text.endswith("t")


def test_viterbi_and_likelihood_against_all_labellings():
    c = extract.Chain()
    c.move = [[0.3, -0.4], [-0.2, 0.5]]
    u = [0.7, -1.1, 0.2, -0.3, 0.9]
    c.weight = {str(i): x for i, x in enumerate(u)}
    score = lambda y: sum(x for x, k in zip(u, y) if k) + sum(c.move[a][b] for a, b in zip(y, y[1:]))
    every = list(itertools.product((0, 1), repeat=5))
    assert score(c.best(u)) == max(map(score, every))
    want = score([1, 1, 0, 0, 1]) - math.log(sum(math.exp(score(y)) for y in every))
    assert math.isclose(c.learn([[str(i)] for i in range(5)], [1, 1, 0, 0, 1]), want, rel_tol=1e-9)
    assert c.best([]) == []


def test_held_out_pages(chain):
    rng = random.Random(99)
    right = total = 0
    for _ in range(200):
        found, labels = extract.labelled(rng, LONG, SHORT)
        got = chain.best(chain.scores(extract.features(found)))
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total > 0.97


def test_given_pages(spark, tables, chain):
    for r in spark.read.parquet(f"{tables}/pages.parquet").collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S)[1]
        want = [" ".join(unescape(x).split()) for x in re.split("</?(?:p|h1|b)>|<br>", inner)]
        assert extract.main_text(r.html, chain) == "\n".join(x for x in want if x)


def test_awkward_rows(spark):
    long = "<article>" + "".join(f"<p>{t}</p>" for t in LONG * 20) + "</article>"
    rows = [(1, "u", None, 0), (2, None, "", 0), (None, "u", "<nav>Menu</nav>", 0), (4, "u", long, 0), (4, "u", long, 0), (5, "u", "no markup, only words. And more of them.", 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = extract.extract(df).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert {r.text for r in got if r.page_id == 4} == {"\n".join(LONG * 20)}
    assert extract.extract(df.limit(0)).count() == 0


def test_a_deep_page_takes_time_in_proportion():
    chain = extract.Chain()
    chain.weight = {"in:div": 0.5, "name:menu": -2.0, "bias": 0.1, "pair:div>div": 0.3}
    for unit in ("<div>text {0} ", "<div class=c{0}><b>text {0} ", "<li>text<ul class=menu>", "<p>a<span>b"):
        page = "".join(unit.format(i) for i in range(20_000))
        start = time.process_time()
        found = blocks(page)
        scores = extract.page_scores(chain, found)
        assert time.process_time() - start < 10 and len(found) >= 20_000 - 1 and len(scores) == len(found)
    page = "".join(f"<div class='menu x{i % 5}'>text {i} <p>more" + "</div>" * (i % 3) for i in range(400))
    found = blocks(page)
    assert extract.page_scores(chain, found) == pytest.approx(chain.scores(extract.features(found)))
    assert all(len(set(f)) == len(f) for f in extract.features(found))
