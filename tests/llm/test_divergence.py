import random
import re
from collections import Counter

import pytest
from conftest import awkward_rows, row

from barlab.llm import divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least, top=10):
    docs = [(r[2] or "", r[3] or "", terms(r[1])) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        keep = {t for t, n in df.items() if n >= least}
        v = len(keep)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in keep) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * v)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in counts.items():
            pairs = [(-sum(f(p(c, t), p(o, t)) for t in keep), other) for other, o in counts.items() if other != s]
            mark = [(-f(p(c, t), p(whole, t)), t) for t in keep if c[t] > 0 and p(c, t) > p(whole, t)]
            for part, found in (("pair", pairs), ("term", mark)):
                found = sorted(found, key=lambda x: (x[0], x[1].encode()))[:None if part == "pair" else top]
                out += [(lang, s, part, item, -value, i) for i, (value, item) in enumerate(found, 1)]
    return sorted(out)


def found(df, **kw):
    return sorted(map(tuple, divergence.audit(df, **kw).collect()))


def doc(i, text, lang, source):
    r = row(i, text, lang)
    return (*r[:3], source, *r[4:])


def corpus(n, seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "c'd", "ünï", "漢", "\U00010400x", "é", "zz", "q1r", "mm"] + [f"t{chr(97 + k)}" for k in range(26)]
    return [doc(i, " ".join(rng.choice(vocab[:rng.randint(1, len(vocab))]) for _ in range(rng.randint(0, 30))),
                rng.choice(["en", "fr", None, ""]), rng.choice(["s0", "s0", "s1", "s2", None])) for i in range(n)]


@pytest.mark.parametrize("most", [divergence.BROADCAST_ROWS, 0])
def test_against_brute_force(make, monkeypatch, most):
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", most)
    rows = corpus(150, 1)
    assert found(make(rows)) == brute(rows, 10)


@pytest.mark.parametrize("least", [1, 2])
def test_awkward_rows(awkward, least):
    assert found(awkward, least=least) == brute(awkward_rows(), least)


def test_ties_are_cut_in_byte_order(make):
    words = ["b" + chr(0x4E00 + k) for k in range(30)] + ["\U00010400", "￮"]
    rows = [doc(i, " ".join(words), "en", "s1") for i in range(3)] + [doc(9, "other " * 40, "en", "s2"), doc(10, "other", "en", "s3")]
    assert found(make(rows), least=1) == brute(rows, 1)


def test_a_language_that_keeps_no_term(make, empty):
    rows = [doc(1, "one", "en", "s1"), doc(2, "two", "en", "s2"), doc(3, None, "fr", None)]
    assert found(make(rows)) == brute(rows, 10) == [("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)]
    assert found(empty) == []


def test_counts_beyond_the_square_root_of_64_bits(spark):
    got = spark.sql("select 4000000000000000000L as c, 8000000000000000000L as n, 5L as v").select(divergence.share("c", "n", "v").alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (4 * 10**18 + 2) // (8 * 10**18 + 10)
