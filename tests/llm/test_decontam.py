import hashlib
import re

import pytest
from conftest import awkward_rows, prose, row

from barlab.llm import decontam

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(k) for k in wins}
    out = []
    for r in rows:
        w = words(r[1])
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in wins[tuple(w[i:i + n])] if x is not None}
        out.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, prose(1, 60)), (2, "lazy dog"), (2, "lazy dog"), (10, prose(4, 15)), (11, None), (12, "..."), (None, prose(3, 12))]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(i, t, "extra") for i, t in ITEMS], "item_id bigint, text string, doc_id string")


@pytest.mark.parametrize("most", [decontam.BROADCAST_WINDOWS, 0])
def test_awkward_rows(awkward, items, monkeypatch, most):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", most)
    assert sorted(map(tuple, decontam.report(awkward, items).collect()), key=str) == brute(awkward_rows(), ITEMS)


def test_empty_tables(awkward, empty, items):
    assert decontam.report(empty, items).count() == 0
    assert decontam.report(awkward, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.remove_spans(empty, items).count() == 0


def test_spans_are_removed(make, spark):
    item = prose(9, 12)
    rows = [row(1, "Keep this. " + item + " And this!"), row(2, item), row(3, "nothing here"), row(4, None), row(5, "")]
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    left = decontam.remove_spans(make(rows), bench)
    assert left.columns == make(rows).columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: "Keep this. And this!", 3: "nothing here", 4: None, 5: ""}


def test_columns_that_clash_with_working_names(spark):
    item = prose(9, 12)
    docs = spark.createDataFrame([(1, "Keep. " + item, 5, True, "x", 7, "y"), (2, "clean", 6, False, "x", 8, "z")],
                                 "doc_id bigint, text string, __th int, __hit boolean, __new string, __id int, __ih string")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = decontam.remove_spans(docs, bench)
    assert got.columns == docs.columns
    assert {r.doc_id: (r.text, r["__th"], r["__hit"], r["__id"]) for r in got.collect()} == {1: ("Keep. ", 5, True, 7), 2: ("clean", 6, False, 8)}
    assert decontam.report(docs, bench).where("contaminated").count() == 1
