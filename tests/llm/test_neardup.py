import itertools

import numpy as np
import pytest
from conftest import awkward_rows, prose, row
from pyspark.sql import functions as F

from barlab.llm import dartminhash, neardup


def brute(rows):
    """Class of each row: connected sets of equal or similar texts, named by the smallest id."""
    texts = sorted({r[1] or "" for r in rows})
    up = {t: t for t in texts}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t

    for a, b in itertools.combinations(texts, 2):
        if neardup._shingles(a) and neardup._shingles(b) and neardup.likeness(a, b) >= neardup.SIMILAR:
            up[top(a)] = top(b)
    low = {}
    for r in rows:
        c = top(r[1] or "")
        if r[0] is not None:
            low[c] = min(low.get(c, r[0]), r[0])
    return sorted(((r[0], low.get(top(r[1] or ""))) for r in rows), key=str)


def family(seed, members, words=120, changes=6):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 3000, words)]
    for _ in range(members):
        one = list(base)
        for i in rng.choice(words, rng.integers(0, changes), replace=False):
            one[i] = f"x{rng.integers(0, 3000)}"
        yield " ".join(one)


def got(df):
    return sorted(map(tuple, neardup.report(df).collect()), key=str)


def test_signatures_agree_as_weighted_sets_do():
    base = [f"w{i % 90}" for i in range(400)]  # repeated shingles weigh more
    texts = [" ".join(base), " ".join(base[:300]), " ".join(base[:200] + [f"y{i}" for i in range(100)]), " ".join(f"z{i}" for i in range(50))]
    sig, weight = dartminhash.signatures([t.encode() for t in texts], 2000)
    assert weight.tolist() == [396, 296, 296, 46]
    for a, b in itertools.combinations(range(4), 2):
        assert abs((sig[a] == sig[b]).mean() - neardup.likeness(texts[a], texts[b])) < 0.05


def test_signature_is_the_same_in_any_batch():
    texts = [prose(i, 5 + 7 * i).lower().encode() for i in range(9)] + [b"", b"!!", b"one two"]
    whole, weight = dartminhash.signatures(texts)
    for i, t in enumerate(texts):
        assert (dartminhash.signatures([t])[0][0] == whole[i]).all()
    assert weight[-3:].tolist() == [0, 0, 1]


def test_awkward_rows(awkward, empty):
    assert got(awkward) == brute(awkward_rows())
    assert neardup.report(empty).count() == 0
    assert neardup.keep_one(empty).count() == 0


@pytest.mark.parametrize("few", [neardup.FEW, 1])
def test_groups(make, monkeypatch, few):
    """With FEW = 1 every open bucket goes through the side bands."""
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "BROADCAST_KEYS", 500_000 if few > 1 else 0)
    texts = [t for s in range(4) for t in family(s, 25)] + [prose(90 + i, 40) for i in range(20)] + list(family(7, 30, 60, 12))
    rows = [row(1000 - i, t) for i, t in enumerate(texts)]
    rows += rows[:5]
    assert got(make(rows)) == brute(rows)


def test_a_large_group_whose_middle_pair_is_no_link(make):
    """1,200 copies with up to a third of their words changed: of the linked pairs all but a few end in one class."""
    texts = list(family(5, 1200, 150, 14))
    cells = neardup._cells(texts)
    value, at = np.unique(np.concatenate(cells), return_inverse=True)
    mark = np.zeros((len(texts), len(value)), np.float32)
    mark[np.repeat(np.arange(len(texts)), [len(c) for c in cells]), at] = 1
    both, size = mark @ mark.T, mark.sum(1)
    alike = both / (size[:, None] + size[None, :] - both)
    a, b = np.nonzero(np.triu(alike >= neardup.SIMILAR, 1))
    assert np.median(alike[np.triu_indices(len(texts), 1)]) < 0.75 and len(a) > 1000
    named = dict(got(make([row(i, t) for i, t in enumerate(texts)])))
    same = np.array([named[i] == named[j] for i, j in zip(a.tolist(), b.tolist())])
    assert same.mean() >= 0.99
    # and nothing is joined that no chain of links joins
    up = list(range(len(texts)))
    for i, j in zip(a.tolist(), b.tolist()):
        while up[i] != i:
            i = up[i]
        while up[j] != j:
            j = up[j]
        up[i] = j
    top = []
    for i in range(len(texts)):
        while up[i] != i:
            i = up[i]
        top.append(i)
    assert len({(named[i], top[i]) for i in range(len(texts))}) == len(set(named.values()))


def test_links_that_no_leader_finds(make, monkeypatch):
    """One bucket with one leader, and no meeting in side bands: every link is found all the same."""
    monkeypatch.setattr(neardup, "_side_bands", lambda node: F.array(F.col(f"{node}.id")))
    rows = [row(i, t) for i, t in enumerate(t for s in range(4) for t in family(20 + s, 12, 150, 4))]
    nodes = neardup._sign(make(rows)).select(F.lit(1).alias("v"), F.lit(len(rows)).alias("n"), F.struct(F.col("doc_id").alias("id"), *neardup._MARKS).alias("node"))
    found = dict(map(tuple, neardup._links(nodes, make(rows).select(F.col("doc_id").alias("id"), "text")).select("id", "class").collect()))
    assert sorted(((r[0], found.get(r[0], r[0])) for r in rows), key=str) == brute(rows)


def test_texts_of_a_link_share_a_prefix_cell(make):
    texts = [*family(8, 60, 100, 12), "one two three", "a b c d e f", ""]
    table = make([row(i, t) for i, t in enumerate(texts)]).select(F.col("doc_id").alias("id"), "text")
    cells = {}
    for r in neardup._prefixes(table).collect():
        cells.setdefault(r.id, set()).add(r.cell)
    for a, b in itertools.combinations(range(60), 2):
        assert neardup.likeness(texts[a], texts[b]) < neardup.SIMILAR or cells[a] & cells[b]
    assert len(cells[0]) == 96 - 77 + 1 and len(cells[60]) == 1 and 62 not in cells


def test_one_of_each_class_stays(make):
    texts = list(family(3, 10)) + [prose(1, 30), prose(1, 30), prose(2, 30)]
    rows = [row(50 - i, t) for i, t in enumerate(texts)] + [row(38, prose(2, 30))]
    left = neardup.keep_one(make(rows))
    assert left.columns == make(rows).columns
    classes = {c for _, c in brute(rows)}
    assert sorted(r.doc_id for r in left.collect()) == sorted(classes)


@pytest.mark.parametrize("most", [neardup.BROADCAST_BLOCKS, 0])
def test_blocks_find_every_link(make, monkeypatch, most):
    """Blocks of a few texts, families named badly, and texts without words among them."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "BLOCK_CELLS", 500)
    monkeypatch.setattr(neardup, "COLUMNS", 64)
    monkeypatch.setattr(neardup, "BROADCAST_BLOCKS", most)
    texts = [t for s in range(3) for t in family(30 + s, 20, 90, 9)] + ["", "!", "one two", "one two"] + [prose(60 + i, 30) for i in range(5)]
    rows = [row(i, t) for i, t in enumerate(texts)]
    given = make(rows).select(F.col("doc_id").alias("id"), "text")
    left = given.select("id", F.col("id").alias("class"), (F.col("id") % 4 * 15).alias("family"))
    named = list(range(len(texts)))
    for r in neardup._across(left, given).collect():
        assert r.a < r.b and neardup.likeness(texts[r.a], texts[r.b]) >= neardup.SIMILAR
        low, high = sorted((named[r.a], named[r.b]))
        named = [low if c == high else c for c in named]
    assert sorted(enumerate(named), key=str) == brute(rows)
    # links inside a class are none to tell
    assert not neardup._across(left.withColumn("class", F.lit(1)), given).count()


def test_blocks_meet_in_cells_of_several_classes(make, monkeypatch):
    """Two blocks of several classes each that share cells of one class only, and one with two classes of one cell."""
    written, kept = {}, neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, label="kept": written.setdefault(label, kept(df, label)))
    base, again = prose(70, 60), "again " + prose(71, 60)
    texts = [base, prose(72, 50), base + " more", prose(73, 50), again, again + " more"]
    given = make([row(i, t) for i, t in enumerate(texts)]).select(F.col("doc_id").alias("id"), "text")
    left = given.select("id", F.element_at(F.array(*map(F.lit, [90, 1, 90, 3, 4, 5])), F.col("id").cast("int") + 1).cast("bigint").alias("class"),
                        F.element_at(F.array(*map(F.lit, [70, 70, 80, 80, 60, 60])), F.col("id").cast("int") + 1).cast("bigint").alias("family"))
    assert [(r.a, r.b) for r in neardup._across(left, given).collect()] == [(4, 5)]
    assert written["meet"].count() == 1


def test_no_group_is_expanded_into_pairs(make, monkeypatch):
    """300 texts of one group, hardly any two of them a link: what is looked at pair by pair grows with the texts."""
    looked, verified = [], neardup._verified
    monkeypatch.setattr(neardup, "_verified", lambda pairs, texts: (looked.append(pairs.count()), verified(pairs, texts))[1])
    rng, rows = np.random.default_rng(44), []
    for i in range(300):  # three words of a common text changed, far apart: pairs are 0.73 to 0.77 alike
        one = [f"w{k}" for k in range(200)]
        for at in (5, 70, 140):
            one[rng.integers(at, at + 50)] = f"x{at}y{i}"
        rows.append(row(i, " ".join(one)))
    nodes = neardup._sign(make(rows)).select(F.lit(1).alias("v"), F.lit(len(rows)).alias("n"), F.struct(F.col("doc_id").alias("id"), *neardup._MARKS).alias("node"))
    found = dict(map(tuple, neardup._links(nodes, make(rows).select(F.col("doc_id").alias("id"), "text")).select("id", "class").collect()))
    assert sorted(((r[0], found.get(r[0], r[0])) for r in rows), key=str) == brute(rows)
    assert sum(looked) < 40 * len(rows)
