import hashlib
import os
import random
import time

import numpy as np
from conftest import awkward_rows, prose, row  # noqa: F401

from barlab.llm import losertree, repeats

LAST = 1 << 70


def brute(rows):
    """Result rows by definition: each window looked up in a table of smallest ids."""
    data = [(LAST if r[0] is None else r[0], r[0], (r[1] or "").encode()) for r in rows]
    low = {}
    for i, _, t in data:
        for p in range(len(t) - 49):
            low[t[p:p + 50]] = min(low.get(t[p:p + 50], LAST + 1), i)
    out = []
    for i, doc_id, t in data:
        gone = [False] * len(t)
        for p in range(len(t) - 49):
            if low[t[p:p + 50]] < i:
                gone[p:p + 50] = [True] * 50
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, repeats.report(df).collect()), key=str)


def test_loser_tree_merges_and_tells_common_prefixes():
    rng = random.Random(3)
    for _ in range(100):
        runs, every = [], []
        for r in range(rng.randint(1, 9)):
            s = sorted(bytes(rng.choice(b"ab") for _ in range(5)) for _ in range(rng.randint(0, 12)))
            shared = [0, *(len(os.path.commonprefix([x, y])) for x, y in zip(s, s[1:]))][:len(s)]
            runs.append((shared, [x[n:] for x, n in zip(s, shared)]))
            every += [(x, r) for x in s]
        order, common = losertree.merge(runs)
        every.sort()
        assert order == [r for _, r in every]
        assert common == [0, *(len(os.path.commonprefix([x[0], y[0]])) for x, y in zip(every, every[1:]))][:len(every)]


def test_known_prefixes_are_not_read_again():
    class Counted(bytes):
        seen = 0

        def __getitem__(self, i):
            if isinstance(i, int):
                Counted.seen += 1
            return super().__getitem__(i)

    # equal strings of 40 bytes in 8 runs: after the first comparison of each pair nothing is left to read
    runs = [([0] + [40] * 9, [Counted(b"z" * 40)] + [b""] * 9) for _ in range(8)]
    losertree.merge(runs)
    assert Counted.seen <= 2 * 40 * 8


def test_awkward_rows(awkward):
    assert got(awkward) == brute(awkward_rows())


def test_empty_table(empty):
    assert repeats.report(empty).count() == 0


def test_shared_passages_over_blocks(make, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 3000)
    rng = random.Random(5)
    shared = [prose(100 + i, 25) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(1000 + i * 9 + k, rng.randint(1, 30)) for k in range(3)] + rng.sample(shared, 2)
        rng.shuffle(parts)
        rows.append(row(i * 3 % 60, "\n".join(parts) + "ab" * rng.randint(0, 40)))
    assert got(make(rows).repartition(4)) == brute(rows)


def test_answers_joined_by_shuffle(make, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 500)
    monkeypatch.setattr(repeats, "SMALL", 0)
    rows = [row(i, prose(i % 4, 40) + prose(50 + i, 5)) for i in range(12)]
    assert got(make(rows)) == brute(rows)


def test_text_that_is_left(make):
    rows = [row(1, "a" + prose(1, 20)), row(2, "b" + prose(1, 20))]
    assert {r.doc_id: r.text for r in repeats.remove(make(rows)).collect()} == {1: rows[0][1], 2: "b"}


def test_a_block_walks_only_the_buckets_it_has():
    bucket = np.array([0, 0, 3, 7, 7, 7, 10**9])
    assert list(repeats._present(bucket)) == [(0, 0, 2), (3, 2, 3), (7, 3, 6), (10**9, 6, 7)]
    assert list(repeats._present(bucket[:0])) == []
    key = np.sort(np.random.default_rng(1).integers(0, 2**63, 50_000).astype(np.uint64) * np.uint64(2))
    for buckets in (10, 10**9):
        start = time.process_time()
        spans = list(repeats._present(repeats._bucket(key, buckets)))
        assert time.process_time() - start < 1 and spans[0][1] == 0 and spans[-1][2] == len(key)
        assert all(a[2] == b[1] and a[0] < b[0] for a, b in zip(spans, spans[1:]))
