import hashlib
import zlib

import pytest
from conftest import awkward_rows, prose, row

from barlab.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def tree(nodes):
    """Root and, for every node, the list of (left, right) on its way up."""
    level, at, ways = list(nodes), list(range(len(nodes))), [[] for _ in nodes]
    while len(level) > 1:
        for i, way in enumerate(ways):
            start = at[i] // 8 * 8
            run = level[start:start + 8]
            way.append(("".join(run[:at[i] - start]), "".join(run[at[i] - start + 1:])))
        level = [sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)]
        at = [a // 8 for a in at]
    return level[0], ways


def low(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    keys = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    built, subs = {}, []
    for lang in keys:
        docs = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r[:5])))
        built[lang] = docs, *tree([leaf(*r[:5]) for r in docs])
        subs.append(built[lang][1])
    root, tops = tree(subs)
    out = []
    for lang, above in zip(keys, tops):
        docs, sub, ways = built[lang]
        for r, way in zip(docs, ways):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            acc = leaf(r[0], low(r[1]), *r[2:5]) if hit else leaf(*r[:5])
            for left, right in way + above:
                acc = sha(left + acc + right)
            out.append((r[0], leaf(*r[:5]), sub, root, sha("".join(a + b for a, b in way + above)), acc, acc == root))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, merkle.manifest(df).collect()), key=str)


def test_awkward_rows(awkward):
    assert found(awkward) == brute(awkward_rows())


@pytest.mark.parametrize("most", [merkle.BROADCAST_GROUPS, 0])
def test_many_heights(make, monkeypatch, most):
    monkeypatch.setattr(merkle, "BROADCAST_GROUPS", most)
    sizes = {None: 1, "": 2, "a": 8, "b": 9, "c": 64, "d": 65, "é": 73, "z": 1, "zz": 7, "zzz": 3}  # ten roots: two levels above them
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append(row(at * 7 % 233 - 20, prose(at, 5), lang))
            at += 1
    assert found(make(rows)) == brute(rows)


def test_one_document_and_none(make, empty):
    rows = [row(3, "UPPER")]
    got = found(make(rows))
    assert got == brute(rows)
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")
    assert merkle.manifest(empty).collect() == []


def test_copies_of_one_row(make):
    rows = [row(5, "Same")] * 40 + [row(i, "Other") for i in range(20)]
    assert found(make(rows)) == brute(rows)


def test_only_changed_texts_fail(make):
    rows = [row(i, "Text" if i % 2 else "text") for i in range(100)]
    hit = {r["doc_id"] for r in merkle.manifest(make(rows)).where("not verified").collect()}
    assert hit == {i for i in range(1, 100, 2) if zlib.crc32(str(i).encode()) % 3 == 0}
