import hashlib

from conftest import awkward_rows, row
from pyspark.sql import functions as F

from barlab.llm import fingerprint


def edited(rows):
    """By definition: each text with its tail replaced by the head of the next one."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, r in enumerate(order):
        t, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        h = len(t) // 2
        out.append((r[0], len(t), hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_awkward_rows(awkward):
    got = fingerprint.report(awkward).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == edited(awkward_rows())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.doc_id == 5}) == 1


def test_many_ranges(make, monkeypatch):
    monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", 3)
    rows = [row(i * i, f"text {i}\n" + "ab" * i) for i in range(40)] + [row(None, "n"), row(4, "again")]
    got = fingerprint.report(make(rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == edited(rows)


def test_one_document_and_none(make, empty):
    one = fingerprint.report(make([row(3, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    assert fingerprint.report(empty).count() == 0


def vectors(make, *texts):
    df = fingerprint.with_vector(make([row(i, t) for i, t in enumerate(texts)]), F.col("text"), "v")
    return [r.v for r in df.orderBy("doc_id").collect()]


def test_order_does_not_matter_and_paragraphs_add_up(make):
    a, b, c, ab, ba, abc = vectors(make, "One. Two.", "Three", "Four", "One. Two.\nThree", "Three\nOne. Two.", "Four\nOne. Two.\nThree")
    masks = [fingerprint.LOW32] * 9 + [fingerprint.LOW60] * 40
    add = lambda x, y: [(p + q) & m for p, q, m in zip(x, y, masks)]
    take = lambda x, y: [(p - q) & m for p, q, m in zip(x, y, masks)]
    assert ab == ba == add(a, b) and ab != a
    assert abc == add(ab, c) and take(abc, c) == ab


def test_likeness_follows_what_is_shared(make):
    s = [f"Sentence number {i} is here." for i in range(80)]
    text = lambda r: "\n".join(s[i] for i in r)
    df = make([row(0, text(range(40)))]).crossJoin(make([row(i, text(range(40 - i, 80 - i))) for i in (0, 10, 20, 30, 40)]).select(F.col("doc_id").alias("d"), F.col("text").alias("t")))
    df = fingerprint.with_vector(fingerprint.with_vector(df, F.col("text"), "x"), F.col("t"), "y")
    got = {r.d: r.near for r in fingerprint.with_likeness(df, "x", "y", "near").collect()}
    for shift, near in got.items():
        assert abs(near - shift / 40) < 0.3
    assert got[40] == 1.0 and got[0] < got[20] < got[40]


def test_ids_far_apart_and_an_outlier(make, monkeypatch):
    rows = [row(i, f"text {i}.") for i in range(300)] + [row(2**63 - 1, "last."), row(-2**63, "first."), row(2**50, "outlier."), row(None, "none.")]
    many = make(rows)
    want = None
    for per in (8192, 10, 3):  # one range, several, more than a hundred
        monkeypatch.setattr(fingerprint, "ROWS_PER_BUCKET", per)
        got = sorted(map(tuple, fingerprint.report(many).collect()), key=str)
        want = got if want is None else want
        assert got == want and len(got) == len(rows)


def test_ranges_by_binary_search(spark):
    import bisect
    for cuts in ([], [5], [1, 4, 4, 9], list(range(0, 400, 3))):
        asked = spark.range(-3, 410).select("id", fingerprint._range_of(fingerprint.F.col("id"), cuts).alias("r")).collect()
        assert all(r["r"] == bisect.bisect_right(cuts, r["id"]) for r in asked)
