import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest import awkward_rows, prose, row
from pyspark.sql import functions as F

from barlab.llm import lmscore
from barlab.llm.bilinear import Bilinear
from barlab.session import materialize

TOKEN = re.compile("[^\x20\x09-\x0D]+")


def brute(rows):
    tokens = [[*TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")), None] for r in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 1 for r in rows]
    count = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    total, distinct = sum(count.values()), len(count)
    return sorted(((r[0], h, len(ts), sum(count[t] > 0 for t in ts), total, round(sum(math.log10((count[t] + .5) / (total + .5 * (distinct + 1))) for t in ts), 3))
                   for r, ts, h in zip(rows, tokens, held)), key=str)


def got(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in lmscore.score(df).collect()), key=str)


def test_awkward_rows(awkward, empty, monkeypatch):
    monkeypatch.setattr(lmscore, "FREQUENT", 6)  # most counts come by the join
    monkeypatch.setattr(lmscore, "VOCABULARY", 4)
    assert got(awkward) == brute(awkward_rows())
    assert lmscore.score(empty).count() == 0


def test_nothing_to_learn_from(make):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lmscore.score(make([row(held, "two words")])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0) and r.score < 0


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    frequency = rng.random(50)
    model = Bilinear.start(frequency / frequency.sum(), 8)
    start = model.tables()
    assert np.allclose(np.exp(start.log_prob(np.full(50, 3), np.full(50, 9), np.arange(50))), frequency / frequency.sum(), atol=1e-5)
    u, v, w = rng.integers(0, 50, (3, 4000))
    w = np.where(rng.random(4000) < 0.8, (u + 1) % 50, w)  # the next token follows from the one before
    model.train(u, v, w, frequency / frequency.sum(), 1)
    tables = model.tables()
    for a, b in [(0, 0), (3, 9), (49, 1)]:
        assert math.isclose(np.exp(tables.log_prob(np.full(50, a), np.full(50, b), np.arange(50))).sum(), 1, rel_tol=1e-4)
    assert tables.log_prob(u, v, w).mean() > start.log_prob(u, v, w).mean() + 0.3


def test_models_are_averaged_in_steps(make, monkeypatch):
    monkeypatch.setattr(lmscore, "FAN_IN", 2)
    rows = [row(i, " ".join(f"w{(i + k) % 9}" for k in range(200))) for i in range(40)]
    _, words, model = lmscore.fit(make(rows).repartition(5))
    assert np.isfinite(model.bias).all() and words.distinct == 10


def test_context_helps_on_held_out_texts(spark, tables):
    got = lmscore.score(spark.read.parquet(f"{tables}/documents.parquet")).where("held_out").toPandas()
    assert len(got) > 20 and got["score"].sum() > got["base_score"].sum()


def test_every_training_token_trains_the_model(make, monkeypatch):
    kept = []
    monkeypatch.setattr(lmscore, "materialize", lambda df, name: kept.append((name, m := materialize(df, name))) or m)
    _, words, _ = lmscore.fit(make([row(i, " ".join(f"w{(i + k) % 9}" for k in range(200))) for i in range(40)]).repartition(3))
    assert sum(r["n"] for r in next(m for name, m in kept if name == "models").collect()) == words.total


def test_words_outside_the_vocabulary_depend_on_their_context(make, monkeypatch):
    monkeypatch.setattr(lmscore, "VOCABULARY", 0)
    monkeypatch.setattr(lmscore, "held_out", lambda doc_id: doc_id >= 1000)
    rows = [row(i, " ".join(["the cat" if i % 2 else "a dog"] * 40)) for i in range(400)]
    got = {r.doc_id: r.score for r in lmscore.score(make(rows + [row(1000, "the cat the cat"), row(1001, "the dog the dog")])).collect()}
    assert got[1000] > got[1001] + 0.5


def test_classes_share_out_all_of_their_probability(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "VOCABULARY", 2)
    found = [("the", 9), ("walking", 5), ("talking", 4), ("of", 3), ("ä", 2), ("x", 1)]
    placed = spark.createDataFrame(found, "word string, c int").select("word", lmscore.class_column(F.col("word")).alias("k"), "c").collect()
    assert all(r.k == lmscore.class_of(r.word.encode()) for r in placed)
    every = {r.k: [x.c for x in placed if x.k == r.k] for r in placed}
    words = lmscore.Words(found, 24, 6, 0, [(k, sum(c), len(c)) for k, c in every.items()])
    outside = {k: [x.c for x in placed if x.k == k and x.word not in ("the", "walking")] for k in every}
    for k, c in outside.items():
        assert math.isclose(sum((x + 0.5) / 10 ** words.class_whole[k] for x in c) + 0.5 / 10 ** words.class_whole[k], 1)
    assert len(words.frequency) == 1 + lmscore.CLASSES + 2 and words.token(b"the") == 1 + lmscore.CLASSES


def test_one_long_training_text_and_a_third_of_copies(make):
    free = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1]
    long = " ".join(f"w{i * 31 % 5003}" for i in range(700_000))  # 4 MB
    one = lmscore.score(make([row(free[0], long), row(free[1], None)])).collect()
    assert len(one) == 2 and all(r.score < 0 for r in one)
    rows = [row(i, "the same text again and again") for i in free[:40]] + [row(i, prose(i, 30)) for i in free[40:120]]
    got = {r.doc_id: r for r in lmscore.score(make(rows)).collect()}
    assert len(got) == 120 and all(r.score < 0 and r.n_known == r.n_tokens for r in got.values())


def test_words_of_a_chunk(make):
    """White space of ASCII parts words, only A-Z are lowered, and codes follow the first occurrence; column or list."""
    texts = ["", "  a B\tc ", "\x0b x\x0cy\r\n", "É ß\x1c1 A", " ", "Ünï cödé X", "a\x85b c d"]
    codes, unique, n = lmscore.split(texts)
    found = [re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) for t in texts]
    assert n.tolist() == [len(f) for f in found]
    assert [unique[c] for c in codes] == [w for f in found for w in f] and unique == list(dict.fromkeys(w for f in found for w in f))
    again = lmscore.split(pa.array([None, *texts])[1:])
    assert [x.tolist() if hasattr(x, "tolist") else x for x in again] == [codes.tolist(), unique, n.tolist()]
    assert lmscore.split(pa.array([None, ""]))[2].tolist() == [0, 0]
    assert {r.word: r.c for r in lmscore.word_counts(make([row(i, t) for i, t in enumerate(texts)])).collect()} == Counter(w.decode() for f in found for w in f)


def test_many_words_are_numbered_as_one_is():
    words = lmscore.Words([("the", 5), ("of", 3)], 10, 3, 1, [(k, 10, 3) for k in range(lmscore.CLASSES)])
    some = [b"of", b"rare", b"x", "Ünï".encode(), b"the"]
    assert words.tokens(some).tolist() == [words.token(w) for w in some]
