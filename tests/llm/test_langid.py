import math

import numpy as np
import pytest
from conftest import awkward_rows, row

from barlab.llm import langid
from barlab.llm.pieces import load


@pytest.fixture(scope="module")
def vocab(spark):
    return langid.Vocabulary(load(spark))


def segmentations(word, longest):
    if not word:
        yield []
    for n in range(1, min(len(word), longest) + 1):
        for rest in segmentations(word[n:], longest):
            yield [word[:n], *rest]


def test_forward_sums_over_all_segmentations(spark, vocab):
    pieces = sorted({p.lower() for p, k in zip(load(spark).pieces, load(spark).kinds) if k == 1 and len(p) <= langid.LONGEST})
    number = {p: i + 1 for i, p in enumerate(pieces)}
    rng = np.random.default_rng(1)
    prob = rng.random((2, vocab.size)) / vocab.size
    prob[:, 0] = 0
    model = langid.LanguageModel(["a", "b"], np.zeros(2), prob)
    words = ["the", "fox", "été", "a", "ab漢\U0001f600c", "letters"]
    got = model.words(vocab, words)
    for w, row_ in zip(words, got):
        for lang in (0, 1):
            total = sum(math.prod(prob[lang][number[p]] if p in number else langid.UNKNOWN if len(p) == 1 else 0.0 for p in s)
                        for s in segmentations(langid.SPACE + w, vocab.longest))
            assert math.isclose(row_[lang], math.log(total), rel_tol=1e-9)


def test_long_words_stay_finite(vocab):
    prob = np.full((1, vocab.size), 1 / vocab.size)
    prob[:, 0] = 0
    got = langid.LanguageModel(["a"], np.zeros(1), prob).words(vocab, ["ab" * 3000, "x"])
    assert np.isfinite(got).all() and got[0, 0] < -5000


def test_expectation_counts_every_character(vocab):
    prob = np.full(vocab.size, 1 / vocab.size)
    prob[0] = 0
    words = ["hello", "fox"]
    use = langid.expected(vocab, words, np.array([2.0, 1.0]), prob)
    assert use.sum() > 0 and use.sum() <= 2 * 6 + 4


def test_awkward_rows(awkward):
    got = langid.predict(awkward).collect()
    assert len(got) == len(awkward_rows())
    for r in got:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.n_words == 0)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {None, 1, 2, 3}
    kept = langid.keep_known(awkward)
    assert kept.columns == awkward.columns and kept.count() == len([r for r in got if r.lang_pred != "und"])


def test_nothing_to_learn_from(make, empty):
    assert langid.predict(empty).count() == 0
    assert [r.lang_pred for r in langid.predict(make([row(2, "some words", None)])).collect()] == ["und"]


def test_held_out_accuracy(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 30 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_samples_of_few_long_texts_and_of_copies(spark):
    from pyspark.sql import functions as F

    from barlab.llm.common import PIECE, sampled_pieces
    words = lambda seed, n: " ".join(f"w{(seed * 7919 + i * 31) % 10007}" for i in range(n))
    long = words(1, 900_000)  # 5 MB
    rows = [("one", long)] + [("copies", "the same text " * 300)] * 400 + [("copies", words(i + 2, 60)) for i in range(800)] + [("short", "a b"), ("none", "")]
    df = spark.createDataFrame(rows, "g string, text string")
    got = sampled_pieces(df, 100_000).groupBy("g").agg(F.sum(F.length("piece")).alias("n"), F.count("*").alias("pieces"), F.count_distinct("piece").alias("d")).collect()
    by = {r.g: r for r in got}
    assert set(by) == {"one", "copies", "short"} and by["short"].n == 3
    assert 100_000 <= by["one"].n <= 100_000 + PIECE and by["copies"].pieces == by["copies"].d > 100
    assert sampled_pieces(df, 10).groupBy("g").count().count() == 3  # a share far below a millionth of "one"
    assert sampled_pieces(df.limit(0), 10).count() == 0
