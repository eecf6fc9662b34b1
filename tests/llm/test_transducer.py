import hashlib
import random

import pytest
import sentencepiece
from conftest import awkward_rows

from barlab.llm import pieces, transducer


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.PIECE_MODEL)


@pytest.fixture(scope="module")
def machine(spark):
    return transducer.Transducer(pieces.load(spark))


def test_same_ids_and_texts_as_the_library(machine, library):
    rng = random.Random(1)
    cases = ["", " ", "a  b\n c​ ½ ㎏ x\ty", "     hello    world  ", "x▁y", "\x00a", "▁" * 19 + " a", "a" * 500, "😀 <s> <0x0A> <unk>", "th" * 30 + "he" * 30]
    for _ in range(1500):
        letters = rng.choice([" ab", "the raine o", "abcdefghij   éèü", "0123 .,-", "ionteaks ", " ", "漢字かな a", "\n\t =+/(){}"])
        cases.append("".join(rng.choice(letters) for _ in range(rng.choice([3, 10, 30, 100]))))
    for case in cases:
        ids = machine.encode(case).tolist()
        assert ids == library.encode(case), case
        assert machine.decode(ids) == library.decode(ids) == case.replace("▁", " ")


def test_cheapest_path_of_a_unigram_model():
    parts = {"a": -1.0, "b": -1.0, "ab": -1.5, "ba": -1.2, "aba": -4.0, "▁": -0.5, "▁a": -2.5}
    names = ["<unk>", *parts]
    model = pieces.PieceModel(tuple(names), (0.0, *parts.values()), (2,) + (1,) * len(parts), pieces.UNIGRAM, True, False, True)
    machine = transducer.Transducer(model)

    def best(text):
        if not text:
            return 0.0, []
        return min((-parts[text[:n]] + best(text[n:])[0], [text[:n], *best(text[n:])[1]]) for n in range(1, len(text) + 1) if text[:n] in parts)

    for text in ["ab", "aba", "bababa", "abab", "a b ab"]:
        for word in ("▁" + text.replace(" ", "▁")).replace("▁", " ▁").split():
            path = machine.path(word)
            assert sum(-parts[p] for p in path) == pytest.approx(best(word)[0])


def test_awkward_rows(spark, awkward, empty, library):
    got = transducer.encode(awkward, pieces.load(spark)).collect()
    want = [(r[0], library.encode(r[1] or "")) for r in awkward_rows()]
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == sorted(want, key=str)
    texts = sorted(hashlib.sha256((r[1] or "").encode()).hexdigest() for r in awkward_rows())
    assert sorted(r.text_sha256 for r in got) == texts and all(r.round_trip for r in got)
    assert transducer.encode(empty, pieces.load(spark)).count() == 0
