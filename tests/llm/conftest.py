import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, key string, id bigint, v bigint, word string, "
          "row bigint, block bigint, hash bigint, pos int, `kind` string, `odd name` string")
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix jovial quartz potions behind old stone walls".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), "k", 7, 7, "w", 7, 7, 7, 7, "kind", "odd")


def awkward_rows():
    """Null and repeated ids, null and empty texts, ties, copies, a very long text."""
    copy = prose(1, 60)
    return [row(None, copy), row(1, None), row(2, ""), row(3, "!!! ***"), row(4, prose(2, 30_000)), row(5, copy), row(5, copy), row(6, copy, None),
            row(7, copy.upper()), row(8, "Ünï cødé 漢字 " + prose(3, 40) + "\n\n" + prose(4, 40)), row(9, "x" * 5000), row(10, prose(5, 3)),
            row(None, None), row(8, prose(6, 50), "fr")]


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def awkward(make):
    return make(awkward_rows())


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"
