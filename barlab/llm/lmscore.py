"""Log-probability of documents under a log-bilinear model and under token counts.

Counts cover every training token. The frequent words' counts go with the tasks (a bounded list); the counts of
all others are joined by word. The model's vocabulary is the head of that list; every other word is a token of the
class its last ENDING bytes fall into. The classes have vectors like words, as target and as context, and a class's
probability is shared out among its words by the counts.
"""
from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from barlab.llm.bilinear import END, Bilinear, Tables
from barlab.llm.common import UPPER, lean, need, parts, sampled_pieces
from barlab.session import materialize

VOCABULARY = 2_000  # words with a token of their own
CLASSES = 256  # tokens of all other words, by their ending
ENDING = 3  # bytes
FREQUENT = 200_000  # words at most whose counts go with the tasks: about 10 MB
DIMENSION = 24
FIRST_CHARS = 2_000_000  # expected characters of the sample that the common start is trained on
FAN_IN = 32  # models averaged at once
CHUNK = 4_000_000  # bytes of text worked on at once


def held_out(doc_id: Column) -> Column:
    """Remainder 1 of the id's checksum; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over the texts. Words are lowered after they are counted as they stand: there are fewer of them."""
    raw = rows.select(F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("raw")).where("raw <> ''").groupBy("raw").agg(F.count("*").alias("c"))
    return raw.groupBy(F.translate("raw", UPPER, UPPER.lower()).alias("word")).agg(F.sum("c").alias("c"))


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-ENDING:]) % CLASSES


def class_column(word: Column) -> Column:
    """class_of for a text column."""
    raw = word.cast("binary")
    return F.pmod(F.crc32(F.substring(raw, -ENDING, ENDING)), F.lit(CLASSES)).cast("int")


class Words:
    """Numbers and counts of the frequent words, and what the counts add up to.

    classes: (class, tokens, distinct words) over all words; the vocabulary's own are taken off here.
    """

    def __init__(self, frequent: list[tuple[str, int]], total: int, distinct: int, texts: int, classes: list[tuple[int, int, int]]):
        self.total, self.distinct, self.texts = total, distinct, texts  # N, V and the number of training texts
        self.count = {w.encode("utf-8", "surrogatepass"): c for w, c in frequent}
        head = list(self.count.items())[:VOCABULARY]
        self.number = {w: i + 1 + CLASSES for i, (w, _) in enumerate(head)}
        mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
        for k, tokens_, words_ in classes:
            mass[k], kinds[k] = tokens_, words_
        for w, c in head:
            mass[class_of(w)] -= c
            kinds[class_of(w)] -= 1
        share = np.array([texts, *mass, *(c for _, c in head)], float) + 0.5
        self.frequency = share / share.sum()
        self.base_whole = math.log10(total + 0.5 * (distinct + 1))
        self.class_whole = np.log10(mass + 0.5 * (kinds + 1))  # one kind a class is left for words never seen

    def token(self, word: bytes) -> int:
        return self.number.get(word) or 1 + class_of(word)

    def tokens(self, words: list[bytes]) -> np.ndarray:
        number, crc = self.number.get, zlib.crc32
        return np.fromiter((number(w) or 1 + crc(w[-ENDING:]) % CLASSES for w in words), np.int32, len(words))


def split(texts: pa.Array | list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(code of each word, distinct words, words per text); a null text is empty."""
    if isinstance(texts, list):
        texts = pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.binary()).view(pa.string())
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    n, flat = pc.list_value_length(found).to_numpy().astype(np.int64), found.flatten()
    some = pc.binary_length(flat).to_numpy() > 0  # white space at either end leaves an empty word
    if not some.all():
        n -= np.bincount(np.repeat(np.arange(len(n)), n)[~some], minlength=len(n))
        flat = flat.filter(pa.array(some))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist(), n


def sequences(codes: np.ndarray, numbers: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Model tokens of all texts with an end after each, and the two tokens before each."""
    ends = np.cumsum(n + 1) - 1
    token = np.full(int((n + 1).sum()), END, np.int32)
    inside = np.ones(len(token), bool)
    inside[ends] = False
    token[inside] = numbers[codes] if len(codes) else 0
    one = np.concatenate([[END], token[:-1]])
    two = np.concatenate([[END, END], token[:-2]])[:len(token)]
    first = np.concatenate([[0], ends[:-1] + 1])
    two[first] = END
    two[(first + 1)[n > 0]] = END
    return one, two, token


def _learn(model: Bilinear, words: Words, texts: pa.Array | list[str], seed: int) -> int:
    codes, unique, n = split(texts)
    if not len(n):
        return 0
    numbers = words.tokens(unique)
    one, two, token = sequences(codes, numbers, n)
    order = np.random.default_rng(seed).permutation(len(token))
    model.train(one[order], two[order], token[order], words.frequency, seed)
    return len(token)


def _frequent(counts: DataFrame) -> list[tuple[str, int]]:
    """The most frequent words with their counts, at most FREQUENT, in order of count, then word.

    Eighths of powers of two of the counts are tallied first; the words above the lowest eighth that still
    fits come to the driver, so no task sends more than that.
    """
    eighth = F.floor(F.log2("c") * 8)
    room, least = FREQUENT, None
    for r in counts.groupBy(eighth.alias("e")).agg(F.count("*").alias("n")).orderBy(F.desc("e")).collect():
        if (room := room - r["n"]) < 0:
            break
        least = r["e"]
    if least is None:
        return []
    got = counts.where(eighth >= least).select("word", "c").toArrow()
    return sorted(zip(got["word"].to_pylist(), got["c"].to_pylist()), key=lambda x: (-x[1], x[0]))


def fit(docs: DataFrame) -> tuple[DataFrame, Words, Bilinear]:
    """Counts of all training tokens as a table, the bounded word list, and the model.

    The model starts from distinct pieces of texts of about FIRST_CHARS characters; then every partition of the training
    documents trains it further on its own on all its tokens, and the results are averaged by the tokens they saw, FAN_IN at once.
    """
    train = need(docs, "doc_id", "text").where(~held_out(F.col("doc_id"))).select(F.coalesce("text", F.lit("")).alias("text"))
    counts = materialize(word_counts(train), "counts")
    size = train.agg(F.count("*").alias("n")).first()
    seen = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    frequent = _frequent(counts)
    classes = counts.groupBy(class_column(F.col("word")).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    words = Words(frequent, (seen["n"] or 0) + size["n"], seen["v"] + (size["n"] > 0), size["n"], [tuple(r) for r in classes])
    model = Bilinear.start(words.frequency, DIMENSION)
    if not size["n"]:
        return counts, words, model
    sample = sampled_pieces(train.select(F.lit("").alias("g"), "text"), FIRST_CHARS).orderBy("piece").collect()  # FIRST_CHARS and one piece at most
    _learn(model, words, [r["piece"] for r in sample], 1)

    def run(batches):
        own, n = model.unpack(model.pack()), 0
        for i, batch in enumerate(parts(batches, 0, CHUNK)):
            n += _learn(own, words, batch.column(0), i)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([own.pack()], pa.binary())], names=["n", "model"])

    def average(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(m, np.float32).astype(float) * n for n, m in zip(frame["n"], frame["model"]))
        return pd.DataFrame({"n": [frame["n"].sum()], "model": [(total / frame["n"].sum()).astype(np.float32).tobytes()]})

    models = materialize(train.mapInArrow(lean(run), "n bigint, model binary").withColumn("id", F.monotonically_increasing_id()), "models")
    while (left := models.count()) > FAN_IN:
        groups = math.ceil(left / FAN_IN)
        models = materialize(models.groupBy(F.pmod(F.xxhash64("id"), F.lit(groups)).alias("g")).applyInPandas(average, "n bigint, model binary")
                             .withColumn("id", F.monotonically_increasing_id()), "models")
    rows = models.orderBy("id").toPandas()
    return counts, words, model.unpack(average(rows)["model"][0]) if len(rows) else model


_TABLES: dict[str, Tables] = {}


def _tables(name: str, raw: bytes, shape: Bilinear) -> Tables:
    """The model's tables, made once a worker process."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = shape.unpack(raw).tables()
    return _TABLES[name]


def score(docs: DataFrame) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score (both log10).

    Null counts as empty: the end alone. Without training documents every count is 0. Repeated rows give
    repeated results; a null id counts as an empty text when documents are held out.
    """
    counts, words, model = fit(docs)
    name, raw, shape = uuid.uuid4().hex, model.pack(), Bilinear.start(words.frequency, DIMENSION)
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, model double, rare array<string>"

    def run(batches):
        tables = _tables(name, raw, shape)
        end_base = math.log10(words.texts + 0.5)
        for batch in parts(batches, 1, CHUNK):
            codes, unique, n = split(batch.column(1))
            numbers = words.tokens(unique)
            count = np.fromiter((words.count.get(w, 0) for w in unique), np.float64, len(unique))
            one, two, token = sequences(codes, numbers, n)
            log = tables.log_prob(one, two, token) / math.log(10)
            starts = np.concatenate([[0], np.cumsum(n + 1)[:-1]])
            by_model = np.add.reduceat(log, starts)
            # of each word: its count's part, if the list has it; joined later if not
            listed = count > 0
            part = np.where(listed, np.log10(np.maximum(count, 1) + 0.5), 0.0)
            outside = numbers <= CLASSES
            whole = words.class_whole[np.where(outside, numbers - 1, 0)]
            sums = np.zeros((3, len(n)))
            some = np.flatnonzero(n)
            if len(some):
                begin = np.concatenate([[0], np.cumsum(n[some])[:-1]])
                for row, value in enumerate((part, np.where(outside, part - whole, 0.0), listed.astype(float))):
                    sums[row, some] = np.add.reduceat(value[codes], begin)
            base = sums[0] + end_base - (n + 1) * words.base_whole
            rare = np.flatnonzero(~listed[codes])
            owner = np.repeat(np.arange(len(n)), n)[rare]
            offsets = np.searchsorted(owner, np.arange(len(n) + 1))
            strings = pa.array([w.decode("utf-8", "surrogatepass") for w in unique], pa.string())
            known = sums[2].astype(np.int64) + (words.texts > 0)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(n + 1), pa.array(known), pa.array(base),
                pa.array(by_model + sums[1]), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), strings.take(pa.array(codes[rare])))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])

    rows = need(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    rows = materialize(rows.mapInArrow(lean(run), schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"), F.count("c").alias("also"))
    more = F.coalesce("more", F.lit(0.0))
    return rows.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"), F.round(F.col("base") + more, 6).alias("base_score"), F.round(F.col("model") + more, 6).alias("score"))
