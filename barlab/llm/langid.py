"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is the
sum over all its segmentations into pieces, computed by the forward algorithm; a text's is the product over
its words. Piece probabilities are learned by expectation maximisation: the same sums, forward and backward,
give the expected use of each piece. All words of a batch are worked on at once in numpy.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from barlab.llm.common import lean, need, parts, sampled_pieces
from barlab.llm.pieces import NORMAL, PIECE_MODEL, SPACE, PieceModel, load

# Expected characters of the sample that a language's piece probabilities are fitted on.
SAMPLE_CHARS = 1_500_000
ROUNDS = 4
SMOOTH = 0.02  # added to every piece's expected count
LONGEST = 16  # characters of the longest piece used
UNKNOWN = 1e-7  # a character outside the vocabulary, in any language
UNDECIDED = "und"
WORD_PART = 63  # longest run of letters that is fitted as one word
CHUNK = 3_000_000  # bytes of text worked on at once
KEEP_SCORE = 0.5  # the pipeline keeps what is at least this sure

LETTERS = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
SLOTS = 20


class Vocabulary:
    """Ids of substrings of many words at once, by rolling hashes."""

    def __init__(self, model: PieceModel):
        pieces = sorted({p.lower() for p, k in zip(model.pieces, model.kinds) if k == NORMAL and 0 < len(p) <= LONGEST})
        self.size = len(pieces) + 1  # id 0: a character that is no piece
        self.longest = max(map(len, pieces), default=1)
        hashes = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            h = 0
            for c in p:
                h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[i] = h
        self.power = np.ones(LONGEST + 1, np.uint64)
        for i in range(LONGEST):
            self.power[i + 1:i + 2] = self.power[i:i + 1] * BASE
        self.tables = []
        left = np.arange(len(pieces))
        for spread in SPREAD * 3:  # what shares a slot goes to a further table
            if not len(left):
                break
            slot = (hashes[left] * spread) >> np.uint64(64 - SLOTS)
            _, first = np.unique(slot, return_index=True)
            keys, ids = np.zeros(1 << SLOTS, np.uint64), np.zeros(1 << SLOTS, np.int32)
            keys[slot[first]], ids[slot[first]] = hashes[left[first]], left[first] + 1
            self.tables.append((spread, keys, ids))
            left = np.delete(left, first)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(hashes.shape, np.int32)
        for spread, keys, ids in self.tables:
            slot = (hashes * spread) >> np.uint64(64 - SLOTS)
            out = np.where(keys[slot] == hashes, ids[slot], out)
        return out

    def prefixes(self, codes: np.ndarray) -> np.ndarray:
        """Hash of every prefix of every row of character codes."""
        h = np.zeros((codes.shape[1] + 1, codes.shape[0]), np.uint64)
        for i in range(codes.shape[1]):
            h[i + 1] = h[i] * BASE + codes[:, i] + np.uint64(1)
        return h

    def ending(self, h: np.ndarray, end: int, size: int) -> np.ndarray:
        return self.find(h[end] - h[end - size] * self.power[size])


def by_width(words: list[str]):
    """(rows, character codes, lengths) of words of like length, with the sign of a word's start in front."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    width = 8
    done = 0
    while done < len(words):
        rows = np.flatnonzero((sizes <= width) & (sizes > (width // 2 if width > 8 else 0)))
        step = max(1, 400_000 // width)  # what is worked on at once: a few dozen MB
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            wide = int(sizes[part].max())
            text = np.array([SPACE + words[i] for i in part], dtype=f"U{wide}")
            yield part, text.view(np.uint32).reshape(len(part), wide).astype(np.uint64), sizes[part]
        done += len(rows)
        width *= 2


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray  # log share of the training documents
    pieces: np.ndarray  # probability, languages x pieces

    def words(self, vocab: Vocabulary, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language: the forward algorithm over all segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        by_piece = np.ascontiguousarray(self.pieces.T)
        by_piece[0] = UNKNOWN  # a character that is no piece
        for rows, codes, sizes in by_width(words):
            n, wide = codes.shape
            h = vocab.prefixes(codes)
            forward = [np.ones((n, len(self.languages)))]
            scale = np.zeros(n)  # log of what the kept rows were divided by
            for end in range(1, wide + 1):
                total = forward[-1] * by_piece[vocab.ending(h, end, 1)]
                for size in range(2, min(end, vocab.longest) + 1):
                    k = vocab.ending(h, end, size)
                    if (hit := np.flatnonzero(k)).size:
                        total[hit] += forward[-size][hit] * by_piece[k[hit]]
                over = np.flatnonzero(sizes == end)
                out[rows[over]] = np.log(total[over]) + scale[over, None]
                forward.append(total)
                forward = forward[-vocab.longest:]
                if end % 16 == 0 and end < wide:  # keep long words within range
                    top = np.max([f.max(1) for f in forward], 0)
                    forward = [f / top[:, None] for f in forward]
                    scale += np.log(top)
        return out


def expected(vocab: Vocabulary, words: list[str], times: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Expected use of each piece in counted words (at most 64 characters) under one language's probabilities."""
    use = np.zeros(vocab.size)
    for rows, codes, sizes in by_width(words):
        n, wide = codes.shape
        h = vocab.prefixes(codes)
        ids = {(end, size): vocab.ending(h, end, size) for end in range(1, wide + 1) for size in range(1, min(end, vocab.longest) + 1)}
        value = {key: np.where(k > 0, prob[k], UNKNOWN if key[1] == 1 else 0.0) for key, k in ids.items()}
        forward = np.zeros((wide + 1, n))
        forward[0] = 1
        for end in range(1, wide + 1):
            for size in range(1, min(end, vocab.longest) + 1):
                forward[end] += forward[end - size] * value[end, size]
        backward = np.zeros((wide + 1, n))
        whole = forward[sizes, np.arange(n)]
        backward[sizes, np.arange(n)] = times[rows] / whole
        for end in range(wide, 0, -1):
            inside = (end <= sizes)
            for size in range(1, min(end, vocab.longest) + 1):
                flow = np.where(inside, value[end, size] * backward[end], 0.0)
                use += np.bincount(ids[end, size], flow * forward[end - size], vocab.size)
                backward[end - size] += flow
    return use


def held_out(doc_id: Column) -> Column:
    """Remainder 1 of the id's checksum; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, vocab: Vocabulary) -> LanguageModel:
    """Piece probabilities of every language, from documents that are not held out and have text and lang.

    Distinct pieces of text of about SAMPLE_CHARS characters a language are chosen by a hash (every language
    has some, however few or long its texts are); their word counts come to the driver. Words are cut
    into parts of WORD_PART characters. Without any such document there is no language.
    """
    train = need(docs, "doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros(0), np.zeros((0, vocab.size)))
    picked = sampled_pieces(train.select(F.col("lang").alias("g"), "text"), SAMPLE_CHARS).select(F.col("g").alias("lang"), F.col("piece").alias("text"))

    def count(batches):
        for batch in parts(batches):
            frame = batch.to_pandas()
            words = frame["text"].map(lambda t: [w[i:i + WORD_PART] for w in LETTERS.findall(t.lower()) for i in range(0, len(w), WORD_PART)])
            flat = pd.DataFrame({"lang": frame["lang"], "word": words}).explode("word").dropna()
            yield pa.RecordBatch.from_pandas(flat.groupby(["lang", "word"]).size().rename("n").reset_index(),
                                             schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]), preserve_index=False)

    counts = picked.mapInArrow(lean(count), "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    pieces = np.empty((len(languages), vocab.size))
    for row, lang in enumerate(languages):
        own = counts[counts["lang"] == lang].sort_values("word")
        words, times = own["word"].tolist(), own["n"].to_numpy(float)
        prob = np.full(vocab.size, 1 / vocab.size)
        for _ in range(ROUNDS):
            use = expected(vocab, words, times, prob) + SMOOTH
            prob = use / use.sum()
        prob[0] = 0.0  # characters outside the vocabulary weigh the same everywhere
        pieces[row] = prob
    total = sum(r["n"] for r in sizes.values())
    return LanguageModel(languages, np.log([sizes[lang]["n"] / total for lang in languages]), pieces)


def totals(model: LanguageModel, vocab: Vocabulary, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """For each list of words the best language (-1: none) and its probability."""
    n = np.fromiter(map(len, found), np.int64, len(found))
    best, score = np.full(len(n), -1), np.zeros(len(n))
    some = np.flatnonzero(n)
    if some.size and model.languages:
        codes, unique = pd.factorize(np.array([w for d in found for w in d], dtype=object))
        words = model.words(vocab, unique.tolist())
        starts = np.concatenate([[0], np.cumsum(n[some])[:-1]])
        total = np.add.reduceat(words[codes], starts, axis=0) + model.prior
        best[some] = total.argmax(1)
        score[some] = 1 / np.exp(total - total.max(1)[:, None]).sum(1)
    return best, score


def judged(model: LanguageModel, vocab: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its probability and the number of words of each text."""
    found = [LETTERS.findall((t or "").lower()) for t in texts]
    return *totals(model, vocab, found), np.fromiter(map(len, found), np.int64, len(found))


def predict(docs: DataFrame, model_path: str = PIECE_MODEL) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_words of every document.

    The whole text is scored. score is the probability of the predicted language given the text. Null text or
    text without letters is `und` with score 0, and so is everything if no language could be learned. Equal
    scores go to the language first in the alphabet. Repeated rows give repeated results.
    """
    pieces = load(docs.sparkSession, model_path)
    model = fit(docs, Vocabulary(pieces))

    def run(batches):
        vocab = Vocabulary(pieces)
        for batch in parts(batches, 1, CHUNK):
            best, score, n = judged(model, vocab, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2),
                pa.array([model.languages[b] if b >= 0 else UNDECIDED for b in best], pa.string()), pa.array(score), pa.array(n)], names=["doc_id", "held_out", "lang_pred", "score", "n_words"])

    rows = need(docs, "doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    return rows.mapInArrow(lean(run), "doc_id bigint, held_out boolean, lang_pred string, score double, n_words bigint")


def keep_known(docs: DataFrame, model_path: str = PIECE_MODEL) -> DataFrame:
    """The documents whose language is told with a score of KEEP_SCORE or more; all columns stay as they are.

    Decided row by row by id and text, so rows with equal ids may differ in their fate.
    """
    pieces = load(docs.sparkSession, model_path)
    model = fit(docs, Vocabulary(pieces))
    at = docs.columns.index("text")

    def run(batches):
        vocab = Vocabulary(pieces)
        for batch in parts(batches, at, CHUNK):
            best, score, _ = judged(model, vocab, batch.column(at).to_pylist())
            yield batch.filter(pa.array((best >= 0) & (score >= KEEP_SCORE)))

    return docs.mapInArrow(lean(run), docs.schema)
