"""Removal of repeated passages: sampled suffixes, sorted in runs, merged with known common prefixes.

Every string of SPAN bytes that also starts in a document with a smaller id is found, and the bytes it covers
are removed. Sorting all suffixes would move each byte dozens of times, so only some are sorted:

1. Every window of SPAN bytes names one of its positions, the head: the start of its HEAD-byte string of
   smallest hash. Equal windows name the same place, so the windows around a head can be judged together. About
   one position in fourteen is a head.
2. Documents are packed into blocks. Each block sends the sorted hashes of its heads; a head whose string is in
   no second document anywhere is dropped. This loses nothing.
3. Of the others each block sends the suffixes from the head on, sorted and front-coded, with the bytes before
   the head that some window needs; equal ones of a block are one, under the smallest id.
4. A loser tree merges the runs. The common prefixes it yields tell, for each place of the head in the window,
   which windows agree from the head on; a hash of the bytes before tells the rest. The smallest id of
   equal windows goes back to the blocks that hold a larger one.

A block is one row of a written table; rows are found again by their number, so a lost executor repeats only
its own part.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from barlab.llm.common import need, split_by_bytes
from barlab.llm.dartminhash import mix
from barlab.llm.losertree import merge
from barlab.session import materialize

SPAN = 50
HEAD = 24
PLACES = SPAN - HEAD + 1  # of a head in a window
BLOCK = 8_000_000  # bytes of a block; a longer document has one of its own
STEP = 1 << 20  # bytes looked at at once
BUCKET = 2_000_000  # bytes of text whose heads share a bucket
LEAST_BUCKETS = 128
SMALL = 64_000_000  # bytes of answers that are broadcast; more are joined by shuffle

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_LAST = np.iinfo(np.int64).max  # a null id counts as larger than every other
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        n = STEP + 2 * SPAN
        for x in (_P, _INV):
            steps = np.full(n, x)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps))
    return _POWERS[0], _POWERS[1]


def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob."""
    raw = b"".join(len(a.tobytes()).to_bytes(8, "little") + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _open(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    for kind in kinds:
        n = int.from_bytes(raw[at:at + 8], "little")
        out.append(np.frombuffer(raw, kind, n // np.dtype(kind).itemsize, at + 8))
        at += 8 + n
    return out


class Groups:
    """Runs of windows with one head in a block's bytes: where the head is, the first and last window, hashes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Documents are data[starts:ends], apart by at least one byte that belongs to none."""
        head, first, last, key, whole = [], [], [], [], []
        last_window = ends - SPAN
        power, inverse = _powers()
        for at in range(0, max(0, len(data) - SPAN + 1), STEP):
            part = data[at:at + STEP + SPAN - 1]
            n = len(part) - HEAD + 1
            summed = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=summed[1:])
            h = mix((summed[HEAD:] - summed[:n]) * inverse[:n])
            v = (h & ~np.uint64((1 << 21) - 1)) | np.arange(n, dtype=np.uint64)
            two = np.minimum(v[:-1], v[1:])
            four = np.minimum(two[:-2], two[2:])
            eight = np.minimum(four[:-4], four[4:])
            sixteen = np.minimum(eight[:-8], eight[8:])
            least = np.minimum(sixteen[:len(sixteen) - (PLACES - 16)], sixteen[PLACES - 16:])  # of PLACES positions
            place = (least & np.uint64((1 << 21) - 1)).astype(np.int64)
            window = np.arange(len(place)) + at
            doc = np.searchsorted(starts, window, side="right") - 1 if len(starts) else window
            ok = (doc >= 0) & (window <= last_window[np.maximum(doc, 0)])
            new = ok & (np.concatenate([[True], ~ok[:-1]]) | np.concatenate([[True], place[1:] != place[:-1]]))
            begin = np.flatnonzero(new)
            if not len(begin):
                continue
            # a run ends before the next begins or where windows stop being inside a document
            stop = np.flatnonzero(ok & np.concatenate([new[1:] | ~ok[1:], [True]]))
            a = place[begin]
            head.append(a + at)
            first.append(begin + at)
            last.append(stop + at)
            key.append(mix(h[a] + _P))  # heads are small hashes; dealt out by another one
            text = (summed[stop + SPAN] - summed[begin]) * inverse[begin]
            whole.append(mix(text + ((a - begin) * 64 + (stop - begin)).astype(np.uint64) * _P))
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.head, self.first, self.last = join(head, np.int64), join(first, np.int64), join(last, np.int64)
        self.key, self.whole = join(key, np.uint64), join(whole, np.uint64)


class Block:
    """The documents of one block."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes):
        self.ids, size = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(size + 1)])[:-1].astype(np.int64)
        self.ends = self.starts + size
        self.groups = Groups(self.data, self.starts, self.ends)
        self.owner = self.ids[np.searchsorted(self.starts, self.groups.head, side="right") - 1] if len(self.ids) else self.groups.head

    def heads(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct head hashes, ascending, and whether two documents of this block hold each."""
        order = np.argsort(self.groups.key, kind="stable")
        key, owner = self.groups.key[order], self.owner[order]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        if not len(begin):
            return key, np.zeros(0, bool)
        return key[begin], np.minimum.reduceat(owner, begin) != np.maximum.reduceat(owner, begin)

    def alike(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups in order of (text, id, place), the start of each set of equal texts, and the set of each in order."""
        g = self.groups
        order = np.lexsort((g.first, self.owner, g.whole))
        whole = g.whole[order]
        begin = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if len(whole) else np.zeros(0, int)
        number = np.zeros(len(whole), np.int64)
        number[begin] = 1
        return order, begin, np.cumsum(number) - 1


def _pack(docs: DataFrame) -> DataFrame:
    def run(batches):
        ids, texts, size = [], [], 0

        def out():
            data = b"\0".join(texts) + b"\0"
            return pa.RecordBatch.from_pylist([{"ids": np.array(ids, np.int64).tobytes(), "sizes": np.array([len(t) for t in texts], np.int64).tobytes(),
                                                "data": zstandard.ZstdCompressor(level=3).compress(data), "bytes": len(data)}], schema=schema)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (t or "").encode("utf-8", "surrogatepass")
                if texts and size + len(raw) > BLOCK:
                    yield out()
                    ids, texts, size = [], [], 0
                ids.append(_LAST if i is None else i)
                texts.append(raw)
                size += len(raw) + 1
        if texts:
            yield out()

    schema = pa.schema([("ids", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary()), ("bytes", pa.int64())])
    rows = need(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(run, "ids binary, sizes binary, data binary, bytes bigint").withColumn("block", F.monotonically_increasing_id()), "blocks")


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending keys give ascending buckets."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _present(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, start, end) of the buckets that occur in an ascending array, however many there are in all."""
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
    return zip(bucket[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(bucket)])


def _heads(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, run): sorted head hashes as differences, with the marks of Block.heads."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                key, many = Block(r["ids"], r["sizes"], r["data"]).heads()
                low = key >> np.uint64(16)  # 48 bits tell heads apart well enough: one too many is sorted in vain
                rows = []
                for b, lo, hi in _present(_bucket(key, buckets)):
                    step = np.diff(low[lo:hi], prepend=low[lo:lo + 1] - low[lo:lo + 1])
                    rows.append({"bucket": b, "block": r["block"], "run": _squeeze(step[:1], step[1:].astype(np.uint64), np.packbits(many[lo:hi]))})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("run", pa.binary())]))

    return blocks.mapInArrow(run, "bucket int, block bigint, run binary")


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """For each block's run of one bucket, which heads are in a second document somewhere."""
    keys, marks = [], []
    for blob in frame["run"]:
        first, steps, many = _open(blob, "<u8", "<u8", "u1")
        keys.append(np.cumsum(np.concatenate([first, steps])))
        marks.append(np.unpackbits(many, count=len(keys[-1])).astype(bool))
    every = np.sort(np.concatenate(keys))
    double = every[1:][every[1:] == every[:-1]]
    out = []
    for key, many in zip(keys, marks):
        at = np.searchsorted(double, key)
        twice = np.zeros(len(key), bool)
        inside = at < len(double)
        twice[inside] = double[at[inside]] == key[inside]
        out.append(np.packbits(twice | many).tobytes())
    return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "bits": out})


def _runs(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, run): sorted, front-coded suffixes of the heads that remain."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = _block_runs(r, buckets)
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("run", pa.binary())]))

    return blocks.mapInArrow(run, "bucket int, block bigint, n bigint, run binary")


def _block_runs(r: dict, buckets: int) -> list[dict]:
    block = Block(r["ids"], r["sizes"], r["data"])
    g = block.groups
    if not len(g.head) or not r["answers"]:
        return []
    key, _ = block.heads()
    span = {b: (lo, hi) for b, lo, hi in _present(_bucket(key, buckets))}
    stays = np.zeros(len(key), bool)
    for a in r["answers"]:
        lo, hi = span[a["bucket"]]
        stays[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo)
    order, begin, _ = block.alike()
    one = order[begin]  # of equal texts the one with the smallest id
    one = one[stays[np.searchsorted(key, g.key[one])]]
    rows = []
    where = _bucket(g.key[one], buckets)
    one = one[np.argsort(where, kind="stable")]
    padded = np.concatenate([np.zeros(SPAN, np.uint8), block.data, np.zeros(SPAN, np.uint8)])
    for b, lo, hi in _present(np.sort(where)):
        mine = one[lo:hi]
        head, right, left = g.head[mine], g.last[mine] + SPAN - g.head[mine], g.head[mine] - g.first[mine]
        text = padded[head[:, None] + SPAN + np.arange(SPAN)]
        text[np.arange(SPAN) >= right[:, None]] = 0
        order = np.argsort(np.ascontiguousarray(text).view(f"S{SPAN}").ravel(), kind="stable")
        mine, head, right, left, text = mine[order], head[order], right[order], left[order], text[order]
        same = np.zeros(len(mine), np.int64)
        if len(mine) > 1:
            differ = text[1:] != text[:-1]
            same[1:] = np.where(differ.any(1), differ.argmax(1), SPAN)
        before = padded[head[:, None] + SPAN - 1 - np.arange(PLACES - 1)]
        rows.append({"bucket": b, "block": r["block"], "n": len(mine), "run": _squeeze(
            same.astype(np.uint8), right.astype(np.uint8), left.astype(np.uint8), text[(np.arange(SPAN) >= same[:, None])],
            before[np.arange(PLACES - 1) < left[:, None]], block.owner[mine], g.first[mine])})
    return rows


def _merged(frame: pd.DataFrame) -> pd.DataFrame:
    """Merge the runs of a bucket; for each block the windows of its suffixes that a smaller id holds too."""
    parts = [_open(blob, "u1", "u1", "u1", "u1", "u1", "<i8", "<i8") for blob in frame["run"]]
    blocks = frame["block"].to_numpy()
    del frame
    runs = []
    for same, _, _, tails, *_ in parts:
        ends = np.cumsum(SPAN - same.astype(np.int64)).tolist()
        raw, begin = tails.tobytes(), [0, *ends[:-1]]
        runs.append((same.tolist(), [raw[x:y] for x, y in zip(begin, ends)]))
    order, common = merge(runs)
    del runs
    sizes = np.array([len(p[0]) for p in parts])
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    order = np.array(order)
    # the strings of a run come in its own order
    by_run = np.argsort(order, kind="stable")
    at = np.empty(len(order), np.int64)
    at[by_run] = np.arange(len(order))
    at = base[order] + at - base[order]
    common = np.array(common)
    right, left = (np.concatenate([p[i] for p in parts])[at].astype(np.int64) for i in (1, 2))
    ids, first = (np.concatenate([p[i] for p in parts])[at] for i in (5, 6))
    lefts = np.concatenate([p[2] for p in parts]).astype(np.int64)
    before = np.zeros((len(at), PLACES - 1), np.uint8)
    before[np.arange(PLACES - 1) < lefts[:, None]] = np.concatenate([p[4] for p in parts])
    before = before[at]
    least = np.full((len(at), PLACES), _LAST)
    hashed = np.zeros(len(at), np.uint64)
    for place in range(PLACES):
        if place:
            hashed = mix(hashed * _P + before[:, place - 1].astype(np.uint64) + np.uint64(1))
        has = np.flatnonzero((left >= place) & (right >= SPAN - place))
        if not len(has):
            continue
        kind = np.cumsum(common < SPAN - place)[has]  # equal from the head on
        o = np.lexsort((hashed[has], kind))
        k, h = kind[o], hashed[has][o]
        begin = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (h[1:] != h[:-1])]))
        low = np.minimum.reduceat(ids[has][o], begin)
        least[has[o], place] = np.repeat(low, np.diff(np.append(begin, len(o))))
    hit = least < ids[:, None]
    # stretches of neighbouring windows; window number = left - place
    edge = np.zeros((len(at), PLACES + 1), bool)
    edge[:, 0], edge[:, -1] = hit[:, 0], hit[:, -1]
    edge[:, 1:-1] = hit[:, 1:] != hit[:, :-1]
    row, place = np.nonzero(edge)
    row, begin, end = row[::2], place[::2], place[1::2] - 1
    block = order[row]
    out = []
    for b in np.unique(block):
        mine = block == b
        out.append((blocks[b], _squeeze(first[row[mine]], (left[row[mine]] - end[mine]).astype(np.uint8), (left[row[mine]] - begin[mine]).astype(np.uint8))))
    return pd.DataFrame(out, columns=["block", "hits"])


def _answered(blocks: DataFrame, answers: DataFrame, item) -> DataFrame:
    """Blocks with the list of their answers; small answers are broadcast."""
    size = answers.agg(F.sum(F.length(item[-1]))).first()[0] or 0
    grouped = answers.groupBy(F.col("block").alias("to")).agg(F.collect_list(F.struct(*item)).alias("answers"))
    grouped = F.broadcast(grouped) if size <= SMALL else grouped
    return blocks.join(grouped, F.col("block") == F.col("to"), "left").drop("to")


def _results(r: dict) -> list[dict]:
    """What is left of each document of a block."""
    block = Block(r["ids"], r["sizes"], r["data"])
    g, change = block.groups, np.zeros(len(block.data) + 1, np.int32)
    if len(g.head):
        order, begin, number = block.alike()
        low = block.owner[order][begin][number]
        again = order[block.owner[order] > low]  # a smaller id of this block holds the same text
        np.add.at(change, g.first[again], 1)
        np.add.at(change, g.last[again] + SPAN, -1)
        parts = [_open(a["hits"], "<i8", "u1", "u1") for a in r["answers"] or []]
        if parts:
            first, frm, to = (np.concatenate([p[i] for p in parts]) for i in range(3))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            where = rank[np.searchsorted(g.first, first)]  # the one that was sent is the first of its set
            least = order[block.owner[order] == low]
            count = np.bincount(number[block.owner[order] == low], minlength=len(begin))
            offset = np.concatenate([[0], np.cumsum(count)])
            times = count[number[where]]
            pick = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(offset[number[where]], times)
            start = g.first[least[pick]]
            np.add.at(change, start + np.repeat(frm, times), 1)
            np.add.at(change, start + np.repeat(to, times) + SPAN, -1)
    gone = np.cumsum(change[:-1]) > 0
    rises = gone & ~np.concatenate([[False], gone[:-1]])
    n_gone, n_rises = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(rises)])
    out = []
    for i, s, e in zip(block.ids.tolist(), block.starts.tolist(), block.ends.tolist()):
        n = int(n_gone[e] - n_gone[s])
        kept = block.data[s:e][~gone[s:e]] if n else block.data[s:e]
        out.append({"doc_id": None if i == _LAST else i, "n_bytes": e - s, "n_removed": n, "n_spans": int(n_rises[e] - n_rises[s]), "kept": kept.tobytes()})
    return out


def _kept(docs: DataFrame, finish, schema: str, arrow: pa.Schema) -> DataFrame:
    blocks = _pack(docs)
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    buckets = split_by_bytes(total, BUCKET, LEAST_BUCKETS)
    source = blocks.drop("bytes")
    shared = materialize(_heads(source, buckets).groupBy("bucket").applyInPandas(_shared, "block bigint, bucket int, bits binary"), "shared")
    runs = _runs(_answered(source, shared, ["bucket", "bits"]), buckets)
    hits = materialize(runs.groupBy("bucket").applyInPandas(_merged, "block bigint, hits binary"), "hits")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([finish(d) for d in _results(r)], schema=arrow)

    return _answered(source, hits, ["hits"]).mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and kept_sha256.

    Null text counts as empty. A null id counts as larger than every id, and rows with equal ids take nothing from
    each other. Texts of fewer than SPAN bytes lose nothing. Documents are read whole, however long.
    """
    def finish(d: dict) -> dict:
        return {"doc_id": d["doc_id"], "n_bytes": d["n_bytes"], "n_removed": d["n_removed"], "n_spans": d["n_spans"], "kept_sha256": hashlib.sha256(d["kept"]).hexdigest()}

    return _kept(docs, finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
                 pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]))


def remove(docs: DataFrame) -> DataFrame:
    """(doc_id, text): what is left of every document; bytes that are no longer UTF-8 become the replacement sign."""
    def finish(d: dict) -> dict:
        return {"doc_id": d["doc_id"], "text": d["kept"].decode("utf-8", "replace")}

    return _kept(docs, finish, "doc_id bigint, text string", pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
