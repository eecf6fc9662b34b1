"""Near-duplicate classes by DartMinHash and banded joining.

Texts that are equal are one node. Nodes that share a band are candidates; links are pairs of a weighted Jaccard
similarity of SIMILAR or more over five-word shingles, computed on the texts. A class is a connected set.

No group is expanded into pairs. Of every bucket first only the pairs with its leader are compared, which joins
most of a large group of copies to one class. What the classes found so far leave apart within a
bucket is compared pair by pair in small buckets, and in large ones with other leaders in further bands of the
sketch; then all pairs of different classes that share one of the rare shingles that texts of a link must share
are compared, block by block (see _links and _across).
"""
from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.llm import dartminhash as dart
from barlab.llm.common import free_name, lean, need, parts
from barlab.session import materialize, small

SIMILAR = 0.8
# Pairs whose four-bit sketches put them below this are not compared: 4.6 standard deviations under SIMILAR.
SKETCH_SIMILAR = 0.66
LANES = 0x1111111111111111  # lowest bit of each four
BROADCAST_KEYS = 500_000  # 40 bytes each when broadcast; more are joined by shuffle
FEW = 12  # members of a bucket that are compared pair by pair
SEATS = 2  # nodes of a larger one, beside its leader, that all its members are compared with
SLOTS = 2 ** 20  # counts of cells, which only order them
BLOCK, BLOCK_CELLS = 512, 2_000_000  # texts and their cells that are compared at once with as many others
COLUMNS = 4096  # cells of a block looked at in one product
BROADCAST_BLOCKS = 100_000  # pairs of blocks when broadcast; more are joined by shuffle

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SKETCH = dart.COORDINATES // 16


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _sign(docs: DataFrame) -> DataFrame:
    """doc_id, key, and of texts with words the sketch and the bands."""
    names = [f"s{i}" for i in range(_SKETCH)] + [f"b{i}" for i in range(dart.BANDS)]

    def run(batches):
        for batch in parts(batches, 2):
            sig, weight = dart.signatures([(t or "").encode("utf-8", "surrogatepass").lower() for t in batch.column(2).to_pylist()])
            values = np.concatenate([dart.sketch(sig), dart.bands(sig)], 1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(np.ascontiguousarray(values[:, i]), mask=weight == 0) for i in range(values.shape[1])],
                names=["doc_id", "key", *names])

    rows = need(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("key"), "text")
    return rows.mapInArrow(lean(run), "doc_id bigint, key binary, " + ", ".join(f"{n} bigint" for n in names))


def likeness(a: str, b: str) -> float:
    """Weighted Jaccard similarity of the counted five-word shingles of two texts."""
    x, y = _shingles(a), _shingles(b)
    both = sum((x & y).values())
    whole = sum(x.values()) + sum(y.values()) - both
    return both / whole if whole else 1.0


def _shingles(text: str) -> Counter:
    words = _WORD.findall(text.encode("utf-8", "surrogatepass").lower())
    n = min(dart.SHINGLE, len(words))
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def _cells(texts: list[str]) -> list[np.ndarray]:
    """The counted shingles of each text as ascending 64-bit hashes, copies told apart."""
    cell, doc = dart.cells([t.encode("utf-8", "surrogatepass").lower() for t in texts])
    cell = cell[np.lexsort((cell, doc))]
    return np.split(cell, np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of node numbers that are links."""
    def run(batches):
        for batch in parts(batches, 3):
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            known = dict(zip(a, ta)) | dict(zip(b, tb))
            cells = dict(zip(known, _cells(list(known.values()))))
            ok = []
            for p, q in zip(a, b):
                x, y = cells[p], cells[q]
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(both >= SIMILAR * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array([p for p, o in zip(a, ok) if o], pa.int64()), pa.array([q for q, o in zip(b, ok) if o], pa.int64())], names=["a", "b"])

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(lean(run), "a bigint, b bigint")


def components(both: DataFrame) -> DataFrame:
    """(id, class): the smallest id each node is connected with, for the nodes of links given in either direction.

    Every step takes the smallest class around, then follows classes to their own; it ends when nothing
    changes. Each state is a written table.
    """
    state = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("class")), "classes")
    while True:
        near = both.join(state, F.col("b") == F.col("id")).groupBy("a").agg(F.min("class").alias("m"))
        low = state.join(near, F.col("id") == F.col("a")).select("id", "class", F.least("class", "m").alias("m"))
        up = state.select(F.col("id").alias("up"), F.col("class").alias("top"))
        after = materialize(low.join(up, F.col("m") == F.col("up")).select("id", F.least("m", "top").alias("class"), (F.least("m", "top") != F.col("class")).alias("moved")), "classes")
        state = after.select("id", "class")
        if not after.where("moved").take(1):
            return state


_MARKS = [f"s{i}" for i in range(_SKETCH)]


def _alike(p: Column, q: Column) -> Column:
    """Whether the sketches of two rows leave a link possible."""
    def apart(c: str) -> Column:  # lanes of four bits that differ
        x = p[c].bitwiseXOR(q[c])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(LANES)))

    # unequal values agree in one of sixteen cases
    return sum((apart(c) for c in _MARKS), F.lit(0)) <= int(dart.COORDINATES * (1 - SKETCH_SIMILAR) * 15 / 16)


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_KEYS else df


def _side_bands(node: str) -> Column:
    """Keys of bands made of the sketch, eight coordinates each and other ones than a bucket's band."""
    low = [F.col(f"{node}.{c}").bitwiseAND(F.lit(0xFFFFFFFF)) for c in _MARKS]
    high = [F.shiftrightunsigned(f"{node}.{c}", 32) for c in _MARKS]
    return F.array(*[F.xxhash64(F.lit(i), h) for i, h in enumerate(low + high)])


def _merged(state: DataFrame | None, links: DataFrame) -> DataFrame:
    """The classes (id, class) after further links (a, b). What is joined are classes, once per pair of them, so
    links inside a class cost nothing from here on."""
    if state is None:
        ends = links.select("a", "b")
    else:
        known = state.select(F.col("id").alias("i"), F.col("class").alias("c"))
        one = links.join(known, F.col("a") == F.col("i"), "left").select(F.coalesce("c", "a").alias("p"), F.col("b").alias("q"))
        ends = one.join(known, F.col("q") == F.col("i"), "left").select(F.col("p").alias("a"), F.coalesce("c", "q").alias("b")).where("a <> b")
        ends = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    tops = components(materialize(ends.select(both.alias("l")).select("l.a", "l.b"), "links"))
    if state is None:
        return tops
    named = tops.select(F.col("id").alias("i"), F.col("class").alias("c"))
    old = state.join(named, F.col("class") == F.col("i"), "left").select("id", F.coalesce("c", "class").alias("class"))
    return materialize(old.unionByName(tops.join(state.select("id"), "id", "left_anti")), "classes")


def _ordered(texts: DataFrame) -> DataFrame:
    """(id, cells, prefix): of every text with words all its cells, packed, and those of which two texts of
    similarity SIMILAR share at least one.

    Such texts share at least SIMILAR of the cells of either, so in any order common to all texts the first
    (1 - SIMILAR) of them and one more cannot all be missing in the other. Cells in few texts come first, by a
    count over all texts in SLOTS slots and then by the cell, so what many texts have in common is in no prefix.
    """
    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in parts(batches, 1):
            total += np.bincount(_slots(_folded(batch)[0]), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    rows = texts.select("id", "text")
    found = rows.mapInArrow(lean(count), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(SLOTS, np.int64)
    held[found["slot"].to_numpy()] = found["n"].to_numpy()

    def run(batches):
        for batch in parts(batches, 1):
            cell, doc = _folded(batch)
            order = np.lexsort((cell, held[_slots(cell)], doc))
            cell, doc = cell[order], doc[order]
            size = np.bincount(doc, minlength=batch.num_rows)
            start = np.cumsum(size) - size
            front = np.where(size > 0, size - np.ceil(SIMILAR * size - 1e-9).astype(np.int64) + 1, 0)
            some, ids = np.flatnonzero(size), batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[some]), pa.array([cell[start[i]:start[i] + size[i]].tobytes() for i in some], pa.binary()),
                pa.array([cell[start[i]:start[i] + front[i]].view(np.int64) for i in some], pa.list_(pa.int64()))], names=["id", "cells", "prefix"])

    return rows.mapInArrow(lean(run), "id bigint, cells binary, prefix array<bigint>")


def _prefixes(texts: DataFrame) -> DataFrame:
    """(id, cell): the prefix cells of every text (see _ordered)."""
    return _ordered(texts).select("id", F.explode("prefix").alias("cell"))


def _shared(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """How many cells each of the first texts has in common with each of the second."""
    (va, ka), (vb, kb) = (np.unique(np.concatenate(side), return_inverse=True) for side in (one, two))
    at_a, at_b = np.intersect1d(va, vb, assume_unique=True, return_indices=True)[1:]
    sides = []
    for side, value, key, at in ((one, va, ka, at_a), (two, vb, kb, at_b)):
        column = np.full(len(value), -1)
        column[at] = np.arange(len(at))
        column, text = column[key], np.repeat(np.arange(len(side)), [len(c) for c in side])
        order = np.argsort(column, kind="stable")
        order = order[np.searchsorted(column[order], 0):]
        sides.append((column[order], text[order], len(side)))
    both = np.zeros((len(one), len(two)), np.float32)
    for begin in range(0, len(at_a), COLUMNS):
        marks = []
        for column, text, n in sides:
            lo, hi = np.searchsorted(column, [begin, begin + COLUMNS])
            mark = np.zeros((n, min(COLUMNS, len(at_a) - begin)), np.float32)
            mark[text[lo:hi], column[lo:hi] - begin] = 1
            marks.append(mark)
        both += marks[0] @ marks[1].T
    return both


def _forest(frame: pa.Table) -> pa.Table:
    """Links (a, b) between the texts of two blocks, or within one: as many as connect all classes that links connect."""
    rows = {}
    for side in (False, True):
        mine = frame.filter(pc.equal(frame["other"], side))
        rows[side] = (mine["id"].to_numpy(), mine["class"].to_numpy(), [np.frombuffer(c, np.uint64) for c in mine["cells"].to_pylist()])
    alone = not len(rows[True][0])
    (a, ca, cells_a), (b, cb, cells_b) = rows[False], rows[not alone]
    links = []
    if len(a) and len(b):
        x, y = (np.array([len(c) for c in cells])[shape] for cells, shape in ((cells_a, np.s_[:, None]), (cells_b, np.s_[None, :])))
        both = _shared(cells_a, cells_b).astype(float)
        ok = (both >= SIMILAR * (x + y - both) - 1e-9) & (ca[:, None] != cb[None, :])
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while (above := up.get(c, c)) != c:
                up[c] = c = up.get(above, above)
            return c

        for i, j in np.argwhere(ok).tolist():
            p, q = top(int(ca[i])), top(int(cb[j]))
            if p != q:
                up[p] = q
                links.append((int(a[i]), int(b[j])))
    return pa.table({"a": pa.array([min(l) for l in links], pa.int64()), "b": pa.array([max(l) for l in links], pa.int64())})


def _across(left: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that connect all classes which links between the given texts connect; left: id, class, family.

    Texts that can be links share a prefix cell. The texts of a family, those of its first class and the others
    apart, are dealt out in blocks of about BLOCK. Two blocks in which texts of different classes hold the same
    prefix cell are compared as a whole in one task, from the cells, so every pair is looked at once however many
    cells it shares, and what is joined are blocks.
    """
    first = left.select(F.col("id").alias("family"), F.col("class").alias("_c"))
    named = left.join(first, "family", "left").withColumn("own", F.coalesce(F.col("class") == F.col("_c"), F.lit(False))).drop("_c")
    rows = materialize(_ordered(texts.join(left.select("id"), "id")).join(named, "id"), "cells")
    sizes = rows.groupBy("family", "own").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.length("cells")) / (8 * BLOCK_CELLS))).alias("n"))
    seat = F.xxhash64("family", "own", F.pmod(F.xxhash64("id"), F.col("n")))
    rows = rows.join(sizes, ["family", "own"]).select("id", "class", "cells", "prefix", seat.alias("block"))
    held = rows.select("block", "class", F.explode("prefix").alias("cell")).groupBy("cell", "block").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    held = materialize(held, "held")
    p, q = (held.select("cell", F.struct("block", "low", "high").alias(name)) for name in "pq")
    several = (F.col("p.low") != F.col("q.high")) | (F.col("p.high") != F.col("q.low"))
    meet = p.join(q, "cell").where((F.col("p.block") < F.col("q.block")) & several).select(F.col("p.block").alias("x"), F.col("q.block").alias("y")).distinct()
    within = held.where("low <> high").select(F.col("block").alias("x"), F.col("block").alias("y")).distinct()
    meet = materialize(meet.unionByName(within), "meet")
    sides = F.explode(F.array(F.struct(F.col("x").alias("block"), F.lit(False).alias("other")), F.struct(F.col("y").alias("block"), F.lit(True).alias("other"))))
    seats = materialize(meet.select("x", "y", sides.alias("s")).select("x", "y", "s.block", "s.other").where("x <> y or not other"), "seats")
    return rows.drop("prefix").join(small(seats, BROADCAST_BLOCKS), "block").groupBy("x", "y").applyInArrow(_forest, "a bigint, b bigint")


def _folded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return dart.cells([t.encode("utf-8", "surrogatepass").lower() for t in batch.column(1).to_pylist()])


def _slots(cell: np.ndarray) -> np.ndarray:
    return (cell % np.uint64(SLOTS)).astype(np.int64)


def _links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, class) of the nodes that have links; members: (v, n, node) of every bucket of two or more.

    node is (id, sketch). The leader of a bucket is the node whose buckets hold most members: the text that
    the others are copies of, if it is there. Every node is compared with the first of its leaders, then with
    those of another class. What they leave in different classes is compared pair by pair in buckets of FEW
    members or fewer. The nodes of larger ones are dealt out again by side bands, where each is compared with the
    leader and with SEATS nodes of other classes picked by a hash, or with all others where they are few. All
    pairs of different classes that are left then, and whose texts can be links at all, share a rare cell; they
    are compared block by block (see _across). So no link within a bucket is left out, and no pair is a row there.
    """
    def compared(pairs: DataFrame) -> DataFrame:
        return _verified(pairs.select(F.least("p.id", "q.id").alias("a"), F.greatest("p.id", "q.id").alias("b")).distinct(), texts)

    def met(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        """Pairs of nodes of different classes that share a key; left: key, node, class; right: key, node, class."""
        one = left.select(F.col(key).alias("k"), F.col("node").alias("p"), F.col("class").alias("cp"))
        two = right.select(F.col(key).alias("w"), F.col("node").alias("q"), F.col("class").alias("cq"))
        return one.join(two, (F.col("k") == F.col("w")) & (F.col("cp") != F.col("cq")) & _alike(F.col("p"), F.col("q"))).select("p", "q")

    def others(rows: DataFrame, key: str) -> DataFrame:
        """All pairs, from one side."""
        return met(rows, rows, key).where("p.id < q.id")

    def still_open(rows: DataFrame, state: DataFrame) -> DataFrame:
        """The rows (v, n, node) of buckets that hold several classes, with the class of the node."""
        placed = rows.join(state, F.col("node.id") == F.col("id"), "left").select("v", "n", "node", F.coalesce("class", "node.id").alias("class"))
        several = placed.groupBy("v").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("v")
        return placed.join(several, "v")

    weight = materialize(members.groupBy(F.col("node.id").alias("id")).agg(F.sum("n").alias("w")), "weights")
    heads = members.join(weight, F.col("node.id") == F.col("id")).groupBy("v").agg(F.max_by("node", F.struct("w", "id")).alias("p"), F.max("w").alias("w"))
    led = members.join(heads, "v").withColumn("q", F.col("node")).where("p.id <> q.id").where(_alike(F.col("p"), F.col("q")))
    led = materialize(led.groupBy(F.col("p.id").alias("a"), F.col("q.id").alias("b")).agg(F.max("w").alias("w")), "led")
    state = _merged(None, _verified(led.groupBy("b").agg(F.max_by("a", F.struct("w", "a")).alias("a")).select("a", "b"), texts))
    known = state.select(F.col("id").alias("i"), F.col("class").alias("c"))
    rest = led.join(known, F.col("a") == F.col("i"), "left").select("a", "b", F.coalesce("c", "a").alias("ca"))
    rest = rest.join(known, F.col("b") == F.col("i"), "left").where(F.col("ca") != F.coalesce("c", "b"))
    state = _merged(state, _verified(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), texts))
    mine = materialize(still_open(members, state), "mine")
    state = _merged(state, compared(others(mine.where(F.col("n") <= FEW), "v")))
    mine = materialize(still_open(mine.where(F.col("n") > FEW).select("v", "n", "node"), state), "mine")  # a bucket of one class stays so
    if mine.isEmpty():
        return state
    crowded = mine.select("v", F.col("node.id").alias("id")).join(weight, "id")
    tops = crowded.groupBy("v").agg(F.max(F.struct("w", "id")).alias("h"))
    family = crowded.join(tops, "v").groupBy("id").agg(F.max("h").getField("id").alias("family"))
    many = materialize(mine.select("node", "class", F.col("node.id").alias("id")).dropDuplicates(["id"]).join(weight, "id").join(family, "id"), "many")
    dealt = many.select("node", "class", "w", F.explode(_side_bands("node")).alias("u"))
    shared = dealt.groupBy("u").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("u", "n")
    dealt = materialize(dealt.join(shared, "u"), "dealt")
    crowd = dealt.where(F.col("n") > FEW)
    named = F.struct("node", "class")
    first = crowd.groupBy("u").agg(F.max_by(named, F.struct("w", "node.id")).alias("h"))
    seats = crowd.groupBy("u", F.pmod(F.xxhash64("node.id"), F.lit(SEATS)).alias("seat")).agg(
        F.min_by(named, F.xxhash64("node.id", "u")).alias("h")).drop("seat")
    pairs = met(crowd, first.unionByName(seats).select("u", "h.node", "h.class"), "u").unionByName(others(dealt.where(F.col("n") <= FEW), "u"))
    state = _merged(state, compared(pairs))
    left = many.select("id", "family").join(state, "id", "left").select("id", "family", F.coalesce("class", "id").alias("class"))
    return _merged(state, _across(materialize(left, "left"), texts))


def classes(docs: DataFrame) -> DataFrame:
    """(key, copies, first, class_id, main) of every distinct text.

    copies: rows that hold it; first: their smallest doc_id; class_id: the smallest doc_id of all texts of its
    class; main: whether the text stands for its class (the one with that doc_id, of equal ids the smallest key).
    Null counts as empty; texts without words are alike only if equal. Repeated ids are kept apart by their
    texts; a null id names a class only if it has no other.
    """
    marks = _MARKS
    bands = [f"b{i}" for i in range(dart.BANDS)]
    nodes = _sign(docs).groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"), *[F.min(c).alias(c) for c in marks + bands])
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    in_band = nodes.where("b0 is not null").select("id", F.explode(F.array(*bands)).alias("v"))
    shared = in_band.groupBy("v").agg(F.count("*").alias("n")).where("n > 1")
    found = materialize(in_band.join(shared, "v"), "found")
    chosen = materialize(found.select("id").distinct().join(nodes.select("id", "key", "first", *marks), "id"), "chosen")
    n = chosen.count()
    alone = nodes.select("id", "key", "copies", "first")
    if not n:
        return alone.select("key", "copies", "first", F.col("first").alias("class_id"), F.lit(True).alias("main"))
    wanted = chosen.select("id", F.col("key").alias("k"), F.col("first").alias("f"))
    rows = need(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    texts = rows.join(_small(wanted, n), (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("f"))).select("id", "text")
    texts = materialize(texts.dropDuplicates(["id"]), "texts")
    members = materialize(found.join(chosen.select("id", F.struct("id", *marks).alias("node")), "id").select("v", "n", "node"), "members")
    state = _links(members, texts)
    linked = state.join(alone, "id")
    names = linked.groupBy("class").agg(F.min("first").alias("class_id"), F.min(F.struct(F.col("first").isNull(), "first", "key")).alias("m"))
    named = linked.join(names, "class").select(F.col("id").alias("i"), "class_id", (F.col("m.key") == F.col("key")).alias("main"))
    return alone.join(named, F.col("id") == F.col("i"), "left").select(
        "key", "copies", "first", F.when(F.col("i").isNull(), F.col("first")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("main", F.lit(True)).alias("main"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every document (see classes)."""
    named = classes(docs).select("key", "class_id")
    return need(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("key")).join(named, "key").select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of every class, the one with the smallest doc_id; all columns stay as they are.

    Of rows that are the same in id and text one stays.
    """
    found = classes(docs).where("copies > 1 or not main")
    key = free_name(docs, "__key")
    touched = found.select(F.col("key").alias(key), F.col("first").alias(f"{key}_first"), F.col("main").alias(f"{key}_main"))
    rows = docs.withColumn(key, text_key(F.col("text"))).join(touched, key, "left")
    kept = rows.where(F.col(f"{key}_main").isNull() | (F.col(f"{key}_main") & F.col("doc_id").eqNullSafe(F.col(f"{key}_first"))))
    if not _keys(docs).groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        kept = kept.withColumn(f"{key}_n", F.row_number().over(Window.partitionBy("doc_id", key).orderBy("doc_id"))).where(F.col(f"{key}_n") == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def _keys(docs: DataFrame) -> DataFrame:
    return need(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("key"))
