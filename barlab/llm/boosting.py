"""Gradient-boosted trees for a yes/no label: of arrays, or of all rows of a table.

A tree only needs sums of gradients per node, feature and bin. Over a table every task sums up its rows and the
driver adds up one histogram per task, whatever the number of rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BINS = 32
TASK_ROWS = 100_000  # binned rows of one task
LOCAL_ROWS = 20_000  # as many are summed up in place, by the same code
UNIT = 2.0 ** 24  # gradients are summed in whole numbers of 1 / UNIT, so their order does not matter
CELLS = 10_000  # thresholds tried


class Boosted:
    """Depth-limited trees on quantile bins, logistic loss, Newton leaves."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge
        self.start = 0.0
        self.grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "Boosted":
        x = np.asarray(x, float)
        w = np.ones(len(y)) if weight is None else np.asarray(weight, float)
        cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
        binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], 1)
        share = np.clip(np.average(y, weights=w), 1e-6, 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        raw = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = w * (p - y), w * p * (1 - p) + 1e-9
            raw += self._grow(binned, cuts, grad, hess)
        return self

    def _grow(self, binned, cuts, grad, hess) -> np.ndarray:
        n_nodes = 2 ** self.depth - 1
        feature, cut, value = np.full(n_nodes, -1), np.zeros(n_nodes), np.zeros(2 * n_nodes + 1)
        node = np.zeros(len(grad), int)
        for at in range(n_nodes):
            rows = np.flatnonzero(node == at)
            if not len(rows):
                continue
            g, h = grad[rows], hess[rows]
            best, whole = 1e-6, g.sum() ** 2 / (h.sum() + self.ridge)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
                gain = gl ** 2 / (hl + self.ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.ridge) - whole
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, feature[at], cut[at] = gain[k], f, c[k]
                    split = k
            if feature[at] < 0:
                value[at] = -self.rate * g.sum() / (h.sum() + self.ridge)
                continue
            right = binned[rows, feature[at]] > split
            node[rows] = 2 * at + 1 + right
        for leaf in range(n_nodes, 2 * n_nodes + 1):
            rows = node == leaf
            if rows.any():
                value[leaf] = -self.rate * grad[rows].sum() / (hess[rows].sum() + self.ridge)
        self.grown.append((feature, cut, value))
        return value[node]

    def raw(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.grown:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                inner = node < len(feature)
                f = np.where(inner, feature[np.minimum(node, len(feature) - 1)], -1)
                go = f >= 0
                right = x[rows, np.maximum(f, 0)] > cut[np.minimum(node, len(feature) - 1)]
                node = np.where(go, 2 * node + 1 + right, node)
            out += value[node]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def calibrated(scores: np.ndarray, truth: np.ndarray, precision: float, least: int, weight: np.ndarray | None = None) -> float:
    """The lowest score from which held-out precision stays at `precision`; infinite if none has `least` hits.

    With weights a score stands for so many rows, and truth is the number of hits among them.
    """
    order = np.argsort(-scores, kind="stable")
    s, t = scores[order], truth[order]
    hits = np.cumsum(t)
    rows = np.cumsum(np.ones(len(s)) if weight is None else weight[order])
    last_of_tie = np.append(s[1:] != s[:-1], True)
    fine = last_of_tie & (hits >= precision * rows) & (hits >= least)
    return float(s[np.flatnonzero(fine)[-1]]) if fine.any() else float("inf")


# --- of all rows of a table ---------------------------------------------------------------------------

def quantile_cuts(rows: DataFrame, width: int) -> list[np.ndarray]:
    """The bounds of the bins of every feature, exact quantiles over all rows; rows: x, an array of `width` numbers."""
    shares = [float(v) for v in np.linspace(0, 1, BINS + 1)[1:-1]]
    found = rows.agg(*[F.percentile(F.col("x")[i], shares).alias(f"c{i}") for i in range(width)]).first()
    return [np.unique(np.array(c if c is not None else [], float)) for c in found]


def binned(rows: DataFrame, cuts: list[np.ndarray], labels: list[str]) -> DataFrame:
    """(b, held, n, y): the bins of the features, the rows that have them and how many of each kind; rows: x, kind, held."""
    def run(batches):
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, len(cuts))
            b = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in b], pa.binary()), batch.column(1), batch.column(2)], names=["b", "kind", "held"])

    table = rows.select("x", "kind", "held").mapInArrow(run, "b binary, kind string, held boolean")
    return table.groupBy("b", "held").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.count_if(F.col("kind") == k) for k in labels]).alias("y"))


class _Block:
    """Binned rows with the scores the trees so far give them, one column per label."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, width: int):
        b = b"".join(batch.column("b").to_pylist())
        self.bins = np.frombuffer(b, np.uint8).reshape(-1, width).astype(np.int64)
        self.n = np.array(batch.column("n").to_pylist(), float)
        self.y = np.array(batch.column("y").to_pylist(), float).reshape(len(self.n), -1)
        self.raw: dict[int, np.ndarray] = {}
        self.done: dict[int, int] = {}

    def routed(self, tree, depth: int) -> np.ndarray:
        """The node of every row after `depth` steps; rows stay where a node is not split."""
        feature, split, _ = tree
        node, rows = np.zeros(len(self.n), np.int64), np.arange(len(self.n))
        for _ in range(depth):
            f = np.where(node < len(feature), feature[np.minimum(node, len(feature) - 1)], -1)
            right = self.bins[rows, np.maximum(f, 0)] > split[np.minimum(node, len(feature) - 1)]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def scores(self, k: int, start: float, trees: list, depth: int) -> np.ndarray:
        raw = self.raw.setdefault(k, np.full(len(self.n), start))
        for tree in trees[self.done.get(k, 0):]:
            raw += tree[2][self.routed(tree, depth)]
        self.done[k] = len(trees)
        return 1 / (1 + np.exp(-raw))

    def sums(self, grown: dict, level: int, depth: int) -> np.ndarray:
        """Gradients by label, first and second, node of the level, feature and bin, in whole units."""
        width, nodes = self.bins.shape[1], 2 ** level
        out = np.zeros((len(grown), 2, nodes * width * BINS))
        for i, (k, (start, trees, tree)) in enumerate(grown.items()):
            p = self.scores(k, start, trees, depth)
            at = self.routed(tree, level) - (nodes - 1)
            here = at >= 0
            place = ((at[here, None] * width + np.arange(width)) * BINS + self.bins[here]).ravel()
            for j, g in enumerate((self.n * p - self.y[:, k], self.n * (p * (1 - p) + 1e-9))):
                out[i, j] = np.bincount(place, np.repeat(np.rint(g[here] * UNIT), width), nodes * width * BINS)
        return out


def fit_all(table: DataFrame, cuts: list[np.ndarray], labels: list[int], trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> dict[int, Boosted]:
    """A model of each label, fitted on all rows of a written table (b, n, y) of binned rows (see `binned`).

    All labels grow a level of a tree in one pass over the table.
    """
    width, rows = len(cuts), table.count()
    if rows <= LOCAL_ROWS:
        block = _Block(table.select("b", "n", "y").toArrow(), width)

        def total(grown, level):
            return block.sums(grown, level, depth)
    else:
        spread = table.select("b", "n", "y").repartition(-(-rows // TASK_ROWS))

        def total(grown, level):
            def run(batches):
                mine = 0.0
                for batch in batches:
                    mine = mine + _Block(batch, width).sums(grown, level, depth)
                if not np.isscalar(mine):
                    yield pa.RecordBatch.from_arrays([pa.array([mine.tobytes()], pa.binary())], names=["s"])

            parts = spread.mapInArrow(run, "s binary").toLocalIterator()
            return sum(np.frombuffer(r["s"], float) for r in parts).reshape(len(grown), 2, -1)

    whole = table.agg(F.sum("n").alias("n"), *[F.sum(F.col("y")[k]).alias(f"y{k}") for k in labels]).first()
    share = {k: np.clip(whole[f"y{k}"] / whole["n"], 1e-6, 1 - 1e-6) for k in labels}
    start = {k: float(np.log(s / (1 - s))) for k, s in share.items()}
    done: dict[int, list] = {k: [] for k in labels}
    inner = 2 ** depth - 1
    for _ in range(trees):
        new = {k: (np.full(inner, -1), np.zeros(inner, np.int64), np.zeros(2 * inner + 1)) for k in labels}
        for level in range(depth):
            found = total({k: (start[k], done[k], new[k]) for k in labels}, level).reshape(len(labels), 2, 2 ** level, width, BINS) / UNIT
            for k, (first, second) in zip(labels, found):
                for at, (g, h) in enumerate(zip(first, second), 2 ** level - 1):
                    _split(new[k], at, g, h, cuts, rate, ridge)
        for k in labels:
            done[k].append(new[k])
    models = {}
    for k in labels:
        models[k] = Boosted(trees, depth, rate, ridge)
        models[k].start = start[k]
        models[k].grown = [(f, np.array([cuts[a][b] if a >= 0 else 0.0 for a, b in zip(f, s)]), v) for f, s, v in done[k]]
    return models


def _split(tree, at: int, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], rate: float, ridge: float) -> None:
    """Split a node by the sums of its rows per feature and bin, and give its children their values."""
    feature, split, value = tree
    g_all, h_all = g[0].sum(), h[0].sum()
    if not h_all:
        return
    best, whole = 1e-6, g_all ** 2 / (h_all + ridge)
    for f, c in enumerate(cuts):
        gl, hl = np.cumsum(g[f])[:len(c)], np.cumsum(h[f])[:len(c)]
        gain = gl ** 2 / (hl + ridge) + (g_all - gl) ** 2 / (h_all - hl + ridge) - whole
        if len(c) and gain.max() > best:
            i = int(np.argmax(gain))
            best, feature[at], split[at] = gain[i], f, i
            value[2 * at + 1], value[2 * at + 2] = -rate * gl[i] / (hl[i] + ridge), -rate * (g_all - gl[i]) / (h_all - hl[i] + ridge)
    if at == 0 and feature[0] < 0:
        value[0] = -rate * g_all / (h_all + ridge)


def held_cells(rows: DataFrame, models: dict[int, Boosted]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per model the scores of all held rows as lower bounds of CELLS cells, the hits and the rows of each; rows: x, label index k or -1."""
    edges = np.arange(CELLS + 1) / CELLS

    def run(batches):
        for batch in batches:
            x, kind = np.array(batch.column(0).to_pylist(), float), np.array(batch.column(1).to_pylist())
            for k, model in models.items():
                cell = np.searchsorted(edges, model.predict(x), side="right") - 1
                n = np.bincount(cell, minlength=CELLS + 1)
                hits = np.bincount(cell, kind == k, CELLS + 1)
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k)), pa.array(used), pa.array(hits[used].astype(np.int64)), pa.array(n[used])], names=["m", "cell", "y", "n"])

    found = rows.select("x", "k").mapInArrow(run, "m bigint, cell bigint, y bigint, n bigint")
    sums = found.groupBy("m", "cell").agg(F.sum("y").alias("y"), F.sum("n").alias("n")).collect()  # CELLS rows a model
    out = {}
    for k in models:
        mine = sorted((r["cell"], r["y"], r["n"]) for r in sums if r["m"] == k)
        cell, y, n = np.array(mine, float).reshape(-1, 3).T
        out[k] = (edges[cell.astype(int)], y, n)
    return out
