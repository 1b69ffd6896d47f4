"""Gradient boosted trees: logistic loss, features cut at quantiles; from a small set, or from all rows of a frame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Booster:
    """Trees of ``depth`` levels, each a row (feature, cut, value) per node in heap order."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, cuts: int = 32, least: int = 5):
        self.n, self.depth, self.rate, self.cuts, self.least = trees, depth, rate, cuts, least
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        share = (y.sum() + 1) / (len(y) + 2)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.cuts + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
        margin = np.full(len(y), self.start)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-margin))
            tree, node = self._grow(bins, edges, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += tree[2][node]
        return self

    def fit_frame(self, rows: DataFrame) -> Booster:
        """Trees from all rows of a frame: x (array of features), y (0 or 1), n (how many rows it stands for).

        The cuts are exact quantiles. Each level of a tree is one pass: the tasks add up gradients per (node, feature,
        bin) in whole units, whose sums depend on no order, and the sums, as many as nodes, features and bins, come to the driver."""
        at = [k / self.cuts for k in range(1, self.cuts)]
        first = rows.first()
        if first is None:
            return self
        width = len(first.x)
        cuts = rows.agg(F.sum(F.col("y") * F.col("n")).alias("ones"), F.sum("n").alias("all"),
                        *[F.percentile(F.col("x")[f], at, F.col("n")).alias(f"f{f}") for f in range(width)]).first()
        share = (cuts["ones"] + 1) / (cuts["all"] + 2)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.array(cuts[f"f{f}"], float)) for f in range(width)]
        for _ in range(self.n):
            self.trees.append(self._grow_frame(rows, edges))
        return self

    def _grow_frame(self, rows: DataFrame, edges: list[np.ndarray]):
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        for level in range(self.depth):
            nodes = range(2 ** level - 1, 2 ** (level + 1) - 1)
            sums = self._sums(rows, edges, (feature, cut), nodes)
            for k, (g, h, c) in zip(nodes, sums):
                total_g, total_h, total_c = g[0].sum(), h[0].sum(), c[0].sum()
                if level == 0:
                    value[k] = self.rate * total_g / (total_h + 1)
                best = 1e-6
                for f, e in enumerate(edges):
                    if total_c < 2 * self.least or not len(e):
                        continue
                    left_g, left_h, left_c = (np.cumsum(s[f][:len(e)]) for s in (g, h, c))
                    gain = left_g ** 2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1)
                    gain[(left_c < self.least) | (total_c - left_c < self.least)] = 0
                    gain -= total_g ** 2 / (total_h + 1)
                    if gain.max() > best:
                        i = gain.argmax()
                        best, feature[k], cut[k] = gain[i], f, e[i]
                        value[2 * k + 1] = self.rate * left_g[i] / (left_h[i] + 1)
                        value[2 * k + 2] = self.rate * (total_g - left_g[i]) / (total_h - left_h[i] + 1)
        return feature, cut, value

    def _sums(self, rows: DataFrame, edges: list[np.ndarray], tree, nodes: range) -> np.ndarray:
        """(node, gradient / hessian / rows, feature, bin) over all rows that reach a node."""
        bins, unit = max(len(e) for e in edges) + 1, float(1 << 24)
        cells, me = len(nodes) * len(edges) * bins, self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros((3, len(nodes), len(edges), bins))
            for batch in batches:
                n = batch.column("n").to_numpy()
                x = batch.column("x").flatten().to_numpy().reshape(len(n), len(edges))
                p = me.predict(x)
                sums = [np.rint((batch.column("y").to_numpy() - p) * unit) * n, np.rint(p * (1 - p) * unit) * n, n.astype(float)]
                node = np.zeros(len(n), np.int64)
                for _ in range(me.depth):
                    f = tree[0][node]
                    node = np.where(f >= 0, 2 * node + 1 + (x[np.arange(len(n)), f] > tree[1][node]), node)
                here = (node >= nodes.start) & (node < nodes.stop)
                for f, e in enumerate(edges):
                    slot = (node[here] - nodes.start) * bins + np.searchsorted(e, x[here, f], side="left")
                    for total, s in zip(found, sums):
                        total[:, f] += np.bincount(slot, s[here], len(nodes) * bins).reshape(len(nodes), bins)
            flat = found.reshape(3, cells)
            some = np.flatnonzero(flat[2])
            yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(flat[i][some].astype(np.int64)) for i in range(3))],
                                             ["cell", "g", "h", "c"])

        out = np.zeros((3, cells))
        added = rows.mapInArrow(run, "cell long, g long, h long, c long").groupBy("cell").agg(
            *[F.sum(c).alias(c) for c in "ghc"])
        for r in added.collect():
            out[:, r.cell] = r.g / unit, r.h / unit, r.c
        return out.reshape(3, len(nodes), len(edges), bins).swapaxes(0, 1)

    def _grow(self, bins, edges, gradient, hessian):
        size = 2 ** (self.depth + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        node = np.zeros(bins.shape[1], np.int64)
        for k in range(size):
            mine = node == k
            g, h = gradient[mine], hessian[mine]
            value[k] = self.rate * g.sum() / (h.sum() + 1)
            if 2 * k + 2 >= size or len(g) < 2 * self.least:
                continue
            best = 1e-6
            for f, e in enumerate(edges):
                b = bins[f, mine]
                left_g, left_h, left_n = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g, h, None))
                gain = left_g ** 2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1)
                gain[(left_n < self.least) | (len(g) - left_n < self.least)] = 0
                gain -= g.sum() ** 2 / (h.sum() + 1)
                if len(gain) and gain.max() > best:
                    best, feature[k], cut[k] = gain.max(), f, e[gain.argmax()]
            if feature[k] >= 0:
                right = bins[feature[k]] > np.searchsorted(edges[feature[k]], cut[k])
                node[mine] = np.where(right[mine], 2 * k + 2, 2 * k + 1)
        return (feature, cut, value), node

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        margin = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                down = 2 * node + 1 + (x[rows, f] > cut[node])
                node = np.where(f >= 0, down, node)
            margin += value[node]
        return 1 / (1 + np.exp(-margin))
