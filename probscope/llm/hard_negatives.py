"""Hard-negative mining: scores of anchors against all rows by Strassen's multiplication of integer tiles.

Vectors are integers, each component x of the input being floor(256 * x). A row's score is its inner product
with an anchor; larger scores come first, ties by the smaller id. The ``positives`` of an anchor are its first
rows of its own label; its negatives, for each positive, are the first rows of other labels whose score lies
in a window: low * positive score <= 100 * score <= 100 * positive score.

1. Anchors go to the tasks in blocks of at most ``BLOCK_CELLS`` numbers, the size of each block being counted
   first; all rows are read once for each block and pass, without a shuffle of vectors.
2. A task gathers its rows into tiles of ``TILE`` rows, in order of their ids. The scores of a block's anchors
   against a tile are one product of int64 matrices by Strassen's recursion: odd sides are padded with zeros,
   seven products stand for eight, down to ``LEAF``. Sums of int64 wrap, which is exact here, since every score
   itself fits (see below). Positives need the products of equal labels only, negatives all.
3. Each task keeps a heap of the first rows for each anchor (or anchor and positive) and merges every tile into
   it. The heaps of all tasks, a few rows each, are merged by a window per anchor (and positive).

Rows with a null id, label or vector, or a null or non-finite component, take no part, nor do rows of which the
sum of squares of the scaled components reaches 2^62: below that every score fits into 64 bits. Vectors of
different lengths are padded with zeros. Of rows with one id one takes part, the one with the smallest label, then the
smallest vector. Further columns are not read. An empty table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probscope.llm.common import written

#: Rows of a tile; smallest inner side that the recursion splits.
TILE, LEAF = 4096, 16
#: Numbers in the vectors of a block of anchors: 32 MB.
BLOCK_CELLS = 1 << 22
#: Anchors that are multiplied with a tile at once.
STRIP = 512
#: Ids that occur more than once are sent to every task up to this number, more are joined.
SENT = 1 << 20
LEAST = np.iinfo(np.int64).min


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by Strassen's recursion, exact modulo 2^64."""
    (m, d), n = a.shape, b.shape[1]
    if min(m, d, n) <= leaf:
        return a @ b
    if m % 2 or d % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, d % 2)))
        b = np.pad(b, ((0, d % 2), (0, n % 2)))
        return multiply(a, b, leaf)[:m, :n]
    i, j, k = m // 2, d // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    out = np.empty((m, n), np.int64)
    p = multiply(a11 + a22, b11 + b22, leaf)
    q = multiply(a21 + a22, b11, leaf)
    r = multiply(a11, b12 - b22, leaf)
    s = multiply(a22, b21 - b11, leaf)
    t = multiply(a11 + a12, b22, leaf)
    out[:i, :k] = p + s - t + multiply(a12 - a22, b21 + b22, leaf)
    out[:i, k:] = r + t
    out[i:, :k] = q + s
    out[i:, k:] = p - q + r + multiply(a21 - a11, b11 + b12, leaf)
    return out


def integers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of floor(256 * x), which rows take part) of a list column without null lists."""
    flat = vectors.flatten()
    sizes = np.diff(np.asarray(vectors.offsets))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    doc = np.repeat(np.arange(len(sizes)), sizes)
    bad = np.bincount(doc, ~np.isfinite(values), len(sizes)) > 0
    scaled = np.floor(256.0 * np.where(np.isfinite(values), values, 0.0))
    with np.errstate(over="ignore"):
        good = ~bad & (np.bincount(doc, scaled * scaled, len(sizes)) < 2.0 ** 62)
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    use = good[doc]
    matrix[doc[use], place[use]] = scaled[use].astype(np.int64)
    return matrix, good


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    """The matrix with columns of zeros up to ``width``."""
    return np.pad(matrix, ((0, 0), (0, max(width - matrix.shape[1], 0))))


def tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the rows that take part, up to ``TILE`` at a time, in order of id. Components beyond
    ``width`` meet zeros of every anchor and are left out."""
    ids, labels, vectors, n = [], [], [], 0

    def tile() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, lab, v = np.concatenate(ids), np.concatenate(labels), np.concatenate(vectors)
        order = np.argsort(i, kind="stable")
        return i[order], lab[order], v[order]

    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            matrix, good = integers(part.column("vector"))
            ids.append(part.column("id").to_numpy()[good])
            labels.append(part.column("label").to_numpy()[good])
            vectors.append(widened(matrix[good], width)[:, :width])
            n += int(good.sum())
            if n >= TILE:
                yield tile()
                ids, labels, vectors, n = [], [], [], 0
    if n:
        yield tile()


class Heaps:
    """The first ``k`` (score, id) of each of ``n`` groups, merged tile by tile."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), LEAST)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, groups: np.ndarray, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Takes in the allowed scores, a row for each of ``groups``, a column for each of ``ids``, which ascend."""
        masked = np.where(allowed, score, LEAST)
        k = min(self.k, masked.shape[1])
        # what the heap holds already bars lower scores; equal ones may still win by their ids
        bar = np.maximum(np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k], self.score[groups, -1])
        row = np.flatnonzero((masked.max(1) >= bar) & (masked.max(1) > LEAST))
        if not len(row):
            return
        masked, bar = masked[row], bar[row, None]
        equal = (masked == bar) & (masked > LEAST)
        chosen = (masked > bar) | equal & (np.cumsum(equal, axis=1) <= self.k)
        r, c = np.nonzero(chosen)
        g = groups[row]
        own = np.concatenate([np.repeat(np.arange(len(g)), self.k), r])
        s = np.concatenate([self.score[g].ravel(), masked[r, c]])
        i = np.concatenate([self.id[g].ravel(), ids[c]])
        order = np.lexsort((i, -np.maximum(s, LEAST + 1), own))  # LEAST would negate to itself
        begin = np.searchsorted(own[order], np.arange(len(g)))
        first = order[begin[:, None] + np.arange(self.k)]
        self.score[g], self.id[g] = s[first], i[first]


def unique_rows(rows: DataFrame) -> DataFrame:
    """Of rows with one id, the one with the smallest label, then vector. Only ids are shuffled for rows without
    such a partner."""
    again = written(rows.groupBy("id").count().where("count > 1").select("id"), "vectors-again")
    n = again.count()
    if not n:
        return rows
    again = F.broadcast(again) if n <= SENT else again
    one = (rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
           .select("id", "row.label", "row.vector"))
    return rows.join(again, "id", "left_anti").union(one)


def prepared(rows: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """(id, label, vector) of the rows that may take part."""
    usable = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                         F.col(vector_col).cast("array<double>").alias("vector"))
    usable = usable.where("id is not null and label is not null and vector is not null and "
                          "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    return unique_rows(usable)


def blocks(rows: DataFrame, anchor: Column) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the anchors, a bounded block at a time, in order of id."""
    anchors = written(rows.where(anchor), "anchors")
    width = anchors.agg(F.max(F.size("vector"))).first()[0]
    if not width:
        return
    most = max(BLOCK_CELLS // width, 1)
    parts = math.ceil(anchors.count() / most)
    while True:  # the size of every block is counted before any of them is fetched
        part = F.pmod(F.xxhash64("id"), F.lit(parts))
        if parts == 1 or anchors.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] <= most:
            break
        parts += parts // 4 + 1
    for k in range(parts):
        found = anchors.where(part == k).toArrow()
        if not found.num_rows:
            continue
        matrix, good = integers(found.column("vector").combine_chunks())
        ids = found.column("id").to_numpy()[good]
        order = np.argsort(ids)
        yield ids[order], found.column("label").to_numpy()[good][order], matrix[good][order]


def first_rows(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The heaps of all tasks merged: the first ``k`` rows of each group with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the first ``negatives`` rows in the
    window of each of the first ``positives`` of every row for which ``anchor``, an expression on ``id``, holds.
    ``low`` is the window's lower end in hundredths of the positive score."""
    rows = prepared(rows, id_col, F.col("label") if label is None else label, vector_col)
    spark = rows.sparkSession
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    found = None
    for ids, labels, vectors in blocks(rows, anchor):
        shared = spark.sparkContext.broadcast((ids, labels, vectors))  # BLOCK_CELLS numbers at most
        best = first_rows(rows.mapInArrow(positive_heaps(shared, positives), "anchor int, score long, id long"),
                          ["anchor"], positives)
        best = best.orderBy("anchor", "rank").toArrow()  # ``positives`` rows for each anchor of the block
        pairs = spark.sparkContext.broadcast(tuple(best.column(c).to_numpy() for c in ("anchor", "score", "id")))
        part = first_rows(rows.mapInArrow(window_heaps(shared, pairs, negatives, low),
                                          "anchor_id long, positive_id long, positive_score long, score long, id long"),
                          ["anchor_id", "positive_id"], negatives)
        part = written(part.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                                   F.col("id").alias("negative_id"), "positive_score",
                                   F.col("score").alias("negative_score")), "negatives")
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], columns) if found is None else found


def positive_heaps(shared, k: int):
    """A task's first ``k`` rows of the anchor's own label, for each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = shared.value
        heaps = Heaps(len(ids), k)
        of = {x: np.flatnonzero(labels == x) for x in np.unique(labels)}
        for cand, lab, v in tiles(batches, vectors.shape[1]):
            for x in np.unique(lab):
                own, mine = lab == x, of.get(x, np.zeros(0, int))
                other, columns = cand[own], np.ascontiguousarray(v[own].T)
                for at in range(0, len(mine), STRIP):
                    g = mine[at:at + STRIP]
                    heaps.add(g, multiply(vectors[g], columns), ids[g, None] != other[None], other)
        g, place = np.nonzero(heaps.score > LEAST)
        yield pa.RecordBatch.from_arrays([pa.array(g.astype(np.int32)), pa.array(heaps.score[g, place]),
                                          pa.array(heaps.id[g, place])], ["anchor", "score", "id"])

    return run


def window_heaps(shared, pairs, k: int, low: int):
    """A task's first ``k`` rows of other labels in the window of each pair of anchor and positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = shared.value
        of, pair_score, positive = pairs.value
        heaps = Heaps(len(of), k)
        # the lowest score of a window: the least whole number of which 100 times is no less than low * score
        least = np.array([-(-low * int(s) // 100) for s in pair_score], np.int64)
        for cand, lab, v in tiles(batches, vectors.shape[1]):
            columns = np.ascontiguousarray(v.T)
            for at in range(0, len(ids), STRIP):
                score = multiply(vectors[at:at + STRIP], columns)
                other = labels[at:at + STRIP, None] != lab[None]
                lo, hi = np.searchsorted(of, [at, at + STRIP])
                # pairs of one place among their anchor's positives at a time: an anchor occurs in each once
                place = np.arange(lo, hi) - np.searchsorted(of, of[lo:hi])
                for p in range(int(place.max(initial=-1)) + 1):
                    g = np.arange(lo, hi)[place == p]
                    s = score[of[g] - at]
                    heaps.add(g, s, other[of[g] - at] & (s >= least[g, None]) & (s <= pair_score[g, None]), cand)
        g, place = np.nonzero(heaps.score > LEAST)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[of[g]]), pa.array(positive[g]), pa.array(pair_score[g]), pa.array(heaps.score[g, place]),
             pa.array(heaps.id[g, place])], ["anchor_id", "positive_id", "positive_score", "score", "id"])

    return run
