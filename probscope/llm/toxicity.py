"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams of ``MIN_N`` to ``MAX_N`` characters of a document's lower-cased words, with
one space at either end, present or not, hashed to ``BINS``; a batch of texts is hashed at once.

1. Every labelled training document is counted: each task adds up, per bin, in
   how many toxic and other documents it occurs; the sums are one row per bin.
2. The log-count ratio r of a bin is ln of its smoothed share in toxic documents
   over that in others. Bins whose counts are not significantly different (root of
   the G statistic under ``MIN_Z``), or whose ratio is under ``MIN_RATIO`` either way, get no weight; at most
   ``FEATURES`` bins stay.
3. A logistic regression on r * presence is fitted on a bounded sample of
   labelled documents (``FIT_ROWS``, about that many by a hash of the id).
4. Every document is scored: the weights of its distinct bins are added up.

Null and empty texts have no features and get the intercept's score; null labels
are left out, of repeated labels of one id the largest counts; rows with equal or
null ids are scored one by one; further columns are not read. Without labels of
both classes every score is the smoothed share of label 1. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import slices, whole_texts, written
from probscope.llm.shingles import STEP, mix

MIN_N, MAX_N = 3, 5
BINS = 1 << 20
FEATURES = 1 << 13
MIN_Z = 4.0
MIN_RATIO = math.log(4)
#: About so many labelled documents are used to fit the weights; counts use all of them.
FIT_ROWS = 20_000
#: Labelled documents up to this many are sent to the tasks as (id, label), more are joined.
SENT = 1 << 20


ASCII_WORD = np.array([chr(c).isalnum() or c == 95 for c in range(128)])


def grams(texts: list[str], weight: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct bins of each text, of those with weight if ``weight`` is given."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join([*lowered, " "]).encode("utf-32-le"), np.uint32)
    end = np.cumsum([len(t) + 1 for t in lowered])
    word = ASCII_WORD[np.minimum(codes, 127)] | (codes > 127)
    codes = np.where(word, codes, 32).astype(np.uint64) + np.uint64(1)
    found, at = [], []
    h, inside = codes[:-1] * STEP + codes[1:], np.ones(len(codes), bool)
    for n in range(3, MAX_N + 1):  # a space may stand at the ends only
        h = h[:-1] * STEP + codes[n - 1:]
        inside = inside[:len(h)] & word[n - 2:n - 2 + len(h)]
        if n < MIN_N:
            continue
        place = np.flatnonzero(inside)
        bins = (mix(h[place] + np.uint64(n)) >> np.uint64(44)).astype(np.int64)
        if weight is not None:
            has = weight[bins] != 0
            place, bins = place[has], bins[has]
        found.append(bins)
        at.append(place)
    out = []
    cuts = [np.searchsorted(p, end - 1) for p in at]
    begin = [0] * len(at)
    for i in range(len(texts)):
        out.append(np.unique(np.concatenate([b[a:c[i]] for b, a, c in zip(found, begin, cuts)])))
        begin = [c[i] for c in cuts]
    return out


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5, is 0; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def distinct_marks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from, the smallest id of each distinct
    text: copies of one document would make its ordinary n-grams look significant."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = written(marks, "toxic-labels")
    marks = F.broadcast(marks) if marks.count() <= SENT else marks
    return (whole_texts(docs).select("doc_id", F.xxhash64("text").alias("h")).join(marks, "doc_id")
            .groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
            .select("doc_id", "toxic"))


def with_texts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the marked rows."""
    return whole_texts(docs).where(~held_out(F.col("doc_id"))).join(marks, "doc_id").select("doc_id", "text", "toxic")


def count_bins(train: DataFrame) -> DataFrame:
    """(bin, other, toxic): documents of either label with the bin; bin -1 counts all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BINS + 1), np.int64)
        for batch in slices(batches):
            for bins, toxic in zip(grams(batch.column("text").to_pylist()), batch.column("toxic").to_pylist()):
                counts[toxic][bins] += 1
                counts[toxic][BINS] += 1
        used = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(used == BINS, -1, used)), pa.array(counts[0][used]), pa.array(counts[1][used])],
            ["bin", "other", "toxic"])

    return (train.select("text", "toxic").mapInArrow(run, "bin long, other long, toxic long")
            .groupBy("bin").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")))


def ratios(counts: DataFrame) -> tuple[dict[int, float], tuple[int, int]]:
    """r of the significant bins, at most ``FEATURES``, and the numbers of documents of either label."""
    total = counts.where("bin = -1").first()
    n = (total.other, total.toxic) if total else (0, 0)
    if not all(n):
        return {}, n
    p, q = (F.col("toxic") + 1) / F.lit(n[1] + 2.0), (F.col("other") + 1) / F.lit(n[0] + 2.0)
    r = F.log(p) - F.log(q)

    def part(observed: Column, share: float) -> Column:
        expected = (F.col("toxic") + F.col("other")) * share
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    z = F.sqrt(F.greatest(2 * (part(F.col("toxic"), n[1] / sum(n)) + part(F.col("other"), n[0] / sum(n))), F.lit(0.0)))
    rows = (counts.where("bin >= 0").select("bin", r.alias("r"), z.alias("z")).where((F.col("z") >= MIN_Z) & (F.abs("r") >= MIN_RATIO))
            .orderBy(F.desc("z"), "bin").limit(FEATURES).collect())
    return {row.bin: row.r for row in rows}, n


def fit(bins: np.ndarray, sizes: np.ndarray, y: np.ndarray, r: dict[int, float], share: float,
        steps: int = 300, l2: float = 1e-4, rate: float = 0.1) -> tuple[dict[int, float], float]:
    """Logistic regression on r * presence by steps that each weight scales by its past gradients:
    (weight of each bin, intercept). ``bins`` are the documents' one after another, ``sizes`` how many each has."""
    index = {b: i for i, b in enumerate(r)}
    scale = np.array(list(r.values()))
    places = np.zeros(BINS, np.int32)
    places[list(index)] = list(index.values())
    row, col = np.repeat(np.arange(len(y)), sizes), places[bins]
    value = scale[col] if len(col) else np.zeros(0)
    w, b = np.zeros(len(scale)), math.log(share / (1 - share))
    past_w, past_b = np.full(len(scale), 1e-8), 1e-8
    for _ in range(steps):
        margin = np.clip(np.bincount(row, value * w[col], len(y)) + b, -30, 30)
        error = (1 / (1 + np.exp(-margin)) - y) / len(y)
        slope_w, slope_b = np.bincount(col, value * error[row], len(scale)) + l2 * w, error.sum()
        past_w, past_b = past_w + slope_w ** 2, past_b + slope_b ** 2
        w, b = w - rate * slope_w / np.sqrt(past_w), b - rate * slope_b / math.sqrt(past_b)
    return {k: float(w[i] * scale[i]) for k, i in index.items()}, float(b)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[dict[int, float], float]:
    """The model: weight of each bin, intercept."""
    marks = written(distinct_marks(docs, labels), "toxic-marks")
    marks = F.broadcast(marks) if marks.count() <= SENT else marks
    r, n = ratios(written(count_bins(with_texts(docs, marks)), "toxic-counts"))
    share = (n[1] + 1) / (sum(n) + 2)
    if not r:
        return {}, math.log(share / (1 - share))
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000))
    part = marks.where(chosen < math.ceil(1_000_000 * min(1.0, fit_rows / sum(n))))
    weight = np.zeros(BINS, np.float32)
    weight[list(r)] = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = grams(batch.column("text").to_pylist(), weight)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column("toxic")],
                                             ["bins", "toxic"])

    # about fit_rows rows: its size does not grow with the input
    sample = with_texts(docs, F.broadcast(part)).mapInArrow(run, "bins array<int>, toxic int").toArrow()
    bins = sample.column("bins").combine_chunks()
    return fit(np.array(bins.flatten()), np.diff(np.array(bins.offsets)), np.array(sample.column("toxic"), float),
               r, share)


def score(docs: DataFrame, model: tuple[dict[int, float], float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, score): the probability of label 1 for every row."""
    weights, intercept = model
    weight = np.zeros(BINS, np.float32)
    weight[list(weights)] = list(weights.values())
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # BINS floats at any size of the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in slices(batches):
            margins = [intercept + w[b].sum(dtype=float) for b in grams(batch.column("text").to_pylist(), w)]
            p = 1 / (1 + np.exp(-np.clip(np.array(margins), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    return whole_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
