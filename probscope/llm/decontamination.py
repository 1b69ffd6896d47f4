"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are folded alike (lower case, runs of anything but
letters and digits to one space) and compared as bytes of UTF-8. An item is cut into windows
of ``WINDOW`` bytes, every ``STRIDE`` bytes; a document holds a window when some stretch of it
is within ``BUDGET`` edits per byte of the window. Half a stride costs fewer edits than the budget, so that
a stretch of ``WINDOW`` bytes that is copied whole is found wherever it begins. Such a stretch shares at
least ``WINDOW - Q + 1 - edits * Q`` q-grams with it, all on diagonals (position
in the document less position in the window) that lie within the edit budget of
each other. So per (document, window) the shared q-grams are counted in bands of
diagonals, twice as wide as needed and overlapping by half; regions that reach
the bound are verified by a banded alignment with free ends.

The items are the stated query set: they are numbered into blocks of at most ``BLOCK`` characters (or one
longer item), whose sizes are counted before any is fetched, and written to the shared folder; one block at a time is sent
to the tasks and reads the documents once. Nothing of a former block is kept but its regions.

Null and empty texts hold nothing. Items of under ``MIN_ITEM`` folded bytes,
empty and null ones among them, are too short to tell a leak and match nothing.
Equal items are reported each; repeated rows and null or equal ids likewise. Very
long texts are searched whole, in overlapping parts. Empty tables give an empty
result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import slices, whole_texts, written
from probscope.llm.shingles import letters

Q = 10
WINDOW = 80
STRIDE = 8
BUDGET = 0.075
MIN_ITEM = 12
#: Characters of items in a block, and bytes of text that are searched at a time.
BLOCK = 1 << 21
PART = 1 << 20
#: Bands that are aligned at once.
ALIGNED = 4096

RESULT = "doc_id long, item_id long, start int, end int, edits int, shared_qgrams int"


def fold(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes of UTF-8 ``data`` and where each came from."""
    lower, word = letters(data)
    keep = word.copy()
    keep[1:] |= word[:-1]
    at = np.flatnonzero(keep)
    return np.where(word, lower, 32)[at].astype(np.uint8), at


def qgrams(folded: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the q-grams (Q = 8 + 2, by doubling)."""
    if len(folded) < Q:
        return np.zeros(0, np.uint64)
    base = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    one = folded.astype(np.uint64) + np.uint64(1)
    two = one[:-1] * power(1) + one[1:]
    four = two[:-2] * power(2) + two[2:]
    eight = four[:-4] * power(4) + four[4:]
    return eight[:-2] * power(2) + two[8:]


class Block:
    """Windows of some items and the postings of their q-grams."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.windows: list[tuple[int, np.ndarray, int, int]] = []  # item's number, folded window, edits, bound
        self.ids = [i for i, _ in items]
        grams, owner, place = [], [], []
        for number, (_, text) in enumerate(items):
            folded, _ = fold(np.frombuffer(text, np.uint8))
            folded = folded[:-1] if len(folded) and folded[-1] == 32 else folded
            n = len(folded)
            if n < MIN_ITEM:
                continue
            width = min(n, WINDOW)
            edits = min(int(BUDGET * width), (width - Q) // Q)
            for start in sorted({*range(0, n - width, STRIDE), n - width}):
                window = folded[start:start + width]
                hashes = qgrams(window)
                grams.append(hashes)
                owner.append(np.full(len(hashes), len(self.windows)))
                place.append(np.arange(len(hashes)))
                self.windows.append((number, window, edits, width - Q + 1 - edits * Q))
        if self.windows:
            grams, owner, place = map(np.concatenate, (grams, owner, place))
            order = np.argsort(grams, kind="stable")
            self.owner, self.place = owner[order], place[order]
            self.grams, self.first = np.unique(grams[order], return_index=True)
            self.last = np.append(self.first[1:], len(order))
            self.seen = np.zeros(1 << 22, bool)
            self.seen[self.grams >> np.uint64(42)] = True
            self.edits = np.array([w[2] for w in self.windows])
            self.bound = np.array([w[3] for w in self.windows])

    def regions(self, folded: np.ndarray) -> tuple[np.ndarray, ...]:
        """(window, lowest diagonal of the band, shared q-grams) of the bands that reach the bound."""
        none = (np.zeros(0, np.int64),) * 3
        hashes = qgrams(folded)
        at = np.flatnonzero(self.seen[hashes >> np.uint64(42)])
        which = np.searchsorted(self.grams, hashes[at])
        which[which == len(self.grams)] = 0
        equal = self.grams[which] == hashes[at]
        at, which = at[equal], which[equal]
        if not len(at):
            return none
        n = self.last[which] - self.first[which]
        posting = np.repeat(self.first[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at, owner, place = np.repeat(at, n), self.owner[posting], self.place[posting]
        enough = np.bincount(owner, minlength=len(self.windows)) >= self.bound  # else no band can
        at, owner, place = (x[enough[owner]] for x in (at, owner, place))
        if not len(at):
            return none
        step = self.edits[owner] + 1
        band = (at - place + WINDOW) // step
        owner, place, band = np.tile(owner, 2), np.tile(place, 2), np.concatenate([band, band - 1])
        key = np.unique(((owner * (len(folded) + 2 * WINDOW + 2) + band + 1) * WINDOW) + place)  # each place once
        key, shared = np.unique(key // WINDOW, return_counts=True)
        owner, band = key // (len(folded) + 2 * WINDOW + 2), key % (len(folded) + 2 * WINDOW + 2) - 1
        good = shared >= self.bound[owner]
        owner, band, shared = owner[good], band[good], shared[good]
        return owner, band * (self.edits[owner] + 1) - WINDOW, shared

    def align(self, folded: np.ndarray, owners: np.ndarray, lowest: np.ndarray) -> tuple[np.ndarray, ...]:
        """(edits, start, end) of the best stretch near each band's diagonals, for windows of one length: rows of the
        window by diagonals, all windows and bands at once. A cell holds edits and start as one number."""
        windows = np.stack([self.windows[o][1] for o in owners])
        edits = int(self.edits[owners[0]])
        wide = 2 * (edits + 1) + 2 * edits
        padded = np.concatenate([np.zeros(2 * WINDOW, np.uint8), folded, np.zeros(2 * WINDOW, np.uint8)])
        origin = lowest - edits
        one = np.int64(1) << 40
        ramp = np.arange(wide, dtype=np.int64) * one
        start = origin[:, None] + np.arange(wide)
        cell = start + 2 * WINDOW
        for i in range(windows.shape[1]):
            j = np.clip(start + i + 2 * WINDOW, 0, len(padded) - 1)
            best = cell + (padded[j] != windows[:, i, None]) * one
            best[:, :-1] = np.minimum(best[:, :-1], cell[:, 1:] + one)
            cell = np.minimum.accumulate(best - ramp, axis=1) + ramp
        at = cell.argmin(1)
        best = cell[np.arange(len(lowest)), at]
        return best // one, best % one - 2 * WINDOW, origin + at + windows.shape[1]

    def search(self, data: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item's number, first byte, byte after the last, edits, shared q-grams) of the verified regions."""
        if not self.windows or len(data) < Q:
            return []
        folded, at = fold(data)
        owners, lowest, shared = self.regions(folded)
        found = []
        length = np.array([len(self.windows[o][1]) for o in owners])
        for n in np.unique(length):
            for mine in np.array_split(np.flatnonzero(length == n), -(-int((length == n).sum()) // ALIGNED)):
                edits, start, end = self.align(folded, owners[mine], lowest[mine])
                good = edits <= self.edits[owners[mine]]
                for o, e, a, b, c in zip(owners[mine][good], edits[good], start[good], end[good], shared[mine][good]):
                    a, b = max(int(a), 0), min(int(b), len(at))
                    found.append((self.windows[o][0], int(at[a]), int(at[b - 1]) + 1, int(e), int(c)))
        return found


def merged(found: list[tuple[int, int, int, int, int]]) -> list[list[int]]:
    """Windows of one item that touch become one region: edits of the best window, most shared q-grams."""
    out: list[list[int]] = []
    for item, a, b, edits, shared in sorted(found):
        if out and out[-1][0] == item and a <= out[-1][2] + 2 * WINDOW:
            last = out[-1]
            last[2:] = [max(last[2], b), min(last[3], edits), max(last[4], shared)]
        else:
            out.append([item, a, b, edits, shared])
    return out


def find(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per region of a document that holds part of an item; offsets in code points, end exclusive."""
    texts = whole_texts(docs, id_col, text_col)
    items, n = blocks(benchmark, item_id_col, item_text_col)
    if n == 1:
        return _find_block(texts, fetched(items, 0))
    return reduce(DataFrame.unionAll, [written(_find_block(texts, fetched(items, k)), "regions") for k in range(n)])


def clean(docs: DataFrame, benchmark: DataFrame, *, keep: Sequence[str] = (), id_col: str = "doc_id",
          text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, text) and the columns ``keep`` of the documents without any region, in one pass for each block."""
    texts = whole_texts(docs, id_col, text_col, keep)
    items, n = blocks(benchmark, item_id_col, item_text_col)
    if n == 1:
        return _clean_block(texts, fetched(items, 0))
    for k in range(n):
        texts = written(_clean_block(texts, fetched(items, k)), "clean")
    return texts


def blocks(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(item_id, text, block) of the items with a text, in the shared folder, and how many blocks there are."""
    items = written(benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
                    .where("text is not null"), "items")
    size = F.sum(F.length("text"))
    n = max(1, -(-(items.agg(size).first()[0] or 0) // BLOCK))
    while True:
        numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        over = numbered.groupBy("block").agg(size.alias("size"), F.min("text").alias("a"), F.max("text").alias("b"))
        # copies of one item cannot be parted, and need not: their windows are the same
        if n == 1 or not over.where((F.col("size") > BLOCK) & (F.col("a") != F.col("b"))).count():
            return numbered, n
        n += n // 2 + 1


def fetched(items: DataFrame, block: int) -> list[tuple[int | None, bytes]]:
    """The items of a block: ``BLOCK`` characters at most, or one item and its copies."""
    return [(r.item_id, r.text.encode()) for r in items.where(F.col("block") == block).select("item_id", "text").collect()]


def _search(block: Block, data: np.ndarray) -> list[list[int]]:
    """The regions of one text, which is searched in overlapping parts."""
    overlap = 8 * WINDOW
    found = [(item, a + begin, b + begin, e, n) for begin in range(0, max(len(data) - overlap, 1), PART)
             for item, a, b, e, n in block.search(data[begin:begin + PART + overlap])]
    return merged(found)


def _find_block(texts: DataFrame, items: list[tuple[int | None, bytes]]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(items)  # BLOCK characters at most, or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shared.value)
        for batch in slices(batches, max_bytes=PART):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").cast(pa.large_binary()).to_pylist()):
                data = np.frombuffer(text, np.uint8)
                if found := _search(block, data):
                    point = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before each byte
                    rows += [(doc_id, block.ids[item], int(point[a]), int(point[b]), e, n) for item, a, b, e, n in found]
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [x.split()[0] for x in RESULT.split(", ")])

    return texts.mapInArrow(run, RESULT)


def _clean_block(texts: DataFrame, items: list[tuple[int | None, bytes]]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(items)  # BLOCK characters at most, or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shared.value)
        for batch in slices(batches, max_bytes=PART):
            stay = [not _search(block, np.frombuffer(t, np.uint8))
                    for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield batch.filter(pa.array(stay, pa.bool_()))

    return texts.mapInArrow(run, texts.schema)
