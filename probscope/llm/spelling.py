"""Spelling variants: words one edit apart by pivotal grams, grouped under their most frequent forms.

1. ``counted`` counts the words of all texts; a task adds up what it reads before anything is shuffled.
2. Bigrams are ordered by the number of words that hold them, rarest first (``order_table``: the ``GRAMS``
   most frequent ones, counted over all words; others come first of all, in code-point order). A word's prefix
   are its first three bigrams in this order, with all places of the last one. Two of them that do not overlap,
   of the least total number of words, are its pivots, by dynamic programming over their places.
3. One edit destroys at most one of two disjoint bigrams. So of two words one edit apart, the one whose prefix
   ends no later has a pivot that is in the other's prefix, at the same distance from the word's beginning
   or from its end: the edit is behind the bigram, or before it. That is the position limit; the text on the
   bigram's other side has to agree whole. Of the text on the edit's side, cut at its middle, one half agrees, too.
   ``keys`` hashes bigram, place, agreeing side and half into one number, and Spark joins pivots and prefixes
   on it, so that no list of a frequent bigram is in one task.
4. Joined pairs are verified by their edit distance.

A word's form is its near word with the largest count, if that is at least ``ratio`` times its own; its root is the
last word when forms are followed. Counts grow along that way, so it ends, after a few doublings.

Null and empty texts and texts without words give none; a null id is hashed as an empty text; repeated rows count
as often as they stand. Ties of the largest count go to the smallest word in code-point order. Further columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import slices, written
from probscope.llm.shingles import STEP, mix, powers

#: Least code points and occurrences of a word; how much more frequent a form is.
CHARS, COUNT, RATIO = 7, 2, 10
#: Bigrams of which the count is kept; 90 letters give 8100.
GRAMS = 1 << 16
#: Distinct words that a task adds up before it gives them on.
HELD = 200_000
#: Bytes of words that are handled at once.
BATCH = 1 << 17


def misspelled(doc_id: int | None, run: str) -> str:
    """The run, without one code point where 31 divides the crc32 of id and run."""
    h = zlib.crc32(b"%b:%b" % (b"" if doc_id is None else b"%d" % doc_id, run.encode()))
    if h % 31:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def counted(docs: DataFrame, variant: Callable[[int | None, str], str] | None = None, chars: int = CHARS,
            least: int = COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of words with at least ``chars`` code points and ``least`` occurrences. Words are runs of letters with
    A-Z lower-cased; ``variant`` may change the run of a document."""

    runs = re.compile(f"[a-zÀ-ÿ]{{{chars},}}")  # a longest run, since it takes all that follows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                # lower-casing bytes changes A-Z only
                for word, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    word = variant(doc_id, word) if variant else word
                    if len(word) >= chars:
                        found[word] += n
            if len(found) >= HELD:
                yield pa.RecordBatch.from_pydict({"word": list(found), "n": list(found.values())})
                found.clear()
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (rows.where("text is not null").mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def order_table(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(bigram, number of words that hold it) of the ``GRAMS`` most frequent bigrams, as two code points in one number,
    in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word"):
            w = Words(batch.column("word").to_pylist())
            at = np.flatnonzero(w.place < w.size[w.word] - 1)
            gram = (w.codes[at] << 21) | w.codes[at + 1]
            order = np.lexsort((w.word[at], gram))
            gram, word = gram[order], w.word[at][order]
            new = np.append(True, (gram[1:] != gram[:-1]) | (word[1:] != word[:-1]))[:len(gram)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(gram[new], return_counts=True)], ["gram", "n"])

    counts = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), "gram").limit(GRAMS).toArrow()
    gram, n = found.column("gram").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(gram)
    return (gram[order], n[order]) if len(gram) else (np.array([-1]), np.array([0]))


class Words:
    """The code points of a batch of words one after another, with hashes of all their beginnings and ends."""

    def __init__(self, words: list[str]):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.begin = np.cumsum(self.size) - self.size
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.word = np.repeat(np.arange(len(words)), self.size)
        self.place = np.arange(len(self.codes)) - self.begin[self.word]
        power, code = powers(int(self.size.max(initial=0))), mix(self.codes.astype(np.uint64) + np.uint64(1))
        zero = np.zeros(1, np.uint64)
        self.from_begin = np.cumsum(np.append(zero, code * power[self.place]))
        self.from_end = np.cumsum(np.append(zero, code * power[self.size[self.word] - 1 - self.place]))

    def first(self, word: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes of the first ``n`` code points."""
        return self.from_begin[self.begin[word] + n] - self.from_begin[self.begin[word]]

    def last(self, word: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Hashes of the last ``n`` code points."""
        end = self.begin[word] + self.size[word]
        return self.from_end[end] - self.from_end[end - n]


def prefixes(words: Words, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, count) of the first three bigrams of each word in the order, and of all that equal the third, by
    word and place. ``grams`` are the known bigrams in code-point order."""
    at = np.flatnonzero(words.place < words.size[words.word] - 1)
    word, gram = words.word[at], (words.codes[at] << 21) | words.codes[at + 1]
    found = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
    known = grams[found] == gram
    rank = np.empty(len(grams), np.int64)
    rank[np.lexsort((grams, counts))] = np.arange(len(grams))
    rank = np.where(known, (1 << 42) + rank[found], gram)  # unknown ones are rarer than all known
    order = np.lexsort((words.place[at], rank, word))
    word, place, rank, count = word[order], words.place[at][order], rank[order], np.where(known, counts[found], 0)[order]
    start = np.searchsorted(word, np.arange(len(words.size)))[word]
    keep = (np.arange(len(word)) - start < 3) | (rank == rank[start + 2])
    word, place, count = word[keep], place[keep], count[keep]
    order = np.lexsort((place, word))
    return word[order], place[order], count[order]


def pivots(word: np.ndarray, place: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, place) of two bigrams of each word's prefix that do not overlap, of the least total count: the best single
    one so far and the best pair so far, from place to place."""
    begin = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(word)))
    one = np.zeros((3, len(begin)), np.int64)  # best single ones up to the last, last but one and last but two place
    best, pair = np.full(len(begin), np.iinfo(np.int64).max), np.zeros((2, len(begin)), np.int64)
    for k in range(int(size.max(initial=0))):
        w = np.flatnonzero(size > k)
        i = begin[w] + k
        one[1:, w] = one[:-1, w]
        if k:
            apart = place[i - 1] <= place[i] - 2
            mate = np.where(apart, one[1, w], one[2, w])
            total = np.where(apart | (k > 1), count[mate] + count[i], best[w])
            better = total < best[w]
            best[w[better]] = total[better]
            pair[:, w[better]] = mate[better], i[better]
            one[0, w] = np.where(count[i] < count[one[1, w]], i, one[1, w])
        else:
            one[0, w] = i
    chosen = pair.T.ravel()
    return word[chosen], place[chosen]


def keys(words: Words, word: np.ndarray, place: np.ndarray, pivot: bool) -> tuple[np.ndarray, np.ndarray]:
    """(word, key) of bigrams: place, agreeing side with the bigram and agreeing half of the other side. The halves are
    those of the text that is there, for pivots those of any text whose length differs by one at most."""
    out = []
    for side, (same, other) in enumerate(((words.first, words.last), (words.last, words.first))):
        head = place + 2 if side == 0 else words.size[word] - place
        rest = words.size[word] - head
        for half in range(2):
            low = (rest - 1) // 2 if pivot and half == 0 else (rest + half * (not pivot)) // 2
            for n in (low, low + 1) if pivot else (low,):
                ok = (n >= 0) & (n <= rest)
                w, h, m = word[ok], head[ok], n[ok]
                text = same(w, h + m) if half == 0 else same(w, h) + mix(other(w, m))
                kind = (h * 4 + side * 2 + half).astype(np.uint64) * STEP + m.astype(np.uint64)
                out.append((w, mix(text ^ mix(kind))))
    return tuple(np.concatenate(x) for x in zip(*out))


def keyed(words: DataFrame, table, pivot: bool) -> DataFrame:
    """(key, word, n): a row for each key of a word's pivots or of its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = table.value
        for batch in slices(batches, "word", BATCH):
            w = Words(batch.column("word").to_pylist())
            word, place, count = prefixes(w, grams, counts)
            if pivot:
                word, place = pivots(word, place, count)
            row, key = keys(w, word, place, pivot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("word").take(pa.array(row)), batch.column("n").take(pa.array(row))],
                ["key", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all words one edit apart, both ways round. Words have four code points or more."""
    table = words.sparkSession.sparkContext.broadcast(order_table(words))  # GRAMS entries at most
    left = keyed(words, table, True)
    right = keyed(words, table, False).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = left.join(right, "key").where("word != near and abs(length(word) - length(near)) <= 1 and "
                                        "levenshtein(word, near, 1) = 1")
    names = ["word", "n", "near", "near_n"]
    ways = [F.struct(*[F.col(c).alias(x) for x, c in zip(names, order)]) for order in (names, [*names[2:], *names[:2]])]
    return met.select(F.explode(F.array(*ways)).alias("pair")).select("pair.*").distinct()


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of (word, n)."""
    none = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    first = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))))
    found = (near_pairs(words).union(none).groupBy("word")
             .agg(F.max("n").alias("n"), F.count("near").alias("n_near"), first.alias("first"))
             .withColumn("has", F.col("first").isNotNull() & (-F.col("first.less") >= ratio * F.col("n")))
             .select("word", "n", "n_near", F.when(F.col("has"), F.col("first.form")).alias("form"),
                     F.when(F.col("has"), -F.col("first.less")).alias("form_n")))
    found = written(found, "spelling-forms")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): each round follows the ways found so far, so that their length doubles."""
    ways = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("end"))
        now = written(ways.join(further, "root", "left")
                      .select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")),
                      "spelling-roots")
        ways = now.select("word", "root")
        if not now.where("moved").limit(1).count():
            return ways
