"""Substring dedup by hashes of lines and of the sentences in them.

Units are the lines of a text with ``LINE_WORDS`` words at least, and the sentences (up to
a full stop, question or exclamation mark before white space, or the line's end) with
``SENTENCE_WORDS`` at least, since a passage may begin and end within a line. From each shorter
sentence on, and up to it, as few neighbours as make so many words within the line are a unit, too (``joined``);
such units may overlap, and their common words count once in a passage. A unit is
normalised to its words, lower-cased, without punctuation and white space, and hashed to
128 bits. Of the units with one digest in all documents the one that ranks first (lowest id,
then first in the text) stays, the others are removed. Counting per digest is a
partial aggregate, and one row per digest is joined back, so that a line that a third
of the documents share costs no task more than others.

Every repeated unit goes. Units to remove that follow each other, with less than ``GAP`` characters between them, make
a passage, whose words come with each of them. A caller that wants common openings and one-line notices to stay
gives a least number of them, such as ``PASSAGE_WORDS``.

Spans keep the offsets of the original text, in code points, end exclusive; a sentence
within a removed line is part of the line's span. A null or empty text has no units;
rows with a null id are left as they are; rows with equal ids and texts are one
document, of which each keeps what the other keeps; rows with one id and several texts are
several documents, which rank by a hash of the text. Further columns are not read, and an
empty table gives an empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.llm.common import slices, whole_texts, written
from probscope.llm.shingles import BYTE, buffers, letters, mix, powers

LINE_WORDS = 5
SENTENCE_WORDS = 8
PASSAGE_WORDS = 20
GAP = 60

#: A document is an id with the hash of a text: rows with one id may hold several texts.
DOCUMENT = ["doc_id", "text_hash"]
UNITS = "doc_id long, text_hash long, d1 long, d2 long, start int, end int, n_words int, first int, again boolean"


def runs(sentence: np.ndarray, line: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first word, word after the last, both halves of the digest) of the runs of sentences around short ones:
    from each sentence of under ``SENTENCE_WORDS`` on, and up to it, as few as have so many words within the line."""
    at = np.append(np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1])), len(sentence))
    n = np.diff(at)
    short = np.flatnonzero(n < SENTENCE_WORDS)
    its = line[at[short]]
    on = np.searchsorted(at, at[short] + SENTENCE_WORDS)  # the sentence after the last one of the run
    upto = np.searchsorted(at, at[short + 1] - SENTENCE_WORDS, side="right") - 1
    a = np.concatenate([short, np.maximum(upto, 0)])
    b = np.concatenate([np.minimum(on, len(n)), short + 1])
    own = np.concatenate([its, its])
    keep = (line[at[a]] == own) & (line[at[b] - 1] == own) & (at[b] - at[a] >= SENTENCE_WORDS)
    # the run that is all of its line is the line
    words = np.bincount(line)
    keep &= at[b] - at[a] < words[own]
    pairs = np.unique(np.stack([at[a[keep]], at[b[keep]]], axis=1), axis=0)
    first, after = pairs[:, 0], pairs[:, 1]
    if not len(first):
        return first, after, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    m = after - first
    begin = np.append(0, np.cumsum(m)[:-1])
    place = np.arange(m.sum()) - np.repeat(begin, m)
    of = hashed[np.repeat(first, m) + place]
    power = powers(int(m.max()))[place]
    return (first, after, mix(np.add.reduceat(of * power, begin)),
            mix(np.add.reduceat(mix(of + np.uint64(1)) * power, begin) + m.astype(np.uint64)))


def unit_rows(texts: pa.Array, joined: bool = True) -> tuple[np.ndarray, ...]:
    """(text's number, both halves of the digest, start, end, words, place of the first word, whether the text had it
    before) of every unit."""
    data, offsets = buffers(texts)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int32, np.int32, np.int32, np.int32, bool))
    lower, word = letters(data)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    begin = np.flatnonzero(start)
    if not len(begin):
        return none
    inside = np.flatnonzero(word)
    at = np.searchsorted(inside, begin)
    length = np.diff(np.append(at, len(inside)))
    place = np.arange(len(inside)) - np.repeat(at, length)
    hashed = mix(np.add.reduceat(BYTE[lower[inside]] * powers(int(length.max()))[place], at))

    newline = data == 10
    white = newline | (data == 32) | (data == 9) | (data == 13)
    stop = (data == 46) | (data == 33) | (data == 63)
    stop[:-1] &= white[1:] | first[1:-1]
    breaks = first[:-1] | np.append(False, newline[:-1])  # a line begins here
    line = np.cumsum(breaks)
    sentence = np.cumsum(breaks | np.append(False, stop[:-1]))
    line_begin = np.append(np.flatnonzero(breaks), len(data))
    line_end = line_begin[1:] - newline[np.maximum(line_begin[1:] - 1, 0)]
    sentence_end = np.append(np.flatnonzero(breaks | np.append(False, stop[:-1])), len(data))[1:]
    point = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before each byte
    doc = np.searchsorted(offsets, begin, side="right") - 1

    def units(number: np.ndarray, least: int):
        change = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        n = np.diff(np.append(change, len(number)))
        place = np.arange(len(number)) - np.repeat(change, n)
        power = powers(int(n.max()))[place]
        d1 = mix(np.add.reduceat(hashed * power, change))
        d2 = mix(np.add.reduceat(mix(hashed + np.uint64(1)) * power, change) + n.astype(np.uint64))
        keep = n >= least
        return change[keep], n[keep], d1[keep], d2[keep]

    lines, n_line, a1, a2 = units(line[begin], LINE_WORDS)
    sents, n_sent, b1, b2 = units(sentence[begin], SENTENCE_WORDS)
    its_line, its_sent = line[begin[lines]] - 1, sentence[begin[sents]] - 1
    end = np.minimum(sentence_end[its_sent], line_end[line[begin[sents]] - 1])
    run, after, c1, c2 = (x[:None if joined else 0] for x in runs(sentence[begin], line[begin], hashed))
    run_end = np.minimum(sentence_end[sentence[begin[after - 1]] - 1], line_end[line[begin[run]] - 1])
    # a sentence that is all of its line is the line
    only = n_sent == np.bincount(line[begin])[line[begin[sents]]]
    sents, n_sent, b1, b2, end = (x[~only] for x in (sents, n_sent, b1, b2, end))
    number = np.concatenate([doc[lines], doc[sents], doc[run]])
    d1, d2 = np.concatenate([a1, b1, c1]), np.concatenate([a2, b2, c2])
    starts = np.concatenate([line_begin[its_line], begin[sents], begin[run]])
    ends = np.concatenate([line_end[its_line], end, run_end])
    place = np.concatenate([lines, sents, run]) - np.searchsorted(doc, number)
    base = point[offsets[number]]
    order = np.lexsort((starts, d2, d1, number))
    again = np.zeros(len(order), bool)
    again[order[1:]] = ((number[order][1:] == number[order][:-1]) & (d1[order][1:] == d1[order][:-1])
                        & (d2[order][1:] == d2[order][:-1]))
    return (number, d1, d2, point[starts] - base, point[ends] - base, np.concatenate([n_line, n_sent, after - run]),
            place, again)


def hashed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return whole_texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", joined: bool = True) -> DataFrame:
    """The units of every text; ``joined``: runs around short sentences as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
        for batch in slices(batches):
            number, d1, d2, *rest = unit_rows(batch.column("text"), joined)
            columns = [d1.view(np.int64), d2.view(np.int64), *rest]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(number)), batch.column("text_hash").take(pa.array(number)),
                 *(pa.array(c, k, safe=False) for c, k in zip(columns, kinds))],
                [x.split()[0] for x in UNITS.split(", ")])

    return hashed_texts(docs, id_col, text_col).mapInArrow(run, UNITS)


def stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", joined: bool = True) -> DataFrame:
    """(doc_id, start, end, n_words, kept_doc_id, passage_words, text_hash): a row per stretch to remove, where its first
    occurrence stays, the repeated words of the passage that it is part of, and the hash of the text that it is in."""
    rows = written(units(docs.where(F.col(id_col).isNotNull()), id_col, text_col, joined), "units")
    firsts = (rows.groupBy("d1", "d2").agg(F.min(F.struct(*DOCUMENT)).alias("kept"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    found = rows.join(firsts, ["d1", "d2"]).where("doc_id != kept.doc_id or text_hash != kept.text_hash or again")
    # all windows are over one document's repeated units
    of = f"partition by {', '.join(DOCUMENT)}"
    before = f"over ({of} order by start, end desc, n_words desc rows between unbounded preceding and 1 preceding)"
    outer = (found.select(*DOCUMENT, "start", "end", "n_words", "first", F.col("kept.doc_id").alias("kept_doc_id")).distinct()
             .withColumns({"upto": F.expr(f"max(end) {before}"), "upto_word": F.expr(f"max(first + n_words) {before}")})
             .where("upto is null or end > upto"))
    passage = F.expr(f"sum(if(upto is null or start - upto >= {GAP}, 1, 0)) over ({of} order by start)")
    words = F.expr(f"sum(first + n_words - greatest(first, upto_word)) over ({of}, passage)")
    return (outer.withColumn("passage", passage).withColumn("passage_words", words)
            .select("doc_id", "start", "end", "n_words", "kept_doc_id", "passage_words", "text_hash"))


def repeats(docs: DataFrame, passage_words: int = 0, id_col: str = "doc_id", text_col: str = "text",
            joined: bool = False) -> DataFrame:
    """(doc_id, start, end, n_words, kept_doc_id) of the stretches, of lines and sentences unless ``joined``, whose
    passage has ``passage_words`` at least."""
    rows = stretches(docs, id_col, text_col, joined)
    return rows.where(F.col("passage_words") >= passage_words).drop("passage_words", "text_hash")


def remove(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, removed): every text without its ``stretches``, and these as (start, end) of the original text."""
    texts = hashed_texts(docs, id_col, text_col)
    of = spans.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    rows = texts.join(of, DOCUMENT, "left").select("doc_id", "text", "removed")  # rows without an id have no spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
                parts, done = [], 0
                for span in removed or ():
                    if span["end"] > done:
                        parts.append(text[done:max(span["start"], done)])
                        done = span["end"]
                out.append("".join([*parts, text[done:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.string()), batch.column("removed")],
                ["doc_id", "text", "removed"])

    return rows.mapInArrow(run, "doc_id long, text string, removed array<struct<start:int,end:int>>")


def dedupe(docs: DataFrame, passage_words: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, text, removed) of every row after substring dedup."""
    spans = stretches(docs, id_col, text_col).where(F.col("passage_words") >= passage_words)
    return remove(docs, spans, id_col, text_col)
