"""SentencePiece encoding and decoding with a distinct-chunk table.

The model marks a space as U+2581. When no piece holds a mark after another
character, no merge can cross from a word to the mark of the next one, so the
marked text splits into chunks (marks, then other characters) that the model
segments independently. Each task keeps a table of the distinct chunks it has
met, has the library segment each of them once, and joins the ids back to the
chunks by position. A table per task needs no shuffle; a table for the whole
corpus would have to send every occurrence of every word to its row and back.

A null text counts as empty, an empty text has no ids, repeated rows and
repeated or null doc_ids give one row each, further columns are not read, and an
empty table gives an empty result. Texts are taken whole at any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from probscope.llm.common import slices, whole_texts

MARK = "▁"
#: Bytes of text whose chunks and ids are held as Python objects at once, many times that size.
SLICE = 1 << 18


def chunks_are_closed(processor) -> bool:
    """Whether no piece of the model holds a mark after another character and the
    normaliser maps nothing but the space (checked on samples of what usual ones map)."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return False
    sample = "a  B\tc ﬁ①　é "
    return processor.decode(processor.encode(sample)) == sample


class ChunkTable:
    """Distinct marked chunk -> ids. ``size`` bounds the entries held at once; a full table starts anew."""

    def __init__(self, processor, size: int):
        import re
        self.processor, self.size = processor, size
        self.split = re.compile(f"{MARK}+[^{MARK}]*").findall
        self.closed = chunks_are_closed(processor)
        self.table: dict[str, tuple[int, ...]] = {}
        self.number = list(range(processor.get_piece_size())).__getitem__

    def segment(self, chunks: list[str]) -> None:
        # the library puts one mark before what it is given; a tuple of shared numbers is smaller than a list of new ones
        for chunk, ids in zip(chunks, self.processor.encode([c[1:] for c in chunks], num_threads=1)):
            self.table[chunk] = tuple(map(self.number, ids if chunk != MARK else [self.processor.piece_to_id(MARK)]))

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not self.closed:
            return self.processor.encode(texts, num_threads=1)
        split = [self.split(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        found = set(chain.from_iterable(split))
        if len(self.table) + len(found) > self.size:
            self.table.clear()
        self.segment([c for c in found if c not in self.table])
        ids = self.table.__getitem__
        return [list(chain.from_iterable(map(ids, chunks))) for chunks in split]


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False, table_size: int = 200_000) -> DataFrame:
    """(doc_id, ids), and with ``decoded`` also ``decoded``, the library's decode of these ids.

    ``model_path`` is read on the executors, where the tokenizer files are installed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        table = ChunkTable(processor, table_size)
        for batch in slices(batches, max_bytes=SLICE):
            ids = table.encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))]
            names = ["doc_id", "ids"]
            if decoded:
                columns.append(pa.array(processor.decode(ids), pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    return whole_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the library's decode of each row's ids; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            texts = [processor.decode(ids) if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{ids_col}` ids").mapInArrow(
        run, "doc_id long, text string")
