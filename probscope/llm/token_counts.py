"""Token counts as delta-maintained rollups.

Changes to documents come in batches: inserts, deletes, and revisions with the count before and
after. A batch becomes signed rows, which add up to one row per (source, language,
tokenizer version); the totals are the sum over all batches, so that no batch reads more
than its own changes. A batch is committed whole or not at all (``sources.commits``); the last commit of a batch
counts, in place of any earlier one, also if it is empty: committing it again, after a lost driver or a repeated
delivery, changes nothing. One writer commits at a time.

A null text has no tokens, a null source or language is a group like any other, rows with equal
ids count one by one, further columns are not read. An empty batch commits no rows, empty
tables give an empty rollup, and so does a path without any commit. Groups whose totals are all zero are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.llm.common import slices
from probscope.sources import commits

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens", "n_chars"]
DELTA = "batch_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
WORDS = "words-1"


def counted(docs: DataFrame, bpe: dict[str, tuple[str, str]], text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens, n_chars): a row for each document and tokenizer version: the words
    between ASCII white space, and each of ``bpe``, name -> (file of ranks, pattern of its words)."""
    texts = docs.select("doc_id", "source", "lang", F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = [WORDS, *bpe]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken
        encoders = []
        for name, (path, pattern) in bpe.items():
            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            encoders.append(tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            counts = [[len(t.encode().split()) for t in texts]]
            counts += [[len(e.encode_ordinary(t)) for t in texts] for e in encoders]
            rest = [batch.column(c) for c in ("doc_id", "source", "lang")]
            for name, n in zip(names, counts):
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([name] * len(n)), pa.array(n, pa.int64()), pa.array(map(len, texts), pa.int64())],
                    ["doc_id", "source", "lang", "tokenizer", "n_tokens", "n_chars"])

    return texts.mapInArrow(run, "doc_id long, source string, lang string, tokenizer string, n_tokens long, n_chars long")


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Counted documents that come in (1) or go out (-1); a revision is the old count out and the new one in."""
    return rows.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (F.col("n_tokens") * sign).alias("n_tokens"),
                       (F.col("n_chars") * sign).alias("n_chars"))


def commit(changes: DataFrame, path: str, batch_id: int) -> None:
    """Adds a batch of signed rows to the rollup in ``path``, in place of any earlier commit of this batch."""
    folder = commits.new_folder()
    sums = changes.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    sums.withColumn("batch_id", F.lit(batch_id).cast("long")).write.parquet(commits.folder_path(path, "data", folder))
    commits.record(changes.sparkSession, path, batch_id, folder)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The sums of all committed batches by source, language and tokenizer version."""
    rows = commits.committed(spark, path, "data", DELTA).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return rows.where(" or ".join(f"{c} != 0" for c in SUMS))


def compact(spark: SparkSession, path: str, target: str, batch_id: int) -> None:
    """The batches up to ``batch_id`` as one, and the later ones as they are, in the new folder ``target``."""
    rows = commits.committed(spark, path, "data", DELTA).withColumn("batch_id", F.greatest("batch_id", F.lit(batch_id)))
    merged = rows.groupBy("batch_id", *KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    for batch in sorted(r.batch_id for r in merged.select("batch_id").distinct().collect()):  # the later batches and one
        folder = commits.new_folder()
        merged.where(F.col("batch_id") == batch).write.parquet(commits.folder_path(target, "data", folder))
        commits.record(spark, target, batch, folder)
