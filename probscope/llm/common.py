"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.session import checkpoint_root, join_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return join_path(checkpoint_root(spark), f"llm-{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, text) and the columns ``keep`` of every row; a null text is an empty one. Other columns are not read."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *keep)


#: Bytes of a batch of rows on its way to a Python worker.
BATCH_BYTES = 2 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on this session sends rows to Python in batches of about ``BATCH_BYTES``, unless the caller has set a size.
    Spark's batches of 10,000 rows take memory by the length of the texts, in the executor's JVM, where a growing buffer
    is copied, and in the worker. Rows and results are the same."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def ddl(df: DataFrame, columns: Sequence[str]) -> str:
    """The named columns as a schema string."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema.fields)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        offsets = batch.column(column)
        sizes = pc.binary_length(offsets).to_pylist()
        begin, total = 0, 0
        for i, n in enumerate(sizes):
            total += n or 0
            if total >= max_bytes or i + 1 == len(sizes):
                yield batch.slice(begin, i + 1 - begin)
                begin, total = i + 1, 0
