"""Batches of rows committed once per batch id, on shared storage, without a transaction manager.

A commit writes its rows into new folders and only then one row to ``<root>/log``: batch id, version, folder
name. A reader takes the folders that the log names, the latest version of each batch, so it sees all of
a commit or nothing; folders that a lost driver has left are in no row of the log and never read. The log
holds one row per commit. One writer commits at a time; readers need no lock.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probscope.session import join_path

LOG = "batch_id long, version long, folder string"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet rows under ``path``; none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def log(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, version, folder) of every commit."""
    return _read(spark, join_path(root, "log"), LOG)


def new_folder() -> str:
    return f"commit-{uuid.uuid4().hex}"


def folder_path(root: str, part: str, folder: str) -> str:
    """Where a commit puts its rows of the table ``part``."""
    return join_path(root, part, f"folder={folder}")


def record(spark: SparkSession, root: str, batch_id: int, folder: str) -> None:
    """Makes the folder's rows those of the batch, in place of an earlier commit of it."""
    last = log(spark, root).where(F.col("batch_id") == batch_id).agg(F.max("version")).first()[0] or 0
    row = spark.createDataFrame([(batch_id, last + 1, folder)], LOG)
    row.coalesce(1).write.mode("append").parquet(join_path(root, "log"))


def has(spark: SparkSession, root: str, batch_id: int) -> bool:
    return bool(log(spark, root).where(F.col("batch_id") == batch_id).limit(1).count())


def committed(spark: SparkSession, root: str, part: str, schema: str) -> DataFrame:
    """The rows of the table ``part`` that committed batches hold, without the folder's name."""
    last = log(spark, root).groupBy("batch_id").agg(F.max(F.struct("version", "folder")).alias("last"))
    rows = _read(spark, join_path(root, part), f"{schema}, folder string")
    return rows.join(last.select("last.folder"), "folder", "left_semi").drop("folder")
