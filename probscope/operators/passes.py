"""Work over many messages in slices, so that what is on disk at once is bounded.

What an action shuffles stays on disk until it ends. Where a data set has more than ``PASS_MESSAGES`` messages, the steps
that shuffle their probabilities, or rows per source or object, are therefore actions of their own over slices: each
writes what its slice comes to, mostly counts and sums, and its shuffles go when it ends. A slice is a range of hashes of
the key by which the rows meet, so a key is in one slice, whatever the keys are. Every row is in one slice; below that number of messages
nothing is sliced or written.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probscope.operators.context import source_deltat
from probscope.session import shuffles_removed
from probscope.sources import io
from probscope.sources.fixtures import Tables

#: Messages of a slice, about.
PASS_MESSAGES = 60_000_000
#: Messages of one alert up to which they meet in one task.
MANY_MESSAGES = 10_000
ID = "broker_message_id"


def slices(t: Tables, part: float = 1.0) -> int:
    """Into how many slices the messages of ``t`` are cut, each of ``PASS_MESSAGES`` or the ``part`` of them."""
    return max(1, math.ceil(t.broker_message.count() / (PASS_MESSAGES * part)))


def in_slice(df: DataFrame, key: str, k: int, n: int) -> DataFrame:
    """The rows of the ``k``-th of ``n`` slices by ``key``."""
    return df if n == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(n)) == k)


def messages_in_slice(t: Tables, k: int, n: int) -> Tables:
    """``t`` with the messages of a slice alone."""
    changes = {name: in_slice(getattr(t, name), ID, k, n) for name in
               ("broker_message", "broker_classification" if t.message_probs is None else "message_probs")}
    if t.context is not None:
        changes["context"] = in_slice(t.context, ID, k, n)
    return t.but(**changes)


def stored(frames: Iterable[DataFrame], name: str) -> DataFrame:
    """The rows of ``frames``, which are written to shared storage one after another, each by an action of its own."""
    found = None
    for df in frames:
        if found is None:
            spark, schema = df.sparkSession, df.schema
            found = io.scratch_path(spark, name, uuid.uuid4().hex[:10])
        with shuffles_removed(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(found)
    return spark.read.schema(schema).parquet(found)


def message_sources(t: Tables, latest: bool = False) -> DataFrame:
    """(broker_message_id, dia_source_id, deltat, gentype) of every message that has a source, written once, and what the
    narrow columns alone tell of it. A message is ``clean`` if its source has one alert, and no message of that alert has
    its probabilities stored more than once; the messages of a clean one's classifier and source are then those of its
    classifier and alert.

    * ``alone``: it is clean, and the only message of its classifier and source;
    * with ``latest``: ``clean`` and ``ingest_ts``; of the clean messages of a classifier and source only the latest (by
      ingest time, then id) is kept, and all that are not clean are."""
    one = F.count(F.lit(1))
    src = source_deltat(t).select("dia_source_id", F.col("dia_object_id").alias("_object"), "deltat", "gentype")
    at = F.col("dia_object_id")
    # the object is compared after the join by source, so that what is counted per source is not shuffled again
    alerts = (t.diaalert.select("alert_id", "dia_source_id", "dia_object_id").join(src, "dia_source_id")
              .where((F.col("_object") <= at) & (F.col("_object") >= at)))
    alerts = stored([alerts.select("alert_id", "dia_source_id", "deltat", "gentype",
                                   (one.over(Window.partitionBy("dia_source_id")) == 1).alias("single"))], "alert-sources")
    hot = stored([t.broker_message.groupBy("alert_id").agg(one.alias("n")).where(F.col("n") > MANY_MESSAGES)
                  .select("alert_id")], "hot-alerts")
    by_id = Window.partitionBy(ID)
    classifiers = (t.message_probs.select(ID, "classifier_id")
                   .select("*", one.over(by_id).alias("copies"), F.row_number().over(by_id.orderBy("classifier_id")).alias("nth"))
                   .where(F.col("nth") == 1).drop("nth"))
    msgs = t.broker_message.select(ID, "alert_id", "ingest_ts").join(classifiers, ID)
    kept = [ID, "dia_source_id", "deltat", "gentype", *(["ingest_ts", "clean"] if latest else ["alone"])]
    no_hot = hot.isEmpty()
    usual = msgs if no_hot else msgs.join(F.broadcast(hot), "alert_id", "left_anti")
    same = Window.partitionBy("alert_id", "dia_source_id", "classifier_id")
    rows = usual.join(alerts, "alert_id").withColumn(
        "clean", F.col("single") & (F.max("copies").over(Window.partitionBy("alert_id")) == 1))
    if latest:
        nth = F.row_number().over(same.orderBy(F.desc_nulls_last("ingest_ts"), F.desc_nulls_last(ID)))
        rows = rows.withColumn("nth", nth).where(~F.col("clean") | (F.col("nth") == 1))
    else:
        rows = rows.withColumn("alone", F.col("clean") & (one.over(same) == 1))
    rows = rows.select(*kept)
    if not no_hot:
        no = F.lit(False)
        rest = msgs.join(F.broadcast(hot), "alert_id", "left_semi").join(alerts, "alert_id")
        rows = rows.unionByName(rest.withColumn("clean", no).withColumn("alone", no).select(*kept))
    return stored([rows], "message-sources")
