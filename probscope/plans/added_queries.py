"""Verdicts by number of alerts, rescaled time, answers to alerts, sliding windows, deep pages, lookups, sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from probscope.api import Metrics
from probscope.operators import characteristic as ch
from probscope.operators import explore as ex
from probscope.operators import probdiff as pdiff
from probscope.operators import probhist as ph
from probscope.operators import relday as rd
from probscope.operators import sliding as sl
from probscope.operators import verdicts as vd
from probscope.operators.context import source_classifications
from probscope.operators.intervals import sliding_windows
from probscope.operators.pages import Listing
from probscope.operators.reshape import message_arrays
from probscope.plans import incremental as inc
from probscope.plans import sketches as sk
from probscope.plans.registry import register
from probscope.schemas import DIAFORCEDSOURCE
from probscope.session import shuffles_removed
from probscope.sources import io
from probscope.sources.fixtures import Tables
from probscope.streaming import answers as st
from probscope.streaming.summaries import start_summaries

#: How long an answer may take; the fixture's brokers take up to 50 seconds.
WAIT = "20 seconds"


@register("confusion_by_alerts")
def confusion_by_alerts(t: Tables):
    """Confusion counts of the best classification so far, after 1 to 20 alerts."""
    return vd.confusion_by_alerts(t, 20)


@register("accuracy_by_alerts")
def accuracy_by_alerts(t: Tables):
    """Share of objects whose verdict is true after 1 to 20 alerts."""
    return vd.accuracy_by_alerts(t, 20)


@register("characteristic_times")
def characteristic_times(t: Tables):
    """Median width at half maximum of the light curves of each class."""
    return ch.characteristic_times(t)


@register("mean_prob_by_scaled_time")
def mean_prob_by_scaled_time(t: Tables):
    """Mean probability by time rel. peak in units of the class's characteristic time."""
    return ch.mean_prob_by_scaled_time(t)


@register("answers_batch")
def answers_batch(t: Tables):
    """Alerts answered within 20 seconds, per classifier, and those that nobody answered."""
    return st.answer_stats(st.answers(t.diaalert, _messages(t), WAIT))


@register("answers_stream")
def answers_stream(t: Tables):
    """The same from a stream-stream join over files of alerts and messages that land in order of time, ended by a mark."""
    folder = io.scratch_path(t.diaalert.sparkSession, "answers", uuid.uuid4().hex[:10])
    return st.answer_stats(st.replay(t.diaalert, _messages(t), folder, WAIT))


def _messages(t: Tables):
    """Messages with their classifier."""
    return t.broker_message.select("broker_message_id", "alert_id", "ingest_ts").join(
        message_arrays(t).select("broker_message_id", "classifier_id"), "broker_message_id").select(
        "broker_message_id", "alert_id", "classifier_id", "ingest_ts")


@register("prob_by_sliding_window")
def prob_by_sliding_window(t: Tables):
    """Mean probability of the true class in overlapping windows of ten days, one a day."""
    return sl.mean_prob_by_window(t, sliding_windows(t.truth.sparkSession, -30.0, 100.0, 10.0, 1.0))


@register("deep_page")
def deep_page(t: Tables):
    """The thousand rows in the middle of the first classifier's classifications, by object and ingest time."""
    spark = t.truth.sparkSession
    rows = source_classifications(t).where(F.col("classifier_id") == 1).select(*ex.VIEW_COLS, "broker_message_id")
    listing = Listing.write(rows, ["dia_object_id", "ingest_ts", "class_id", "broker_message_id"],
                            io.scratch_path(spark, "listing", uuid.uuid4().hex[:10]), rows=100_000)
    middle = sum(n for _, n in listing.counts) // 2
    return listing.page(middle, 1000).select(*ex.VIEW_COLS)


@register("relday_mean_stream")
def relday_mean_stream(t: Tables):
    """Per-day means of the latest messages, kept by a stream that takes the messages in three epochs."""
    spark, run = t.truth.sparkSession, uuid.uuid4().hex[:10]
    path = lambda name: io.scratch_path(spark, "summary-stream", run, name)
    # an epoch takes a third of the files, which are as many as tasks can write at once
    with shuffles_removed(spark):
        t.broker_message.repartition(3 * spark.sparkContext.defaultParallelism).write.option("compression", "zstd").parquet(
            path("messages"))
    files = len(spark.read.schema(t.broker_message.schema).parquet(path("messages")).inputFiles())
    start_summaries(t, path("messages"), path("checkpoint"), path("kept"), ["mean_prob_by_relday"],
                    files_per_epoch=max(1, -(-files // 3))).awaitTermination()
    return inc.read(t, path("kept"), "mean_prob_by_relday")


@register("cached_probhist")
def cached_probhist(t: Tables):
    """The histogram that a client computes once and keeps."""
    client = Metrics.from_tables(t)
    client.probhist().count()
    return client.probhist()


@register("fractions_sum_to_one")
def fractions_sum_to_one(t: Tables):
    """Groups of each normalised histogram, and those whose fractions add up to one."""
    hist = ph.normalize_over_probbin(ph.probhist(t)).groupBy("classifier_id", "true_class_id", "class_id", "tbin")
    diff = pdiff.probdiff_hist(t).groupBy(*pdiff.GROUP)
    parts = []
    for name, groups in (("probhist", hist), ("probdiff_hist", diff)):
        ones = (F.abs(F.col("total") - 1) <= 1e-9).cast("long")
        parts.append(groups.agg(F.sum("frac").alias("total")).groupBy("classifier_id", "true_class_id").agg(
            F.count(F.lit(1)).alias("n_groups"), F.sum(ones).alias("n_sum_to_one"))
            .select(F.lit(name).alias("histogram"), "*"))
    return parts[0].unionByName(parts[1])


@register("light_curve_lookup")
def light_curve_lookup(t: Tables):
    """The light curve of one object from a table laid out for lookups."""
    spark = t.truth.sparkSession
    path = io.write_clustered(t.diaforcedsource, io.scratch_path(spark, "clustered", uuid.uuid4().hex[:10]), "dia_object_id")
    wanted = ex.richest_object(t).first().dia_object_id
    return spark.read.schema(DIAFORCEDSOURCE).parquet(path).where(F.col("dia_object_id") == wanted)


@register("sketched_distinct")
def sketched_distinct(t: Tables):
    """Exact distinct counts per classifier and true class, and whether the merged sketches are within their error."""
    root = io.scratch_path(t.truth.sparkSession, "sketches", uuid.uuid4().hex[:10])
    sk.distinct_sketches(t).write.partitionBy("classifier_id").parquet(io.join_path(root, "distinct"))
    exact = rd.classification_summary(t).select("classifier_id", "true_class_id", "n_objects", "n_sources")
    close = lambda a, b: (F.abs(F.col(a) - F.col(b)) <= sk.DISTINCT_ERROR * F.col(b) + 0.5)
    return exact.join(sk.distinct(t, root), ["classifier_id", "true_class_id"]).select(
        "classifier_id", "true_class_id", "n_objects", "n_sources", close("approx_objects", "n_objects").alias("objects_close"),
        close("approx_sources", "n_sources").alias("sources_close"))


@register("sketched_quantiles")
def sketched_quantiles(t: Tables):
    """Numbers of probabilities on days -10 to 10 per class, and whether the quartiles of the merged sketches are within
    their rank error."""
    root = io.scratch_path(t.truth.sparkSession, "sketches", uuid.uuid4().hex[:10])
    sk.quantile_sketches(t).write.partitionBy("classifier_id").parquet(io.join_path(root, "quantiles"))
    probs, by = {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["classifier_id", "true_class_id", "class_id"]
    found = sk.quantiles(t, root, probs, (-10, 10))
    dim = t.gentype.select("gentype", F.col("class_id").alias("true_class_id"))
    rows = (rd.all_rows_with_relday(t).where(F.col("relday").between(-10, 10))
            .groupBy("classifier_id", "gentype", "class_id", "probability").agg(F.count(F.lit(1)).alias("c")).join(dim, "gentype"))
    near = rows.join(found, by)
    ranks = near.groupBy(*by, "n").agg(*[F.sum(F.when(test, F.col("c")).otherwise(0)).alias(f"{side}_{q}")
                                        for q in probs for side, test in (("below", F.col("probability") < F.col(q)),
                                                                          ("upto", F.col("probability") <= F.col(q)))])
    good = F.lit(True)
    for q, p in probs.items():
        good = good & (F.col(f"below_{q}") <= (p + sk.RANK_ERROR) * F.col("n") + 1) & (
            F.col(f"upto_{q}") >= (p - sk.RANK_ERROR) * F.col("n") - 1)
    return ranks.select(*by, "n", good.alias("quartiles_close"))
