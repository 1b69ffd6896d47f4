"""Service diagnostics (our definitions of the metrics the original page only names):
alert rate, delays, completeness, and the metric as a function of detection count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.functions import exact as X
from probscope.operators.context import message_context, truth_classes, true_class_rows
from probscope.operators.quantiles import exact_quantiles
from probscope.sources.fixtures import Tables


def alert_rate(t: Tables, every: str = "1 day") -> DataFrame:
    """Alerts sent per tumbling window: (window_start, window_end, n_alerts)."""
    sent = t.diaalert.where(F.col("alert_sent_ts").isNotNull())
    return (sent.groupBy(F.window("alert_sent_ts", every).alias("w")).agg(F.count(F.lit(1)).alias("n_alerts"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_alerts"))


#: kind -> (from, to): the alert is sent, the broker publishes its message, the service takes it in.
DELAYS = {
    "alert_to_broker": ("alert_sent_ts", "broker_ts"),
    "broker_to_ingest": ("broker_ts", "ingest_ts"),
    "alert_to_ingest": ("alert_sent_ts", "ingest_ts"),
}


def message_classifiers(t: Tables) -> DataFrame:
    """(broker_message_id, classifier_id): of the stored arrays, which have a row per message, else of the distinct pairs."""
    if t.message_probs is not None:
        return t.message_probs.where(F.size("probs") > 0).select("broker_message_id", "classifier_id")
    return t.broker_classification.select("broker_message_id", "classifier_id").distinct()


def delays(t: Tables) -> DataFrame:
    """(classifier_id, delay, seconds): a row per message of a sent alert, classifier and kind of delay whose
    two times are known (the classifier comes from the classification rows)."""
    msg = t.broker_message.select("broker_message_id", "alert_id", "broker_ts", "ingest_ts").join(
        t.diaalert.select("alert_id", "alert_sent_ts").where(F.col("alert_sent_ts").isNotNull()), "alert_id")
    kinds = F.array(*[F.struct(F.lit(k).alias("delay"), F.timestamp_diff("SECOND", F.col(a), F.col(b)).alias("seconds"))
                      for k, (a, b) in DELAYS.items()])
    rows = message_classifiers(t).join(msg, "broker_message_id").select("classifier_id", F.inline(kinds))
    return rows.where(F.col("seconds").isNotNull())


def delay_bin(seconds: str) -> Column:
    """-1 for no or a negative delay, else 32 bins for each doubling: at most 2016 bins, whatever the delays."""
    s = F.col(seconds)
    log = F.floor(F.log2(F.greatest(s, F.lit(1)).cast("double")) * 32)
    return F.when(s <= 0, -1).otherwise(log).cast("int")


def delay_stats(t: Tables) -> DataFrame:
    """Per classifier and kind of delay: count, mean, min, max and exact quartiles of the seconds, all from one count per
    distinct number of seconds."""
    by = ["classifier_id", "delay"]
    counts = delays(t).groupBy(*by, "seconds").agg(F.count(F.lit(1)).alias("c"))
    sums = counts.groupBy(*by).agg(
        F.sum("c").alias("n"), (F.sum(F.col("seconds") * F.col("c")) / F.sum("c")).alias("mean_seconds"),
        F.min("seconds").alias("min_seconds"), F.max("seconds").alias("max_seconds"))
    quartiles = exact_quantiles(counts, by, "seconds", {"q25_seconds": 0.25, "q50_seconds": 0.5, "q75_seconds": 0.75},
                                delay_bin("seconds"), count="c")
    return sums.join(quartiles, by)


def delay_histogram(t: Tables, width_seconds: int = 86400) -> DataFrame:
    """Fixed-width histogram of every kind of delay: (classifier_id, delay, bin_start_seconds, n)."""
    start = (F.floor(F.col("seconds") / width_seconds) * width_seconds).alias("bin_start_seconds")
    return delays(t).groupBy("classifier_id", "delay", start).agg(F.count(F.lit(1)).alias("n"))


def completeness(t: Tables) -> DataFrame:
    """Per catalogued classifier: sent sources, those it classified, and the ratio."""
    sent = t.diaalert.where(F.col("alert_sent_ts").isNotNull()).select("dia_source_id").distinct()
    n_sent = sent.select(F.count(F.lit(1))).scalar()
    pairs = message_classifiers(t)
    classified = (pairs.join(message_context(t).select("broker_message_id", "dia_source_id"), "broker_message_id")
                  .select("classifier_id", "dia_source_id").distinct()
                  .join(sent, "dia_source_id", "left_semi")
                  .groupBy("classifier_id").agg(F.count(F.lit(1)).alias("n_classified")))
    return (t.classifiers.select("classifier_id").join(classified, "classifier_id", "left")
            .select("classifier_id", n_sent.alias("n_sent"),
                    F.coalesce("n_classified", F.lit(0)).cast("long").alias("n_classified"))
            .withColumn("completeness", F.coalesce(F.try_divide(F.col("n_classified").cast("double"),
                                                                F.col("n_sent")), F.lit(0.0))))


def detection_ordinals(t: Tables, bucket_days: float = 1.0) -> DataFrame:
    """(dia_source_id, detection): 1-based ordinal of each source within its object by
    (time, source id), without sorting a whole object in one task.

    Sources are cut into time buckets per object; bucket sizes are counted with a
    map-side-combined aggregate, their running totals (one row per object and
    bucket, bounded by the survey length) give each bucket's offset, and rows are
    ranked only within their own (object, bucket)."""
    from pyspark.sql import Window
    src = t.diasource.select("dia_source_id", "dia_object_id", "mid_point_tai",
                             F.floor(F.col("mid_point_tai") / bucket_days).alias("bucket"))
    sizes = src.groupBy("dia_object_id", "bucket").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("dia_object_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("dia_object_id", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    local = Window.partitionBy("dia_object_id", "bucket").orderBy("mid_point_tai", "dia_source_id")
    ranked = src.withColumn("r", F.row_number().over(local))
    return ranked.join(offsets, ["dia_object_id", "bucket"]).select(
        "dia_source_id", (F.col("r") + F.col("offset")).alias("detection"))


def prob_by_detection(t: Tables) -> DataFrame:
    """Mean probability of the true class by detection ordinal, per classifier and true class."""
    ctx = (message_context(t).select("broker_message_id", "dia_source_id", "dia_object_id")
           .join(detection_ordinals(t), "dia_source_id")
           .join(truth_classes(t, name="true_class_id"), "dia_object_id"))
    return true_class_rows(t, ctx).groupBy("classifier_id", "true_class_id", "detection").agg(
        X.fmean("probability").alias("mean_prob"), F.count(F.lit(1)).alias("n"))
