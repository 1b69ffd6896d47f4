"""Diagnostics, I/O round trips, parameterised SQL, message arrays and the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from probscope.operators import confusion as cm
from probscope.operators import diagnostics as dg
from probscope.operators import relday as rd
from probscope.operators import reshape as rs
from probscope.plans.registry import register
from probscope.sources import io
from probscope.sources.fixtures import Tables
from probscope.streaming import alert_rate as st


@register("alert_rate")
def alert_rate(t: Tables):
    """Sent alerts per day."""
    return dg.alert_rate(t, "1 day")


@register("alert_rate_stream")
def alert_rate_stream(t: Tables):
    """The same counts from a Structured Streaming run over the alert table's files."""
    spark = t.diaalert.sparkSession
    folder = io.scratch_path(spark, "alerts", uuid.uuid4().hex[:10])  # the alerts land as files first
    t.diaalert.write.mode("overwrite").parquet(folder)
    run = uuid.uuid4().hex[:10]
    out = io.scratch_path(spark, "alert-rate", run)
    q = st.start_alert_rate(spark, folder, io.scratch_path(spark, "stream-ckpt", run), out)
    q.awaitTermination()
    return st.read_alert_rate(spark, out)


@register("delay_stats")
def delay_stats(t: Tables):
    """Alert-to-broker, broker-to-ingest and alert-to-ingest delays per classifier."""
    return dg.delay_stats(t)


@register("completeness")
def completeness(t: Tables):
    """Share of sent sources each catalogued classifier classified."""
    return dg.completeness(t)


@register("prob_by_detection")
def prob_by_detection(t: Tables):
    """Mean true-class probability by detection ordinal."""
    return dg.prob_by_detection(t)


@register("summary_partition_roundtrip")
def summary_partition_roundtrip(t: Tables):
    """Per-day means written as a (classifier, true class)-partitioned summary and read back."""
    spark = t.truth.sparkSession
    path = io.scratch_path(spark, "summary-meanprob", uuid.uuid4().hex[:10])
    io.write_summary(rd.prob_by_relday(t).select("classifier_id", "true_class_id", "relday", "class_id",
                                                  "mean_probability", "n"), path)
    back = io.read_summary(spark, path)
    return back.select(F.col("classifier_id").cast("int"), F.col("true_class_id").cast("int"), "relday", "class_id",
                       "mean_probability", "n")


@register("csv_roundtrip")
def csv_roundtrip(t: Tables):
    """Confusion counts with classifier names written as CSV with a header and read back."""
    from pyspark.sql import types as T
    spark = t.truth.sparkSession
    path = io.scratch_path(spark, "conf-csv", uuid.uuid4().hex[:10])
    counts = cm.with_classifier_name(cm.confusion_counts(t, "last_best"), t.classifiers) \
        .select("pred_class", "true_class", "n", "classifier_id", "classifier_name")
    io.write_csv(counts, path)
    schema = T.StructType([T.StructField("pred_class", T.IntegerType()), T.StructField("true_class", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("classifier_id", T.IntegerType()),
                           T.StructField("classifier_name", T.StringType())])
    return io.read_csv(spark, path, schema)


@register("parameterised_sql")
def parameterised_sql(t: Tables):
    """SQL text with bound parameters (an id list and a class) over the classification view."""
    from probscope.operators.context import source_classifications
    spark = t.truth.sparkSession
    text = ("SELECT v.classifier_id, v.dia_object_id, v.class_id, v.alert_id, v.true_class_id, v.probability, "
            "s.mid_point_tai - o.peakmjd AS deltat "
            "FROM {view} v JOIN {src} s ON v.dia_source_id = s.dia_source_id "
            "JOIN {truth} o ON v.dia_object_id = o.dia_object_id "
            "WHERE array_contains(:cfers, v.classifier_id) AND v.true_class_id = :true_class")
    return io.run_sql(spark, text, {"cfers": (1, 2, 3, 4), "true_class": 2223},
                      view=source_classifications(t), src=t.diasource, truth=t.truth)


@register("explode_messages")
def explode_messages(t: Tables):
    """Long rows rebuilt from per-message (class, probability) arrays."""
    return rs.explode_messages(rs.message_arrays(t))


@register("argmax_from_array")
def argmax_from_array(t: Tables):
    """Highest-probability class of every message, from the array form."""
    return rs.argmax_from_array(rs.message_arrays(t))


@register("delay_histogram")
def delay_histogram(t: Tables):
    """Every kind of delay per classifier in one-day bins."""
    return dg.delay_histogram(t, 86400)


@register("classifications_relday")
def classifications_relday(t: Tables):
    """Every classification with its source, class, day rel. peak and true class."""
    return rd.classification_rows(t)


@register("json_rows_roundtrip")
def json_rows_roundtrip(t: Tables):
    """Alert rows written as JSON lines with ISO-8601 text times, read back with an
    explicit schema and the text parsed back to timestamps."""
    from pyspark.sql import types as T
    spark = t.truth.sparkSession
    path = io.scratch_path(spark, "alerts-json", uuid.uuid4().hex[:10])
    t.diaalert.select("alert_id", "dia_source_id", "dia_object_id",
                      io.iso_text("alert_sent_ts").alias("alert_sent_ts")).write.mode("overwrite").json(path)
    schema = T.StructType([T.StructField("alert_id", T.LongType()), T.StructField("dia_source_id", T.LongType()),
                           T.StructField("dia_object_id", T.LongType()),
                           T.StructField("alert_sent_ts", T.StringType())])
    back = io.read_json_rows(spark, path, schema)
    return back.withColumn("alert_sent_ts", io.parse_iso("alert_sent_ts"))
