"""Joins shared by the metrics: truth classes, message context, source offsets.

The classification table is ~32x larger than the message table, so every
context join is built at message/source grain first and the classification
rows are joined to it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.sources.fixtures import Tables


def classified(t: Tables, ctx: DataFrame) -> DataFrame:
    """Classification rows joined to ``ctx`` by message. Where the messages are stored as arrays, message rows are joined,
    and the classes are laid out after the join: the shuffle has a row per message."""
    if t.message_probs is None:
        return t.broker_classification.join(ctx, "broker_message_id")
    return plain_arrays(t.message_probs).join(ctx, "broker_message_id").select(
        "broker_message_id", "classifier_id", laid_out(), *[c for c in ctx.columns if c != "broker_message_id"])


def plain_arrays(msgs: DataFrame) -> DataFrame:
    """Array messages with the classes and the probabilities as two arrays of numbers: half the bytes of an array of
    structs where rows are shuffled and sorted."""
    return msgs.select("broker_message_id", "classifier_id", F.col("probs.class_id").alias("class_ids"),
                       F.col("probs.probability").alias("probabilities"))


def laid_out() -> Column:
    """The columns class_id and probability, a row for each class of the two arrays."""
    return F.inline(F.arrays_zip("class_ids", "probabilities")).alias("class_id", "probability")


def true_class_rows(t: Tables, ctx: DataFrame) -> DataFrame:
    """Classification rows of the class ``true_class_id`` of ``ctx``, joined by message."""
    if t.message_probs is not None:
        return classified(t, ctx).where(F.col("class_id") == F.col("true_class_id"))
    cls = t.broker_classification.select("broker_message_id", "classifier_id", "class_id", "probability")
    return cls.join(ctx, (cls["broker_message_id"] == ctx["broker_message_id"])
                    & (cls["class_id"] == ctx["true_class_id"])).drop(ctx["broker_message_id"])


def truth_classes(t: Tables, hierarchical: bool = False, name: str = "true_class") -> DataFrame:
    """(dia_object_id, <name>): truth joined to the gentype->class map.

    The map can fan out (one gentype, several classes); an object then counts
    once per class, as upstream."""
    dim = t.gentype_hier if hierarchical else t.gentype
    return (t.truth.select("dia_object_id", "gentype")
            .join(dim.select("gentype", F.col("class_id").alias(name)), "gentype")
            .select("dia_object_id", name))


def message_context(t: Tables) -> DataFrame:
    """Message -> alert: (broker_message_id, alert_id, ingest_ts, dia_source_id, dia_object_id, alert_sent_ts)."""
    return (t.broker_message.select("broker_message_id", "alert_id", "ingest_ts")
            .join(t.diaalert.select("alert_id", "dia_source_id", "dia_object_id", "alert_sent_ts"), "alert_id"))


def source_deltat(t: Tables) -> DataFrame:
    """Sources with ``deltat = mid_point_tai - peakmjd`` (MJD/TAI offset ignored) and gentype."""
    return (t.diasource.select("dia_source_id", "dia_object_id", "mid_point_tai", "filter_name")
            .join(t.truth.select("dia_object_id", "peakmjd", "gentype"), "dia_object_id")
            .withColumn("deltat", F.col("mid_point_tai") - F.col("peakmjd")))


def source_classifications(t: Tables, hierarchical: bool = False) -> DataFrame:
    """The per-classification view: classifier_id, dia_object_id, dia_source_id,
    class_id, alert_id, true_class_id, probability, ingest_ts, alert_sent_ts,
    broker_message_id."""
    ctx = message_context(t).join(truth_classes(t, hierarchical, "true_class_id"), "dia_object_id")
    return classified(t, ctx)


def classified_sources(t: Tables) -> DataFrame:
    """Distinct (classifier_id, dia_source_id) pairs that received a classification.

    Reduced at message grain (classifier is constant within a message)."""
    if t.message_probs is None:
        per_msg = t.broker_classification.select("broker_message_id", "classifier_id").distinct()
    else:
        per_msg = t.message_probs.where(F.size("probs") > 0).select("broker_message_id", "classifier_id")
    return (per_msg.join(t.broker_message.select("broker_message_id", "alert_id"), "broker_message_id")
            .join(t.diaalert.select("alert_id", "dia_source_id"), "alert_id")
            .select("classifier_id", "dia_source_id").distinct())
