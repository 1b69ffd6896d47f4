"""Message arrays <-> long rows.

Brokers send one message with an array of (class, probability); the long table
has one row per class (~32x more rows). The arg-max is computed on the array
with a higher-order function, before any explode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.operators.select_one import asc, desc, pick_one
from probscope.sources.fixtures import Tables

#: A number that probabilities do not take; a message that holds it is only handled more slowly.
NO_PROBABILITY = -1e300


def messages_as_arrays(cls: DataFrame) -> DataFrame:
    """(broker_message_id, classifier_id, probs array<struct<class_id, probability>>); one
    message holds one entry per class, so each array is bounded by the taxonomy."""
    return (cls.groupBy("broker_message_id", "classifier_id")
            .agg(F.array_sort(F.collect_list(F.struct("class_id", "probability"))).alias("probs")))


def explode_messages(msgs: DataFrame) -> DataFrame:
    """Array messages -> one row per (message, classifier, class)."""
    return msgs.select("broker_message_id", "classifier_id", F.inline("probs"))


def argmax_from_array(msgs: DataFrame) -> DataFrame:
    """Highest-probability class of each message without exploding (ties: smaller class), a NULL before all
    numbers, as PostgreSQL orders DESC."""
    values = F.col("probs.probability")
    first = F.array_position(values, F.array_max(values))
    # searching for a value that is not there gives NULL, not false, where there are NULLs
    plain = F.array_contains(values, F.lit(NO_PROBABILITY)).eqNullSafe(F.lit(False)) & (
        first + F.array_position(F.reverse(values), F.array_max(values)) == F.size("probs") + 1)
    # a single greatest number is found by compiled expressions; functions over structs, which order NULLs and ties,
    # are interpreted
    ordered = F.array_max(F.transform("probs", lambda x: F.struct(
        x["probability"].isNull().alias("none"), x["probability"].alias("p"), (-x["class_id"]).alias("c"))))
    best = F.when(plain, F.get("probs", (first - 1).cast("int"))).otherwise(
        F.struct((-ordered["c"]).alias("class_id"), ordered["p"].alias("probability")))
    return msgs.where(F.size("probs") > 0).select(
        "broker_message_id", "classifier_id", best["class_id"].alias("class_id"), best["probability"].alias("probability"))


def message_arrays(t: Tables) -> DataFrame:
    """The array form: as stored, where the data set holds it, else built from the long rows."""
    return t.message_probs if t.message_probs is not None else messages_as_arrays(t.broker_classification)


def per_message_argmax(t: Tables, classifier_ids: Sequence[int] | None = None) -> DataFrame:
    """(broker_message_id, classifier_id, class_id, probability): each message's highest-probability class (ties
    to the smaller class). From the stored array form it needs no shuffle; else it is a map-side combined aggregate."""
    rows = t.message_probs if t.message_probs is not None else t.broker_classification
    if classifier_ids is not None:
        rows = rows.where(F.col("classifier_id").isin(list(classifier_ids)))
    if t.message_probs is not None:
        return argmax_from_array(rows)
    return pick_one(rows, ["broker_message_id", "classifier_id"], [desc("probability"), asc("class_id")],
                    ["class_id", "probability"])
