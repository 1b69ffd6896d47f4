"""Class and classifier catalogues: descriptions, taxonomy order, match levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.functions import labels as L
from probscope.operators.select_one import one_description
from probscope.sources.fixtures import Tables

MISSED = -1


def classes_in_use(t: Tables) -> DataFrame:
    """(class_id, n_classifications) of the classes predicted by any classifier or reached from a true gentype
    (fan-out map): one count per class, the classification rows are read once."""
    predicted = t.broker_classification.groupBy("class_id").agg(F.count(F.lit(1)).alias("c"))
    gentypes = t.truth.select("gentype").distinct()
    true_ = gentypes.join(t.gentype_hier.select("gentype", "class_id"), "gentype").select("class_id", F.lit(0).alias("c"))
    return predicted.union(true_).groupBy("class_id").agg(F.sum("c").alias("n_classifications"))


def class_catalog(t: Tables) -> DataFrame:
    """(class_id, description, n_classifications): one description per class."""
    return classes_in_use(t).join(one_description(t.gentype_hier), "class_id", "left")


def taxonomy_order(t: Tables) -> DataFrame:
    """(class_id, description, sort_key): ids right-padded with zeros to the longest id so
    that subclasses follow their class; 'missed' (-1) first with key -1."""
    cat = class_catalog(t).select("class_id", "description")
    maxdigits = cat.select(F.max(F.length(F.col("class_id").cast("string")))).scalar()
    keyed = cat.select("class_id", "description", L.taxonomy_sort_key("class_id", maxdigits).alias("sort_key"))
    missed = t.truth.sparkSession.createDataFrame([(MISSED, "missed", -1)],
                                                  "class_id int, description string, sort_key long")
    return keyed.unionByName(missed).orderBy("sort_key")


def match_levels(t: Tables, min_matchable: int = 2000) -> DataFrame:
    """(class_id, level, exactmatch, categorymatch, generalmatch, broadmatch) for the
    classes in use; ids below ``min_matchable`` (meta and static classes) and classes whose name ends with
    "/Other" never match."""
    return with_match_levels(class_catalog(t), min_matchable)


def with_match_levels(classes: DataFrame, min_matchable: int = 2000, keep: Sequence[str] = ()) -> DataFrame:
    """match_levels of the given classes (class_id, description), with the columns ``keep``."""
    other = F.coalesce(F.col("description").endswith("/Other"), F.lit(False))
    lvl = L.match_level("class_id", (F.col("class_id") >= min_matchable) & ~other)
    out = classes.select("class_id", *keep, lvl.alias("level"))
    for name in L.LEVELS:
        out = out.withColumn(f"{name}match", F.col("level") == name)
    return out


def match_rate_by_level(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """From confusion counts (classifier_id, pred_class, true_class, n): per classifier,
    true class and level, objects whose prediction equals the truth once both are
    truncated to that level. Classes of ``classes`` (class_id, description) that never match
    match no class here either."""
    none = with_match_levels(classes).where("level = 'none'").select(F.col("class_id").alias("pred_class"),
                                                                     F.lit(True).alias("never"))
    levels = F.array(*[F.lit(x) for x in L.LEVELS])
    rows = counts.join(none, "pred_class", "left").select("never", "classifier_id", "pred_class", "true_class", "n", F.explode(levels).alias("level"))
    match = F.lit(False)
    for name in L.LEVELS:
        eq = L.truncate_to_level("pred_class", name) == L.truncate_to_level("true_class", name)
        match = F.when(F.col("level") == name, eq & (F.col("pred_class") >= 0) & F.col("never").isNull()).otherwise(match)
    return (rows.groupBy("classifier_id", "true_class", "level")
            .agg(F.sum("n").alias("n_objects"), F.sum(F.when(match, F.col("n")).otherwise(0)).alias("n_match"))
            .withColumn("rate", F.col("n_match") / F.col("n_objects")))


def classifier_catalog(t: Tables) -> DataFrame:
    """Catalogue with a printable title and per-classifier message / classification counts
    (zero for a classifier without data)."""
    per_msg = t.broker_classification.groupBy("broker_message_id", "classifier_id") \
        .agg(F.count(F.lit(1)).alias("c"))
    stats = per_msg.groupBy("classifier_id").agg(F.count(F.lit(1)).alias("n_messages"),
                                                 F.sum("c").alias("n_classifications"))
    title = L.classifier_title("broker_name", "broker_version", "classifier_name", "classifier_params")
    return (t.classifiers.join(stats, "classifier_id", "left")
            .select("classifier_id", "broker_name", "broker_version", "classifier_name", "classifier_params",
                    title.alias("title"),
                    L.classifier_listing_key("broker_name", "classifier_name", "broker_version",
                                             "classifier_params").alias("sort_key"),
                    F.coalesce("n_messages", F.lit(0)).cast("long").alias("n_messages"),
                    F.coalesce("n_classifications", F.lit(0)).cast("long").alias("n_classifications"))
            .orderBy("sort_key"))
