"""Confusion matrices of one chosen classification per object.

Definitions of "the" classification of an object by a classifier:

* ``last_best``: the most recent alert (NULL sent time first, as PostgreSQL
  DESC), then the highest probability;
* ``best``: the highest probability, then the most recent alert;
* ``nth``: the highest probability among classifications of the object's
  n-th detection (1-based by time, then source id).

Remaining ties go to the smaller class id, then the smaller message id.

Plan shape: classification rows are first reduced to their arg-max class per
message (a map-side-combined aggregate, ~32x fewer rows), joined to the
message/alert context, and reduced again per (classifier, object). All
classifiers are handled in one plan; the per-classifier loop of a client
becomes a group key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probscope.functions import labels
from probscope.operators.reshape import per_message_argmax
from probscope.operators.select_one import asc, desc, nth_ordinal_filter, one_description, pick_one
from probscope.sources.fixtures import Tables

DEFINITIONS = {
    "last_best": [desc("alert_sent_ts"), desc("probability")],
    "best": [desc("probability"), desc("alert_sent_ts")],
    "nth": [desc("probability")],
}
TIE_BREAK = [asc("class_id"), asc("broker_message_id")]
NORM_KEYS = {"true": ["classifier_id", "true_class"], "pred": ["classifier_id", "pred_class"],
             "all": ["classifier_id"]}
MISSED = -1


def nth_detection_sources(t: Tables, n: int) -> DataFrame:
    """(dia_source_id) of each object's n-th detection (1-based, by time then id)."""
    src = t.diasource.select("dia_source_id", "dia_object_id", "mid_point_tai")
    return nth_ordinal_filter(src, ["dia_object_id"], [F.col("mid_point_tai"), F.col("dia_source_id")],
                              int(n)).select("dia_source_id")


def chosen_classification(t: Tables, definition: str = "last_best", nth_detection: int = 3,
                          classifier_ids: Sequence[int] | None = None) -> DataFrame:
    """(classifier_id, dia_object_id, class_id, probability, alert_sent_ts): one row per
    classifier and classified object."""
    if definition not in DEFINITIONS:
        raise ValueError(f"Unknown classification definition: {definition}")
    # Within one message the alert time is constant, so its best row is the arg-max of
    # (probability desc, class asc); the global winner is always such a row.
    per_msg = per_message_argmax(t, classifier_ids)
    alerts = t.diaalert.select("alert_id", "dia_object_id", "dia_source_id", "alert_sent_ts")
    if definition == "nth":
        alerts = alerts.join(nth_detection_sources(t, nth_detection), "dia_source_id", "left_semi")
    ctx = t.broker_message.select("broker_message_id", "alert_id").join(alerts, "alert_id")
    cand = per_msg.join(ctx, "broker_message_id")
    return pick_one(cand, ["classifier_id", "dia_object_id"], DEFINITIONS[definition] + TIE_BREAK,
                    ["class_id", "probability", "alert_sent_ts"])


def sent_objects(t: Tables) -> DataFrame:
    """(dia_object_id) of objects with at least one alert actually sent."""
    return (t.diaalert.groupBy("dia_object_id")
            .agg(F.bool_or(F.col("alert_sent_ts").isNotNull()).alias("is_sent"))
            .where("is_sent").select("dia_object_id"))


def confusion_counts(t: Tables, definition: str = "last_best", nth_detection: int = 3,
                     include_missed: bool = False, classifier_ids: Sequence[int] | None = None,
                     hierarchical: bool = False) -> DataFrame:
    """(classifier_id, pred_class, true_class, n); ``pred_class = -1`` counts missed objects.

    ``include_missed`` keeps only objects with a sent alert and adds, per
    classifier in the catalogue, the sent objects it never classified:
    ``n_missed = n_sent(true) - n_classified(classifier, true)``; no
    object x classifier product is formed."""
    best = chosen_classification(t, definition, nth_detection, classifier_ids)
    truth = t.truth.select("dia_object_id", "gentype")
    dim = (t.gentype_hier if hierarchical else t.gentype).select("gentype", F.col("class_id").alias("true_class"))
    keys = ["classifier_id", "pred_class", "true_class"]

    def fan_out(cells: DataFrame) -> DataFrame:
        # cells are counted per gentype; the (broadcast) gentype -> class map fans
        # out aggregated cells only, and an object counts once per class it maps to
        return cells.join(dim, "gentype").groupBy(*keys).agg(F.sum("w").alias("n"))

    if not include_missed:
        cells = (best.join(truth, "dia_object_id")
                 .groupBy("classifier_id", F.col("class_id").alias("pred_class"), "gentype")
                 .agg(F.count(F.lit(1)).alias("w")))
        return fan_out(cells)

    sent_truth = truth.join(sent_objects(t), "dia_object_id", "left_semi")
    n_sent = sent_truth.groupBy("gentype").agg(F.count(F.lit(1)).alias("n_sent"))
    catalogue = t.classifiers.select("classifier_id")
    if classifier_ids is not None:
        catalogue = catalogue.where(F.col("classifier_id").isin(list(classifier_ids)))
    # The catalogue id list is a scalar subquery (bounded by the classifier catalogue);
    # exploding it per gentype gives the (classifier, gentype) spine, which puts
    # n_sent into each classifier's missed cell.
    ids = catalogue.select(F.collect_list("classifier_id")).scalar()
    spine = n_sent.select(F.explode(ids).alias("classifier_id"), F.lit(MISSED).alias("pred_class"), "gentype",
                          F.col("n_sent").alias("w"))
    # Every classified sent object adds 1 to its own cell and takes 1 from the missed
    # cell of its classifier and gentype: one aggregate, the picks are read once.
    votes = F.array(F.struct(F.col("class_id").alias("pred_class"), F.lit(1).cast("long").alias("w")),
                    F.struct(F.lit(MISSED).alias("pred_class"), F.lit(-1).cast("long").alias("w")))
    classified = (best.join(sent_truth, "dia_object_id")
                  .select("classifier_id", "gentype", F.inline(votes))
                  .select("classifier_id", "pred_class", "gentype", "w"))
    cells = (classified.unionByName(spine)
             .groupBy("classifier_id", "pred_class", "gentype").agg(F.sum("w").alias("w")))
    return fan_out(cells).where(F.col("n") > 0)


def with_classifier_name(df: DataFrame, classifiers: DataFrame, with_params: bool = False) -> DataFrame:
    """Attach ``classifier_name`` = 'broker version classifier[ params]' (catalogue members only)."""
    parts = ["broker_name", "broker_version", "classifier_name"] + (["classifier_params"] if with_params else [])
    names = classifiers.select("classifier_id", labels.classifier_title(*parts).alias("classifier_name"))
    return df.join(names, "classifier_id")


def normalize(counts: DataFrame, norm: str = "true", value: str = "n", out: str = "fraction") -> DataFrame:
    """Fraction of the row ('true' = completeness), column ('pred' = purity) or
    whole matrix ('all'), per classifier; an empty row gives 0."""
    if norm not in NORM_KEYS:
        raise ValueError(f"norm must be one of {sorted(NORM_KEYS)}")
    total = F.sum(value).over(Window.partitionBy(*NORM_KEYS[norm]))
    return counts.withColumn(out, F.coalesce(F.try_divide(F.col(value).cast("double"), total), F.lit(0.0)))


def densify(counts: DataFrame) -> DataFrame:
    """Dense matrix per classifier: every (true label, predicted label) cell with 0
    for absent pairs, over labels with a non-zero row / column (empty rows and
    columns, e.g. 'missed' as a true label, are dropped).

    One aggregate per classifier (its cells are bounded by the class catalogue
    squared) builds the label sets and a (true, pred) -> n map; the grid is then
    generated with array functions, so the counts are read once and never joined
    back."""
    cells = F.collect_list(F.struct("true_class", "pred_class", "n"))
    per = counts.groupBy("classifier_id").agg(cells.alias("cells"))
    trues = F.array_sort(F.array_distinct(F.transform("cells", lambda c: c["true_class"])))
    preds = F.array_sort(F.array_distinct(F.transform("cells", lambda c: c["pred_class"])))
    lookup = F.map_from_entries(F.transform(
        "cells", lambda c: F.struct(F.struct(c["true_class"], c["pred_class"]).alias("k"), c["n"].alias("v"))))
    grid = F.flatten(F.transform(trues, lambda tc: F.transform(preds, lambda pc: F.struct(
        tc.alias("true_class"), pc.alias("pred_class"),
        F.coalesce(F.element_at(lookup, F.struct(tc.alias("true_class"), pc.alias("pred_class"))),
                   F.lit(0)).cast("long").alias("n")))))
    return per.select("classifier_id", F.inline(grid))


def class_names(dim: DataFrame) -> DataFrame:
    """(class_id, description) with one name per class and -1 = 'missed'."""
    names = one_description(dim)
    missed = names.sparkSession.createDataFrame([(MISSED, "missed")], "class_id int, description string")
    return names.unionByName(missed)


def annotate(dense: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Cell text, diagonal flag and 'true class never predicted' flag; labels if given."""
    w_true = Window.partitionBy("classifier_id", "true_class")
    is_diag = F.col("true_class") == F.col("pred_class")
    out = (dense.withColumn("annotation", labels.cell_annotation("n", "fraction"))
           .withColumn("is_diagonal", is_diag)
           .withColumn("never_predicted", ~F.max(is_diag).over(w_true)))
    if names is not None:
        # one map of the (bounded) names, computed once and looked up for both labels
        entries = F.collect_list(F.struct("class_id", "description"))
        lookup = names.where("class_id is not null").agg(F.map_from_entries(entries).alias("m")).select("m").scalar()
        out = out.withColumns({"true_label": F.try_element_at(lookup, F.col("true_class")),
                               "pred_label": F.try_element_at(lookup, F.col("pred_class"))})
    return out
