"""Exploration queries: paging, the interesting-object picker and per-object views."""

from __future__ import annotations

from pyspark.sql import functions as F

from probscope.operators import explore as ex
from probscope.operators.context import source_classifications
from probscope.plans.registry import register
from probscope.sources.fixtures import Tables

PICK_CLASSIFIER, PICK_RANK = 1, 3


def _picked(t: Tables):
    return ex.richest_object(t, PICK_CLASSIFIER, PICK_RANK)


@register("page_offset_limit")
def page_offset_limit(t: Tables):
    """One classifier's classifications by object and ingest time, OFFSET 2000 LIMIT 1000."""
    return ex.classification_page(t, classifier_id=1, offset=2000, limit=1000)


@register("third_richest_object")
def third_richest_object(t: Tables):
    """The 3rd object by number of classifications from classifier 1."""
    return _picked(t)


@register("object_prob_history")
def object_prob_history(t: Tables):
    """Probability of the true class over time for the picked object, every classifier."""
    return ex.object_prob_history(t, _picked(t))


@register("light_curve")
def light_curve(t: Tables):
    """Forced photometry of the picked object."""
    return ex.light_curve(t, _picked(t))


@register("classifications_with_deltat")
def classifications_with_deltat(t: Tables):
    """Classifications with deltat for the classifiers of one broker (IN-list as a semi
    join on the catalogue) and true class 2222."""
    cfers = t.classifiers.where(F.col("broker_name") == "Aster")
    return ex.classifications_with_deltat(t, cfers, true_class_id=2222)


@register("first_classifications")
def first_classifications(t: Tables):
    """The first 10000 of these rows by object, time, message and class (LIMIT after ORDER BY)."""
    return ex.classifications_with_deltat(t, t.classifiers, true_class_id=2222, limit=10_000)


@register("predicate_rows")
def predicate_rows(t: Tables):
    """Classifications of every classifier filtered by a predicate given as text."""
    view = source_classifications(t).where("probability >= 0.25 AND class_id <> true_class_id AND alert_sent_ts IS NOT NULL")
    return view.select("classifier_id", "true_class_id", "class_id", "alert_id", "broker_message_id", "probability")


@register("prob_matrix_pivot")
def prob_matrix_pivot(t: Tables):
    """deltat x class matrix of rounded probabilities for the picked object, per classifier."""
    hist = (source_classifications(t).join(_picked(t).select("dia_object_id"), "dia_object_id", "left_semi")
            .join(t.diasource.select("dia_source_id", "mid_point_tai"), "dia_source_id")
            .join(t.truth.select("dia_object_id", "peakmjd"), "dia_object_id")
            .withColumn("deltat", F.col("mid_point_tai") - F.col("peakmjd")))
    return ex.prob_matrix(hist, ex.catalogue_classes(t))


@register("semi_join_class_objects")
def semi_join_class_objects(t: Tables):
    """Class-2222 classifications of objects whose gentype is one of class 2222's gentypes."""
    return ex.semi_join_class_rows(t, 2222)


@register("naive_tbin_mean")
def naive_tbin_mean(t: Tables):
    """Mean probability of the true class per classifier, true class and 5-day bin (row-weighted)."""
    return ex.naive_tbin_mean(ex.true_class_rows(t), weight="row")


@register("object_weighted_tbin_mean")
def object_weighted_tbin_mean(t: Tables):
    """Same with every object weighted once per bin."""
    return ex.naive_tbin_mean(ex.true_class_rows(t), weight="object")


@register("class_histogram10")
def class_histogram10(t: Tables):
    """10 equal-width bins over each classifier's range of predicted class ids."""
    return ex.equal_width_histogram(t.broker_classification, "class_id", 10, by=["classifier_id"])
