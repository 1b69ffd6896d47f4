"""Confusion-matrix queries (all classifiers in one plan)."""

from __future__ import annotations

from probscope.operators import confusion as cm
from probscope.plans.registry import register
from probscope.sources.fixtures import Tables

OUT = ["pred_class", "true_class", "n", "classifier_id", "classifier_name"]


def _named(t: Tables, counts):
    return cm.with_classifier_name(counts, t.classifiers).select(*OUT)


@register("confusion_last_best")
def confusion_last_best(t: Tables):
    """Last alert, then highest probability, per classifier and object (INNER)."""
    return _named(t, cm.confusion_counts(t, "last_best"))


@register("confusion_best")
def confusion_best(t: Tables):
    """Highest probability over all messages, then latest alert."""
    return _named(t, cm.confusion_counts(t, "best"))


@register("confusion_nth")
def confusion_nth(t: Tables):
    """Highest probability on the 3rd detection of each object."""
    return _named(t, cm.confusion_counts(t, "nth", nth_detection=3))


@register("confusion_with_missed")
def confusion_with_missed(t: Tables):
    """last_best over sent objects, with missed objects as pred_class -1 (LEFT join semantics)."""
    return _named(t, cm.confusion_counts(t, "last_best", include_missed=True))


def _norm(t: Tables, norm: str):
    counts = cm.confusion_counts(t, "last_best", include_missed=True)
    return cm.normalize(counts, norm).select("classifier_id", "pred_class", "true_class", "n", "fraction")


@register("confusion_norm_true")
def confusion_norm_true(t: Tables):
    """Missed-inclusive last_best counts as fractions of each true class (completeness)."""
    return _norm(t, "true")


@register("confusion_norm_pred")
def confusion_norm_pred(t: Tables):
    """The same as fractions of each predicted class (purity)."""
    return _norm(t, "pred")


@register("confusion_norm_all")
def confusion_norm_all(t: Tables):
    """The same as fractions of each classifier's whole matrix."""
    return _norm(t, "all")


@register("confusion_dense")
def confusion_dense(t: Tables):
    """Dense matrix (zero cells filled) normalised by true class."""
    dense = cm.densify(cm.confusion_counts(t, "last_best", include_missed=True))
    return cm.normalize(dense, "true")


@register("confusion_annotated")
def confusion_annotated(t: Tables):
    """Dense matrix with cell text, diagonal marks, labels and classifier names."""
    dense = cm.normalize(cm.densify(cm.confusion_counts(t, "last_best", include_missed=True)), "true")
    out = cm.annotate(dense, cm.class_names(t.gentype_hier))
    return cm.with_classifier_name(out, t.classifiers).select(
        "classifier_id", "classifier_name", "true_class", "pred_class", "true_label", "pred_label", "n",
        "fraction", "annotation", "is_diagonal", "never_predicted")


@register("confusion_hier_best")
def confusion_hier_best(t: Tables):
    """'best' definition against the hierarchical truth map (an object counts once
    per class its gentype maps to)."""
    return _named(t, cm.confusion_counts(t, "best", hierarchical=True))

