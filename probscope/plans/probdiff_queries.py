"""Probability-difference queries."""

from __future__ import annotations

from probscope.operators import explore as ex
from probscope.operators import probdiff as pd
from probscope.plans.registry import register
from probscope.sources.fixtures import Tables


@register("max_prob_by_timebin")
def max_prob_by_timebin(t: Tables):
    """Maximum true-class probability per object and time bin."""
    return pd.max_prob_by_timebin(t)


@register("probdiff_for_object")
def probdiff_for_object(t: Tables):
    """Differences for the object picked by the richness rule (3rd richest for classifier 1)."""
    found = pd.probdiff_for_objects(t, ex.richest_object(t, classifier_id=1, rank=3))
    return found.orderBy("classifier_id", "true_class_id", "dia_object_id", "earlytimebin", "latetimebin")


@register("probdiff_all_objects")
def probdiff_all_objects(t: Tables):
    """Late-minus-early differences of every object, classifier and true class."""
    return pd.probdiff(pd.max_prob_by_timebin(t))


@register("probdiff_hist")
def probdiff_hist(t: Tables):
    """Histogram of late-minus-early maximum true-class probability."""
    return pd.probdiff_hist(t).orderBy(*pd.GROUP, "probdiffbin")


@register("probdiff_hist_filled")
def probdiff_hist_filled(t: Tables):
    """Every difference bin 1..41 per (classifier, true class, early, late), zeros filled."""
    return pd.zero_fill(pd.probdiff_hist(t)).orderBy(*pd.GROUP, "probdiffbin")


@register("probdiff_hist_inner")
def probdiff_hist_inner(t: Tables):
    """The same without the outermost bins on either side."""
    return pd.zero_fill(pd.probdiff_hist(t), first=2, last=40)
