"""Per-day (relday) and closest-to-peak queries, plus the per-classifier listings."""

from __future__ import annotations

from probscope.operators import relday as rd
from probscope.plans.registry import register
from probscope.sources.fixtures import Tables


@register("mean_prob_by_relday")
def mean_prob_by_relday(t: Tables):
    """Mean probability per class and day rel. peak (latest message per source), -20..90."""
    return rd.prob_by_relday(t).select("classifier_id", "true_class_id", "relday", "class_id",
                                       "mean_probability", "n")


@register("max_prob_by_relday")
def max_prob_by_relday(t: Tables):
    """Our definition of the per-day maximum: max at the same keys as the mean."""
    return rd.prob_by_relday(t).select("classifier_id", "true_class_id", "relday", "class_id",
                                       "max_probability", "n")


@register("top5_classes")
def top5_classes(t: Tables):
    """The five classes with the highest peak per-day mean probability."""
    return rd.top_classes(rd.prob_by_relday(t), 5)


@register("top5_curves")
def top5_curves(t: Tables):
    """Per-day mean probability curves of those five classes."""
    return rd.top_class_curves(rd.prob_by_relday(t), 5).select(
        "classifier_id", "true_class_id", "class_id", "rank", "relday", "mean_probability")


@register("peak_confusion_column")
def peak_confusion_column(t: Tables):
    """Confusion column from the highest-probability class at the r-band source closest to peak."""
    return rd.peak_confusion_column(t)


@register("closest_to_peak_stats")
def closest_to_peak_stats(t: Tables):
    """Mean and RMS of deltat of the sources closest to peak."""
    return rd.closest_to_peak_stats(t)


@register("relday_distribution")
def relday_distribution(t: Tables):
    """Count, min, max and mean of raw probabilities per day and class."""
    return rd.relday_distribution(t)


@register("prob_histogram_closed")
def prob_histogram_closed(t: Tables):
    """NumPy-style closed 20-bin histogram of raw probabilities per day and class."""
    return rd.prob_histogram_closed(t)


@register("object_summary")
def object_summary(t: Tables):
    """Objects classified by each classifier, with truth."""
    return rd.object_summary(t)


@register("source_summary")
def source_summary(t: Tables):
    """Sources classified by each classifier, with deltat and band."""
    return rd.source_summary(t)


@register("classification_summary")
def classification_summary(t: Tables):
    """Rows, distinct sources and distinct objects per classifier and true class."""
    return rd.classification_summary(t)


@register("relday_quantiles")
def relday_quantiles(t: Tables):
    """Quartiles of raw probabilities per day and class (exact)."""
    return rd.relday_quantiles(t)
