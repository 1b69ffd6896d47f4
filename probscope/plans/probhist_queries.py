"""Probability-histogram queries."""

from __future__ import annotations

from probscope.functions import bins as B
from probscope.operators import probhist as ph
from probscope.plans.registry import register
from probscope.sources.fixtures import Tables


@register("dedupe_mean")
def dedupe_mean(t: Tables):
    """Repeated classifier/source classifications averaged, per class."""
    return ph.dedupe_mean(t).select("classifier_id", "dia_source_id", "class_id", "probability", "n_messages")


@register("totprob_per_source")
def totprob_per_source(t: Tables):
    """Total probability per classifier and source (repeats add up)."""
    return ph.totprob_per_source(t)


@register("totprob_audit")
def totprob_audit(t: Tables):
    """Shares of (classifier, source) totals above 1.001 and below 0.999."""
    return ph.totprob_audit(ph.totprob_per_source(t))


@register("prob_sum_check")
def prob_sum_check(t: Tables):
    """How many messages' probabilities sum to one, per classifier."""
    return ph.prob_sum_check(t)


@register("probhist")
def probhist(t: Tables):
    """(classifier, class, true class, tbin, probbin) -> n."""
    return ph.probhist(t)


@register("probhist_hier")
def probhist_hier(t: Tables):
    """probhist against the hierarchical truth map (fan-out to coarser classes)."""
    return ph.probhist(t, hierarchical=True)


@register("probhist_normalized")
def probhist_normalized(t: Tables):
    """probhist with the fraction of each probbin within (class, tbin)."""
    return ph.normalize_over_probbin(ph.probhist(t))


@register("probhist_top_merged")
def probhist_top_merged(t: Tables):
    """probhist with the p >= 1 bin merged into the top bin."""
    return ph.merge_top_bin(ph.probhist(t))


@register("expected_prob_by_tbin")
def expected_prob_by_tbin(t: Tables):
    """Mean probability per class and tbin from the histogram (probbin 1 as 0), with labels."""
    return ph.expected_probability(ph.probhist(t)).withColumn("tbin_label", B.tbin_label("tbin"))


@register("expected_prob_heatmap")
def expected_prob_heatmap(t: Tables):
    """The same, one column per tbin (heat-map input)."""
    return ph.heatmap(ph.expected_probability(ph.probhist(t)))


@register("lost_probability")
def lost_probability(t: Tables):
    """Sum over classes of the expected probability per tbin."""
    return ph.lost_probability(ph.expected_probability(ph.probhist(t)))


@register("prob_violin_table")
def prob_violin_table(t: Tables):
    """Binned violin outlines for chosen tbins and confusion classes."""
    return ph.violin_table(ph.probhist(t), t.confusion_classes)


@register("tbin_counts")
def tbin_counts(t: Tables):
    """Counts per tbin over all classes and probbins, with the bin centre."""
    return ph.tbin_counts(ph.probhist(t))


@register("mean_prob_by_tbin")
def mean_prob_by_tbin(t: Tables):
    """Mean of the de-duplicated, unbinned probabilities per class and tbin."""
    return ph.mean_prob_by_tbin(t)

