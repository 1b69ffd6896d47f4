"""Catalogue queries: classes, taxonomy order, match levels, classifiers, JSON forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from probscope.operators import catalog as cat
from probscope.operators import confusion as cm
from probscope.plans.registry import register
from probscope.sources import io
from probscope.sources.fixtures import Tables


@register("class_catalog")
def class_catalog(t: Tables):
    """Classes in use with one description each and their classification counts."""
    return cat.class_catalog(t)


@register("taxonomy_order")
def taxonomy_order(t: Tables):
    """Classes in taxonomy order (zero-padded sort key), 'missed' first."""
    return cat.taxonomy_order(t)


@register("match_level")
def match_level(t: Tables):
    """Match level (exact/category/general/broad/none) and flags per class in use."""
    return cat.match_levels(t)


@register("match_rate_by_level")
def match_rate_by_level(t: Tables):
    """Share of objects whose last-best prediction matches the truth at each level."""
    return cat.match_rate_by_level(cm.confusion_counts(t, "last_best"), cat.class_catalog(t))


@register("classifier_catalog")
def classifier_catalog(t: Tables):
    """Classifier catalogue with titles, listing sort key and message/classification counts."""
    return cat.classifier_catalog(t)


def _catalog_entries(t: Tables):
    gentypes = t.gentype_hier.groupBy("class_id").agg(F.array_sort(F.collect_set("gentype")).alias("gentype"))
    return cat.with_match_levels(cat.class_catalog(t), keep=["description"]).join(gentypes, "class_id", "left")


@register("catalog_from_json")
def catalog_from_json(t: Tables):
    """Class catalogue rendered as the nested JSON document and parsed back into rows."""
    rows = io.parse_class_catalog(io.class_catalog_json(_catalog_entries(t)))
    return rows.select("class_id", "description", "exactmatch", "categorymatch", "generalmatch", "broadmatch",
                       F.array_join(F.col("gentype"), ",").alias("gentypes"))


@register("classifier_catalog_json")
def classifier_catalog_json(t: Tables):
    """Classifier catalogue with its message counts as JSON (keyed by id text) and parsed back."""
    entry = F.struct(F.col("classifier_id").cast("string").alias("key"),
                     F.struct(F.col("broker_name").alias("brokername"), F.col("broker_version").alias("brokerversion"),
                              F.col("classifier_name").alias("classifiername"),
                              F.col("classifier_params").alias("classifierparams"),
                              F.col("n_messages").alias("nmessages")).alias("value"))
    doc = cat.classifier_catalog(t).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    return io.parse_classifier_catalog(doc)


@register("tight_json_rows")
def tight_json_rows(t: Tables):
    """Per-day means as one pandas 'tight' document per (classifier, true class), parsed back."""
    from probscope.operators import relday as rd
    means = rd.prob_by_relday(t)
    docs = io.to_tight_json(means, ["classifier_id", "true_class_id"], ["relday", "class_id"],
                            ["mean_probability", "n"])
    return io.parse_tight_json(docs, keep=["classifier_id", "true_class_id"], index_names=["relday", "class_id"],
                               columns=["mean_probability", "n"], types={"relday": "int", "class_id": "int", "n": "long"})


@register("tight_json_sources")
def tight_json_sources(t: Tables):
    """The sources of each classified object, with 64-bit ids and band names, as one 'tight' document per object,
    parsed back."""
    from probscope.operators import relday as rd
    by = ["classifier_id", "true_class_id", "dia_object_id"]
    docs = io.to_tight_json(rd.source_summary(t), by, ["dia_source_id"], ["filter_name", "deltat"])
    return io.parse_tight_json(docs, keep=by, index_names=["dia_source_id"], columns=["filter_name", "deltat"],
                               types={"dia_source_id": "long", "filter_name": "string"})
