"""Approximate summaries that merge: distinct counts and quantiles of any union of days, from stored sketches.

``build`` writes a sketch per (classifier, true class, day rel. peak) of the objects and sources seen, and one per
(classifier, true class, class, day) of the probabilities; ``distinct`` and ``quantiles`` merge those of the asked
days and read nothing else. The exact queries stay; these are named approximate. Errors:

* distinct counts (HyperLogLog, ``LG_K`` = 12): a relative standard error of 1.6 %, small counts nearly exact;
* quantiles (KLL, ``K`` = 200): the share of values below the answer is off by 1.7 % at most, with 99 % confidence, also
  after merging; ties and skew change nothing, since the error is one of rank. n is exact.

Sketches are taken per gentype and merged for the true classes that it belongs to.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.operators.relday import all_rows_with_relday, relday
from probscope.operators.probhist import message_source_context
from probscope.operators.diagnostics import message_classifiers
from probscope.sources.fixtures import Tables
from probscope.sources.io import join_path

LG_K, K = 12, 200
#: Bounds that tests and the registered queries hold the answers to: four standard errors, and the rank error above.
DISTINCT_ERROR, RANK_ERROR = 0.065, 0.02


def _true_classes(t: Tables) -> DataFrame:
    return t.gentype.select("gentype", F.col("class_id").alias("true_class_id"))


def distinct_sketches(t: Tables) -> DataFrame:
    """(classifier_id, true_class_id, relday, objects, sources): sketches of what the classifier saw on a day."""
    ctx = message_source_context(t).select("broker_message_id", "dia_source_id", "dia_object_id", "gentype",
                                           relday("deltat").alias("relday"))
    per = message_classifiers(t).join(ctx, "broker_message_id").groupBy("classifier_id", "gentype", "relday").agg(
        F.hll_sketch_agg("dia_object_id", LG_K).alias("objects"), F.hll_sketch_agg("dia_source_id", LG_K).alias("sources"))
    return per.join(_true_classes(t), "gentype").groupBy("classifier_id", "true_class_id", "relday").agg(
        F.hll_union_agg("objects").alias("objects"), F.hll_union_agg("sources").alias("sources"))


def quantile_sketches(t: Tables) -> DataFrame:
    """(classifier_id, true_class_id, class_id, relday, probs): sketches of the raw probabilities."""
    rows = all_rows_with_relday(t).where(F.col("probability").isNotNull() & ~F.isnan("probability"))
    per = rows.groupBy("classifier_id", "gentype", "class_id", "relday").agg(
        F.kll_sketch_agg_double("probability", K).alias("probs"))
    return per.join(_true_classes(t), "gentype").groupBy("classifier_id", "true_class_id", "class_id", "relday").agg(
        F.kll_merge_agg_double("probs").alias("probs"))


def build(t: Tables, root: str) -> None:
    distinct_sketches(t).write.partitionBy("classifier_id").parquet(join_path(root, "distinct"))
    quantile_sketches(t).write.partitionBy("classifier_id").parquet(join_path(root, "quantiles"))


def distinct(t: Tables, root: str, by: Sequence[str] = ("classifier_id", "true_class_id"),
             days: tuple[int, int] | None = None) -> DataFrame:
    """``by`` with approximate numbers of objects and sources over the days from the first to the last, or all."""
    rows = t.truth.sparkSession.read.parquet(join_path(root, "distinct"))
    rows = rows if days is None else rows.where(F.col("relday").between(*days))
    return rows.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("objects")).alias("approx_objects"),
                                 F.hll_sketch_estimate(F.hll_union_agg("sources")).alias("approx_sources"))


def quantiles(t: Tables, root: str, probs: Mapping[str, float], days: tuple[int, int] | None = None,
              by: Sequence[str] = ("classifier_id", "true_class_id", "class_id")) -> DataFrame:
    """``by`` with n, exact, and approximate quantiles of the probabilities, a column for each of ``probs``."""
    rows = t.truth.sparkSession.read.parquet(join_path(root, "quantiles"))
    rows = rows if days is None else rows.where(F.col("relday").between(*days))
    merged = rows.groupBy(*by).agg(F.kll_merge_agg_double("probs").alias("probs"))
    return merged.select(*by, F.kll_sketch_get_n_double("probs").alias("n"),
                         *[F.kll_sketch_get_quantile_double("probs", F.lit(float(p))).alias(c) for c, p in probs.items()])
