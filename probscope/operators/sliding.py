"""Running means over overlapping windows of time relative to peak."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.functions import exact as X
from probscope.operators.intervals import interval_join
from probscope.operators.context import true_class_rows
from probscope.operators.probhist import message_source_context
from probscope.sources.fixtures import Tables


def mean_prob_by_window(t: Tables, windows: DataFrame) -> DataFrame:
    """(classifier_id, true_class_id, window, t0, t1, mean_prob, n): mean probability of the true class over all
    classifications whose time relative to peak lies in a window. Rows are summed per distinct time before they meet the
    windows, which may overlap and be many."""
    dim = t.gentype.select("gentype", F.col("class_id").alias("true_class_id"))
    ctx = message_source_context(t).select("broker_message_id", "deltat", "gentype").join(dim, "gentype")
    sums = (true_class_rows(t, ctx).groupBy("classifier_id", "true_class_id", "deltat")
            .agg(*X.partial("probability", "s"), F.count("probability").alias("c")))
    met = interval_join(sums, windows, "deltat", "t0", "t1", base=5.0)
    return met.groupBy("classifier_id", "true_class_id", "window", "t0", "t1").agg(
        X.mean_of("s", F.sum("c")).alias("mean_prob"), F.sum("c").alias("n"))
