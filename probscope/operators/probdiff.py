"""How confidence in the true class changes between time ranges.

For each classifier, true class and object: the maximum probability given to
the true class inside each time bin relative to peak (bins from a dimension
table, assigned with a range join to that broadcast table), then the
difference late minus early for every pair of bins with ``early < late``,
then a histogram of those differences.

Pairing is done inside one aggregate per (classifier, true class, object):
after the per-bin maximum an object has at most one row per time bin (the bin
dimension has 14 rows), so the array of its bins is bounded and the pairs
(at most 14*13/2) are generated from it; no self-join shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probscope.functions import bins as B
from probscope.operators.context import true_class_rows
from probscope.operators.probhist import message_source_context
from probscope.sources.fixtures import Tables

GROUP = ["classifier_id", "true_class_id", "earlytimebin", "latetimebin"]


def assign_timebin(df: DataFrame, timebins: DataFrame, dt: str = "deltat") -> DataFrame:
    """Range join ``dtmin <= dt < dtmax`` against the time-bin dimension (a literal one is marked for broadcast)."""
    tb = timebins.select("timebin", "dtmin", "dtmax")
    return df.join(tb, (F.col(dt) >= tb["dtmin"]) & (F.col(dt) < tb["dtmax"])).drop("dtmin", "dtmax")


def max_prob_by_timebin(t: Tables, hierarchical: bool = False) -> DataFrame:
    """(classifier_id, true_class_id, dia_object_id, timebin, maxprob): max probability
    of the true class per time bin."""
    dim = (t.gentype_hier if hierarchical else t.gentype).select("gentype", F.col("class_id").alias("true_class_id"))
    ctx = message_source_context(t).select("broker_message_id", "dia_object_id", "deltat", "gentype")
    ctx = assign_timebin(ctx.join(dim, "gentype"), t.timebins)
    rows = true_class_rows(t, ctx)
    return (rows.groupBy("classifier_id", "true_class_id", "dia_object_id", "timebin")
            .agg(F.max("probability").alias("maxprob")))


def probdiff(maxprob: DataFrame) -> DataFrame:
    """(classifier_id, true_class_id, dia_object_id, earlytimebin, latetimebin, probdiff)
    for every pair of the object's time bins with early < late."""
    per_obj = (maxprob.groupBy("classifier_id", "true_class_id", "dia_object_id")
               .agg(F.collect_list(F.struct("timebin", "maxprob")).alias("bins")))
    # the array is laid out twice, by compiled generators: lambdas over arrays are interpreted
    keys = ["classifier_id", "true_class_id", "dia_object_id"]
    early = per_obj.where(F.size("bins") > 1).select(*keys, "bins", F.explode("bins").alias("a"))
    return (early.select(*keys, "a", F.explode("bins").alias("b")).where(F.col("a.timebin") < F.col("b.timebin"))
            .select(*keys, F.col("a.timebin").alias("earlytimebin"), F.col("b.timebin").alias("latetimebin"),
                    (F.col("b.maxprob") - F.col("a.maxprob")).alias("probdiff")))


def with_bin_ranges(df: DataFrame, timebins: DataFrame) -> DataFrame:
    """Attach [t0, t1) of the early and late bins (the dimension joined twice)."""
    tb = timebins
    early = tb.select(F.col("timebin").alias("earlytimebin"), F.col("dtmin").alias("earlytimet0"),
                      F.col("dtmax").alias("earlytimet1"))
    late = tb.select(F.col("timebin").alias("latetimebin"), F.col("dtmin").alias("latetimet0"),
                     F.col("dtmax").alias("latetimet1"))
    return df.join(early, "earlytimebin").join(late, "latetimebin")


def probdiff_for_objects(t: Tables, objects: DataFrame) -> DataFrame:
    """Probability differences of the given objects (a ``dia_object_id`` frame)."""
    mp = max_prob_by_timebin(t).join(objects.select("dia_object_id"), "dia_object_id", "left_semi")
    return with_bin_ranges(probdiff(mp), t.timebins).select(
        "classifier_id", "true_class_id", "dia_object_id", "earlytimebin", "earlytimet0", "earlytimet1",
        "latetimebin", "latetimet0", "latetimet1", "probdiff")


def probdiff_hist(t: Tables) -> DataFrame:
    """Histogram of late-minus-early differences per (classifier, true class, early, late),
    with bin centre and the fraction of the group in each bin."""
    return described(probdiff_counts(probdiff(max_prob_by_timebin(t))), t.timebins)


def probdiff_counts(pairs: DataFrame) -> DataFrame:
    """(the group, probdiffbin, n) of differences."""
    return (pairs.groupBy(*GROUP, B.probdiffbin("probdiff").alias("probdiffbin"))
            .agg(F.count(F.lit(1)).alias("n")))


def described(hist: DataFrame, timebins: DataFrame) -> DataFrame:
    """The histogram with time ranges, bin centre and the fraction of its group in each bin."""
    frac = F.col("n") / F.sum("n").over(Window.partitionBy(*GROUP))
    out = hist.withColumn("binmeanprobdiff", B.probdiff_bin_mean("probdiffbin")).withColumn("frac", frac)
    return with_bin_ranges(out, timebins).select(
        "classifier_id", "true_class_id", "earlytimebin", "earlytimet0", "earlytimet1", "latetimebin",
        "latetimet0", "latetimet1", "probdiffbin", "binmeanprobdiff", "n", "frac")


def zero_fill(hist: DataFrame, first: int = 1, last: int = B.DIFFBINS.n) -> DataFrame:
    """Every probdiff bin ``first..last`` for every group present, absent bins with
    n = 0, frac = 0 and the bin centre.

    One aggregate per group (at most 41 bins) collects a bin -> (n, frac) map and
    the bin range is generated with ``sequence``; the histogram is read once."""
    per = hist.groupBy(*GROUP).agg(F.map_from_entries(F.collect_list(F.struct(
        "probdiffbin", F.struct("n", "frac")))).alias("m"))
    bins = F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))
    grid = F.transform(bins, lambda b: F.struct(
        b.alias("probdiffbin"),
        F.coalesce(F.element_at("m", b)["n"], F.lit(0)).cast("long").alias("n"),
        F.coalesce(F.element_at("m", b)["frac"], F.lit(0.0)).alias("frac")))
    return (per.select(*GROUP, F.inline(grid))
            .select(*GROUP, "probdiffbin", B.probdiff_bin_mean("probdiffbin").alias("binmeanprobdiff"), "n", "frac"))
