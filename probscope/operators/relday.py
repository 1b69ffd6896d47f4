"""Per-day summaries relative to peak, closest-to-peak confusion columns and the
object / source / classification listings per classifier and true class.

``relday`` is ``deltat`` rounded half-to-even to whole days. Aggregates are
first taken per gentype (the truth attribute) and only then fanned out to
true classes through the small gentype -> class map, so the fan-out multiplies
aggregated rows, never classification rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probscope.functions import bins as B
from probscope.functions import exact as X
from probscope.operators import passes
from probscope.operators.context import classified, classified_sources, source_deltat
from probscope.operators.probhist import message_source_context, slices
from probscope.operators.reshape import message_arrays, per_message_argmax
from probscope.operators.quantiles import exact_quantiles
from probscope.operators.select_one import asc, desc, pick_one
from probscope.sources.fixtures import Tables

# Fixed value: the per-day summaries cover days -20..90 relative to peak.
RELDAY_RANGE = (-20, 90)


def relday(dt) -> "F.Column":
    return F.rint(F.col(dt) if isinstance(dt, str) else dt).cast("int")


def _true_classes(t: Tables, hierarchical: bool = False) -> DataFrame:
    dim = t.gentype_hier if hierarchical else t.gentype
    return dim.select("gentype", F.col("class_id").alias("true_class_id"))


def latest_message_rows(t: Tables) -> DataFrame:
    """Classification rows of the latest message per (classifier, source), all classes kept,
    with ``deltat`` and ``gentype``. Latest = ingest time, then message id."""
    ctx = message_source_context(t).select("broker_message_id", "dia_source_id", "ingest_ts", "deltat", "gentype")
    # picked as whole messages (an array of bounded size), so the classification rows are read once
    return _latest_of(message_arrays(t), ctx)


def _latest_of(msgs: DataFrame, ctx: DataFrame) -> DataFrame:
    latest = pick_one(msgs.join(ctx, "broker_message_id"), ["classifier_id", "dia_source_id"],
                      [desc("ingest_ts", nulls_first=False), desc("broker_message_id", nulls_first=False)],
                      ["broker_message_id", "deltat", "gentype", "probs"])
    return latest.select("broker_message_id", "classifier_id", "deltat", "gentype", F.inline("probs"))


def _sums_of_latest(t: Tables, n: int, sums: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``sums`` of the rows of ``latest_message_rows`` in ``n`` slices: the latest messages are found by their ids first, so
    that the probabilities are shuffled once. A sum may come in several rows."""
    msgs = passes.message_sources(t, latest=True)

    def part(k: int) -> DataFrame:
        arrays = passes.in_slice(message_arrays(t), passes.ID, k, n)
        rows = arrays.join(passes.in_slice(msgs.where("clean"), passes.ID, k, n), passes.ID)
        return sums(rows.select("classifier_id", "deltat", "gentype", F.inline("probs")))

    found = passes.stored((part(k) for k in range(n)), "latest")
    rest = msgs.where("not clean")
    if rest.isEmpty():
        return found
    return found.unionByName(passes.stored([sums(_latest_of(message_arrays(t), rest))], "latest"))


def all_rows_with_relday(t: Tables) -> DataFrame:
    """Every classification row with ``deltat``, ``relday``, ``gentype`` and source."""
    ctx = message_source_context(t).select("broker_message_id", "dia_source_id", "dia_object_id", "deltat", "gentype")
    return classified(t, ctx).withColumn("relday", relday("deltat"))


def classification_rows(t: Tables) -> DataFrame:
    """The classifications of each (classifier, true class) with their day rel. peak (the 'classifications' listing)."""
    rows = all_rows_with_relday(t).join(_true_classes(t), "gentype")
    return rows.select("classifier_id", "true_class_id", "dia_source_id", "class_id", "relday", "probability")


def prob_by_relday(t: Tables, lo: int = RELDAY_RANGE[0], hi: int = RELDAY_RANGE[1]) -> DataFrame:
    """(classifier_id, true_class_id, relday, class_id, mean_probability, max_probability, n)
    over the latest message per classifier and source, reldays in [lo, hi]."""
    def sums(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("relday", relday("deltat")).where(F.col("relday").between(lo, hi))
        return rows.groupBy("classifier_id", "gentype", "relday", "class_id").agg(
            *X.partial("probability", "s"), F.max("probability").alias("m"), F.count("probability").alias("c"))

    per_gentype = _sums_of_latest(t, n, sums) if (n := slices(t)) > 1 else sums(latest_message_rows(t))
    return (per_gentype.join(_true_classes(t), "gentype")
            .groupBy("classifier_id", "true_class_id", "relday", "class_id")
            .agg(X.mean_of("s", F.sum("c")).alias("mean_probability"), F.max("m").alias("max_probability"),
                 F.sum("c").alias("n")))


def top_classes(means: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` classes with the highest peak mean probability per (classifier, true class)."""
    peak = pick_one(means, ["classifier_id", "true_class_id", "class_id"],
                    [desc("mean_probability"), asc("relday")], ["mean_probability", "relday"])
    peak = peak.select("classifier_id", "true_class_id", "class_id",
                       F.col("mean_probability").alias("peak_probability"), F.col("relday").alias("peak_relday"))
    w = Window.partitionBy("classifier_id", "true_class_id").orderBy(F.desc("peak_probability"), F.asc("class_id"))
    return peak.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_class_curves(means: DataFrame, k: int = 5) -> DataFrame:
    """The per-day curves of the ``k`` classes with the highest peak mean probability
    per (classifier, true class): windows over the aggregated means (one row per
    class and day), so the means are read once."""
    peak = F.max("mean_probability").over(Window.partitionBy("classifier_id", "true_class_id", "class_id"))
    ranked = means.withColumn("peak_probability", peak).withColumn(
        "rank", F.dense_rank().over(Window.partitionBy("classifier_id", "true_class_id")
                                    .orderBy(F.desc("peak_probability"), F.asc("class_id"))))
    return ranked.where(F.col("rank") <= k).drop("peak_probability")


def closest_to_peak_picks(t: Tables, band: str = "r") -> DataFrame:
    """Per (classifier, object), in one aggregate: the classified ``band`` source with
    the smallest |deltat| (ties to the smaller source id) and, among that source's
    messages, the highest-probability class (ties to the smaller class).

    Returns classifier_id, dia_object_id, dia_source_id, deltat, gentype, class_id."""
    ctx = (message_source_context(t).where(F.col("filter_name") == band)
           .select("broker_message_id", "dia_source_id", "dia_object_id", "deltat", "gentype"))
    rows = per_message_argmax(t).join(ctx, "broker_message_id")
    order = [asc(F.abs(F.col("deltat"))), asc("dia_source_id"), desc("probability"), asc("class_id")]
    return pick_one(rows, ["classifier_id", "dia_object_id"], order,
                    ["dia_source_id", "deltat", "gentype", "class_id"])


def closest_to_peak_sources(t: Tables, band: str = "r") -> DataFrame:
    """Per (classifier, object): the classified ``band`` source closest to peak."""
    return closest_to_peak_picks(t, band).drop("class_id")


def peak_confusion_column(t: Tables, band: str = "r") -> DataFrame:
    """Confusion column from the highest-probability class at the source closest to peak:
    (classifier_id, true_class_id, pred_class, n, percent)."""
    pred = closest_to_peak_picks(t, band)
    counts = (pred.groupBy("classifier_id", "gentype", F.col("class_id").alias("pred_class"))
              .agg(F.count(F.lit(1)).alias("n"))
              .join(_true_classes(t), "gentype")
              .groupBy("classifier_id", "true_class_id", "pred_class").agg(F.sum("n").alias("n")))
    total = F.sum("n").over(Window.partitionBy("classifier_id", "true_class_id"))
    return counts.withColumn("percent", F.col("n") / total * 100.0)


def closest_to_peak_stats(t: Tables, band: str = "r") -> DataFrame:
    """Mean and RMS of deltat of the chosen sources per (classifier, true class)."""
    chosen = closest_to_peak_sources(t, band)
    per_gentype = chosen.groupBy("classifier_id", "gentype").agg(
        F.count(F.lit(1)).alias("c"), F.sum("deltat").alias("s"), F.sum(F.col("deltat") * F.col("deltat")).alias("s2"))
    return (per_gentype.join(_true_classes(t), "gentype")
            .groupBy("classifier_id", "true_class_id")
            .agg(F.sum("c").alias("n_objects"), (F.sum("s") / F.sum("c")).alias("mean_deltat"),
                 F.sqrt(F.sum("s2") / F.sum("c")).alias("rms_deltat")))


def relday_distribution(t: Tables) -> DataFrame:
    """Spread of raw probabilities per (classifier, true class, relday, class):
    count, min, max, mean (exact, mergeable aggregates)."""
    rows = all_rows_with_relday(t)
    per_gentype = (rows.groupBy("classifier_id", "gentype", "relday", "class_id")
                   .agg(F.count(F.lit(1)).alias("c"), F.min("probability").alias("lo"),
                        F.max("probability").alias("hi"), *X.partial("probability", "s")))
    return (per_gentype.join(_true_classes(t), "gentype")
            .groupBy("classifier_id", "true_class_id", "relday", "class_id")
            .agg(F.sum("c").alias("n"), F.min("lo").alias("min_probability"), F.max("hi").alias("max_probability"),
                 X.mean_of("s", F.sum("c")).alias("mean_probability")))


def relday_quantiles(t: Tables, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact lower quantiles of raw probabilities per (classifier, true class, relday, class), groups of any
    size. Columns ``q25``, ``q50``, ``q75`` for the default ``probs``."""
    rows = all_rows_with_relday(t).join(_true_classes(t), "gentype")
    inside = F.least(F.greatest(F.col("probability"), F.lit(0.0)), F.lit(1.0))
    return exact_quantiles(rows, ["classifier_id", "true_class_id", "relday", "class_id"], "probability",
                           {f"q{int(round(p * 100))}": p for p in probs}, F.floor(inside * 1000), few_groups=True)


def prob_histogram_closed(t: Tables, n_bins: int = 20) -> DataFrame:
    """``numpy.histogram(p, linspace(0, 1, 21))`` per (classifier, true class, relday, class):
    non-empty bins, the last bin closed, values outside [0, 1] dropped."""
    rows = all_rows_with_relday(t).withColumn("bin", B.closed_histogram_bin("probability", 0.0, 1.0, n_bins))
    per_gentype = (rows.where(F.col("bin").isNotNull())
                   .groupBy("classifier_id", "gentype", "relday", "class_id", "bin")
                   .agg(F.count(F.lit(1)).alias("c")))
    return (per_gentype.join(_true_classes(t), "gentype")
            .groupBy("classifier_id", "true_class_id", "relday", "class_id", "bin").agg(F.sum("c").alias("n")))


def source_summary(t: Tables) -> DataFrame:
    """Sources classified by each classifier, with truth info (the 'sources' listing)."""
    src = source_deltat(t).select("dia_source_id", "dia_object_id", "filter_name", "deltat", "gentype")
    return (classified_sources(t).join(src, "dia_source_id").join(_true_classes(t), "gentype")
            .select("classifier_id", "true_class_id", "dia_object_id", "dia_source_id", "filter_name", "deltat"))


def object_summary(t: Tables) -> DataFrame:
    """Objects classified by each classifier, with truth info (the 'objects' listing)."""
    objs = (classified_sources(t).join(t.diasource.select("dia_source_id", "dia_object_id"), "dia_source_id")
            .select("classifier_id", "dia_object_id").distinct())
    return (objs.join(t.truth, "dia_object_id").join(_true_classes(t), "gentype")
            .select("classifier_id", "true_class_id", "dia_object_id", "gentype", "peakmjd"))


def classification_summary(t: Tables) -> DataFrame:
    """Rows, distinct sources and distinct objects per (classifier, true class); the
    distinct counts are exact and built from nested partial aggregates (no Expand)."""
    ctx = message_source_context(t).select("broker_message_id", "dia_source_id", "dia_object_id", "gentype")
    if t.message_probs is None:
        per_msg = t.broker_classification.groupBy("broker_message_id", "classifier_id").agg(F.count(F.lit(1)).alias("c"))
    else:
        per_msg = t.message_probs.where(F.size("probs") > 0).select(
            "broker_message_id", "classifier_id", F.size("probs").cast("long").alias("c"))
    per_src = (per_msg.join(ctx, "broker_message_id")
               .groupBy("classifier_id", "gentype", "dia_object_id", "dia_source_id").agg(F.sum("c").alias("c")))
    per_obj = per_src.groupBy("classifier_id", "gentype", "dia_object_id") \
        .agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("ns"))
    per_gt = per_obj.groupBy("classifier_id", "gentype") \
        .agg(F.sum("c").alias("c"), F.sum("ns").alias("ns"), F.count(F.lit(1)).alias("no"))
    return (per_gt.join(_true_classes(t), "gentype").groupBy("classifier_id", "true_class_id")
            .agg(F.sum("c").alias("n_rows"), F.sum("ns").alias("n_sources"), F.sum("no").alias("n_objects")))
