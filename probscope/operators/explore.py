"""Exploration operators: paging, picking an interesting object, per-object views,
pivots and simple histograms over classification rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probscope.functions import bins as B
from probscope.functions import exact as X
from probscope.operators.context import message_context, source_classifications, truth_classes
from probscope.operators.context import true_class_rows as message_true_class_rows
from probscope.sources.fixtures import Tables

VIEW_COLS = ["classifier_id", "dia_object_id", "class_id", "alert_id", "true_class_id", "probability",
             "ingest_ts", "alert_sent_ts"]


def page(df: DataFrame, order: Sequence, offset: int, limit: int) -> DataFrame:
    """``ORDER BY ... OFFSET m LIMIT n``; ``order`` must be a total order for a stable page.

    Planned as a bounded top-(m+n) per partition merged on the driver."""
    return df.orderBy(*order).offset(offset).limit(limit)


def classification_page(t: Tables, classifier_id: int, offset: int = 2000, limit: int = 1000) -> DataFrame:
    """A page of one classifier's classifications ordered by object and ingest time
    (then class and message id, which make the order total); NULLs last, as
    PostgreSQL orders ASC."""
    view = source_classifications(t).where(F.col("classifier_id") == classifier_id)
    order = [F.asc_nulls_last(c) for c in ("dia_object_id", "ingest_ts", "class_id", "broker_message_id")]
    return page(view.select(*VIEW_COLS, "broker_message_id"), order, offset, limit).select(*VIEW_COLS)


def richest_objects(df: DataFrame, key: str = "dia_object_id") -> DataFrame:
    """(key, n) value counts, the "richness" of each object."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def richest_object(t: Tables, classifier_id: int = 1, rank: int = 3) -> DataFrame:
    """The ``rank``-th richest object (most classification rows from ``classifier_id``;
    ties to the smaller id) with its row count and true class."""
    per_message = (t.broker_classification.where(F.col("classifier_id") == classifier_id)
                   .groupBy("broker_message_id").agg(F.count(F.lit(1)).alias("c")))
    counts = (per_message.join(message_context(t).select("broker_message_id", "dia_object_id"), "broker_message_id")
              .join(truth_classes(t), "dia_object_id").groupBy("dia_object_id").agg(F.sum("c").alias("n")))
    chosen = counts.orderBy(F.desc("n"), F.asc("dia_object_id")).offset(rank - 1).limit(1)
    return chosen.join(truth_classes(t, name="true_class_id"), "dia_object_id") \
        .select("dia_object_id", F.col("n").alias("n_classifications"), "true_class_id")


def object_prob_history(t: Tables, objects: DataFrame) -> DataFrame:
    """Probability given to the true class over time for the given objects (all classifiers), in time order."""
    view = source_classifications(t).join(objects.select("dia_object_id"), "dia_object_id", "left_semi")
    src = t.diasource.select("dia_source_id", "mid_point_tai")
    return (view.where(F.col("class_id") == F.col("true_class_id")).join(src, "dia_source_id")
            .select("classifier_id", "dia_object_id", "class_id", "alert_id", "true_class_id", "probability",
                    "alert_sent_ts", "mid_point_tai")
            .orderBy("classifier_id", "dia_object_id", "mid_point_tai", "alert_id"))


def light_curve(t: Tables, objects: DataFrame) -> DataFrame:
    """Forced photometry of the given objects, in time order: time, flux, error, band."""
    return (t.diaforcedsource.join(objects.select("dia_object_id"), "dia_object_id", "left_semi")
            .select("dia_object_id", "mid_point_tai", "ps_flux", "ps_flux_err", "filter_name")
            .orderBy("dia_object_id", "mid_point_tai", "filter_name"))


def classifications_with_deltat(t: Tables, classifiers: DataFrame, true_class_id: int,
                                limit: int | None = None) -> DataFrame:
    """Classifications of objects of one true class by a set of classifiers (semi join,
    the IN-list form), with ``deltat``; optionally the first ``limit`` by object and time."""
    view = (source_classifications(t).join(classifiers.select("classifier_id"), "classifier_id", "left_semi")
            .where(F.col("true_class_id") == true_class_id))
    src = t.diasource.select("dia_source_id", "mid_point_tai")
    peak = t.truth.select("dia_object_id", "peakmjd")
    out = (view.join(src, "dia_source_id").join(peak, "dia_object_id")
           .select("classifier_id", "dia_object_id", "class_id", "alert_id", "true_class_id", "probability",
                   "alert_sent_ts", (F.col("mid_point_tai") - F.col("peakmjd")).alias("deltat"),
                   "broker_message_id"))
    if limit is not None:
        out = out.orderBy("dia_object_id", F.asc_nulls_last("alert_sent_ts"), "broker_message_id", "class_id") \
            .limit(limit)
    return out.drop("broker_message_id")


def prob_matrix(df: DataFrame, class_ids: Sequence[int], by: Sequence[str] = ("classifier_id", "dia_object_id"),
                index: str = "deltat") -> DataFrame:
    """Wide (index x class) matrix of mean probability rounded to 2 places (half even), in one aggregation over the
    given class list; ``n_other`` counts the rows of classes outside it."""
    binned = df.withColumn("bin_prob", B.rint_round("probability", 2))
    cells = [F.avg(F.when(F.col("class_id") == c, F.col("bin_prob"))).alias(f"class_{c}") for c in class_ids]
    other = F.count_if(~F.coalesce(F.col("class_id").isin(list(class_ids)), F.lit(False))).alias("n_other")
    return binned.groupBy(*by, index).agg(*cells, other)


def catalogue_classes(t: Tables) -> list[int]:
    """The class ids of the catalogue, in order (bounded by the taxonomy)."""
    return sorted(r.class_id for r in t.gentype_hier.select("class_id").distinct().collect())


def objects_of_class(t: Tables, class_id: int) -> DataFrame:
    """Objects whose gentype is one of the gentypes of ``class_id`` (nested IN as two semi joins)."""
    gentypes = t.gentype_hier.where(F.col("class_id") == class_id).select("gentype")
    return t.truth.join(gentypes, "gentype", "left_semi").select("dia_object_id")


def semi_join_class_rows(t: Tables, class_id: int) -> DataFrame:
    """Classifications of ``class_id`` for objects of that class, with time rel. peak."""
    view = (source_classifications(t).join(objects_of_class(t, class_id), "dia_object_id", "left_semi")
            .where(F.col("class_id") == class_id))
    src = t.diasource.select("dia_source_id", "mid_point_tai")
    peak = t.truth.select("dia_object_id", "peakmjd")
    return (view.join(src, "dia_source_id").join(peak, "dia_object_id")
            .select("classifier_id", "dia_object_id", "class_id", "alert_id", "probability", "alert_sent_ts",
                    "mid_point_tai", "peakmjd", (F.col("mid_point_tai") - F.col("peakmjd")).alias("deltat"),
                    "true_class_id"))


def true_class_rows(t: Tables) -> DataFrame:
    """Classifications of each object's true class, every class, with time rel. peak."""
    # alerts meet sources and truth before the messages, of which an alert has many, and the classifications come last,
    # so that none of their rows is shuffled again
    src = t.diasource.select("dia_source_id", "mid_point_tai")
    peak = t.truth.select("dia_object_id", "peakmjd")
    alerts = (t.diaalert.select("alert_id", "dia_source_id", "dia_object_id").join(src, "dia_source_id")
              .join(peak, "dia_object_id").join(truth_classes(t, name="true_class_id"), "dia_object_id")
              .select("alert_id", "dia_object_id", "true_class_id",
                      (F.col("mid_point_tai") - F.col("peakmjd")).alias("deltat")))
    ctx = t.broker_message.select("broker_message_id", "alert_id").join(alerts, "alert_id").drop("alert_id")
    return message_true_class_rows(t, ctx).select("classifier_id", "true_class_id", "dia_object_id", "probability", "deltat")


def naive_tbin_mean(rows: DataFrame, weight: str = "row") -> DataFrame:
    """Mean probability per classifier, true class and 5-day bin ``floor((dt + 20) / 5)``.

    ``weight='row'`` averages rows (objects observed often weigh more);
    ``weight='object'`` averages per object first."""
    binned = rows.withColumn("tbin", B.five_day_bin("deltat").cast("long"))
    if weight == "object":
        binned = (binned.groupBy("classifier_id", "true_class_id", "tbin", "dia_object_id")
                  .agg(X.fmean("probability").alias("probability")))
    elif weight != "row":
        raise ValueError("weight must be 'row' or 'object'")
    return binned.groupBy("classifier_id", "true_class_id", "tbin").agg(X.fmean("probability").alias("mean_prob"),
                                                       F.count(F.lit(1)).alias("n"))


def equal_width_histogram(df: DataFrame, value: str, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """``numpy.histogram(x, bins=n_bins)`` per group: n equal bins over the group's
    [min, max] (last bin closed), every bin listed with its edges and count.

    Rows are counted per distinct value first, with a map-side aggregate, and ranges and bins follow from these
    counts, so the rows are read once and never shuffled by a key of few values."""
    by = list(by)
    values = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    rng = values.groupBy(*by).agg(F.min(value).cast("double").alias("lo0"), F.max(value).cast("double").alias("hi0"))
    lo, hi = B.equal_width_range(F.col("lo0"), F.col("hi0"))
    rng = rng.select(*by, lo.alias("lo"), hi.alias("hi"))
    if by:
        binned = values.join(rng, by).select(
            *by, "c", B.closed_histogram_bin(value, F.col("lo"), F.col("hi"), n_bins).alias("bin"))
    else:  # one range for the whole frame: scalar subqueries, no join
        binned = values.select("c", B.closed_histogram_bin(
            value, rng.select("lo").scalar(), rng.select("hi").scalar(), n_bins).alias("bin"))
    counts = binned.groupBy(*by, "bin").agg(F.sum("c").alias("n"))
    spine = rng.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n_bins).cast("long")))
                       .alias("bin"))
    step = (F.col("hi") - F.col("lo")) / float(n_bins)
    return (spine.join(counts, [*by, "bin"], "left")
            .select(*by, "bin", (F.col("lo") + (F.col("bin") - 1).cast("double") * step).alias("bin_lo"),
                    F.when(F.col("bin") == n_bins, F.col("hi"))
                    .otherwise(F.col("lo") + F.col("bin").cast("double") * step).alias("bin_hi"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))
