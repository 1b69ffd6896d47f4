"""The verdict on an object as its alerts come in: after k alerts, the best classification so far.

A classifier's verdict after the k-th alert of an object is the class of the classification that comes first
in the order of ``best`` (highest probability, then the most recent alert) among those of the object's first k
alerts, counted by time and source id. An object is counted up to its last alert, by a classifier from
the first alert on that it has classified.

No object is scanned in one task: a running maximum is taken inside buckets of ``SPAN`` alerts, the maxima of the buckets
before are added to it (one row per bucket), and what is counted are changes, +1 for the new verdict and -1 for the one
it replaces, whose running sums over k are the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from probscope.operators import passes
from probscope.operators.confusion import DEFINITIONS, TIE_BREAK
from probscope.operators.diagnostics import detection_ordinals
from probscope.operators.reshape import per_message_argmax
from probscope.operators.select_one import order_key
from probscope.sources.fixtures import Tables

#: Alerts of a bucket.
SPAN = 1000
BY = ["classifier_id", "dia_object_id"]


def best_by_alert(t: Tables, most: int | None = None) -> DataFrame:
    """(classifier_id, dia_object_id, k, first): the row that comes first among those of the k-th alert, a struct of its
    place in the order and its class; alerts up to ``most``."""
    return _best_of(t, _numbered_alerts(t, most))


def _numbered_alerts(t: Tables, most: int | None) -> DataFrame:
    ordinals = detection_ordinals(t).withColumnRenamed("detection", "k")
    if most is not None:
        ordinals = ordinals.where(F.col("k") <= most)
    return (t.diaalert.select("alert_id", "dia_object_id", "dia_source_id", "alert_sent_ts").join(ordinals, "dia_source_id")
            .select("alert_id", "dia_object_id", "alert_sent_ts", "k"))


def _best_of(t: Tables, alerts: DataFrame) -> DataFrame:
    ctx = t.broker_message.select("broker_message_id", "alert_id").join(alerts, "alert_id")
    first = F.struct(order_key(DEFINITIONS["best"] + TIE_BREAK).alias("place"), "class_id")
    return per_message_argmax(t).join(ctx, "broker_message_id").groupBy(*BY, "k").agg(F.max(first).alias("first"))


def verdict_changes(t: Tables, most: int | None = None) -> DataFrame:
    """(classifier_id, dia_object_id, k, class_id, change): the class that is the verdict from the k-th alert on (1) or no
    more (-1); the last verdict ends after the object's last alert (or the alert ``most``)."""
    # read four times below, from files instead of from the messages each time
    return _changes(passes.stored([best_by_alert(t, most)], "best-by-alert"), t, most)


def _changes(best: DataFrame, t: Tables, most: int | None) -> DataFrame:
    rows = best.withColumn("bucket", F.floor((F.col("k") - 1) / SPAN))
    inside = Window.partitionBy(*BY, "bucket").orderBy("k")
    before = Window.partitionBy(*BY).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = rows.groupBy(*BY, "bucket").agg(F.max("first").alias("first"))
    earlier = buckets.select(*BY, "bucket", F.max("first").over(before).alias("earlier"))
    upto = F.max("first").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    last = F.max("first").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    running = rows.select(*BY, "bucket", "k", upto.alias("now"), last.alias("last")).join(earlier, [*BY, "bucket"])
    now, last = F.greatest("now", "earlier").class_id, F.greatest("last", "earlier").class_id
    change = F.array(F.struct(now.alias("class_id"), F.lit(1).alias("change")),
                     F.struct(last.alias("class_id"), F.lit(-1).alias("change")))
    changes = (running.where(last.isNull() | (now != last)).select(*BY, "k", F.inline(change))
               .where(F.col("class_id").isNotNull()))
    n = t.diasource.groupBy("dia_object_id").agg(F.count(F.lit(1)).alias("n"))
    final = rows.groupBy(*BY).agg(F.max("first").class_id.alias("class_id")).join(n, "dia_object_id")
    end = F.col("n") if most is None else F.least("n", F.lit(most))
    return changes.unionByName(final.select(*BY, (end + 1).alias("k"), "class_id", F.lit(-1).alias("change")))


def confusion_by_alerts(t: Tables, most: int | None = 20) -> DataFrame:
    """(classifier_id, true_class, pred_class, k, n): confusion counts of the verdicts after k alerts, k from 1 up to
    ``most`` (to the largest number of alerts of an object if None)."""
    def changes_of(changes: DataFrame, t: Tables) -> DataFrame:
        return (changes.join(t.truth.select("dia_object_id", "gentype"), "dia_object_id")
                .groupBy("classifier_id", "gentype", F.col("class_id").alias("pred_class"), "k")
                .agg(F.sum("change").alias("change")))

    n = passes.slices(t)
    if n == 1:
        cells = changes_of(verdict_changes(t, most), t)
    else:  # the best row per alert in slices of messages, the changes in slices of objects
        alerts = passes.stored([_numbered_alerts(t, most)], "numbered-alerts")
        best = passes.stored((_best_of(passes.messages_in_slice(t, k, n), alerts) for k in range(n)), "best-by-alert")

        def part(k: int) -> DataFrame:
            of = lambda df: passes.in_slice(df, "dia_object_id", k, n)
            own = t.but(truth=of(t.truth), diasource=of(t.diasource))
            rows = of(best).groupBy(*BY, "k").agg(F.max("first").alias("first"))
            return changes_of(_changes(rows, own, most), own)

        cells = passes.stored((part(k) for k in range(n)), "verdict-cells")
    dim = t.gentype.select("gentype", F.col("class_id").alias("true_class"))
    cells = (cells.join(dim, "gentype").groupBy("classifier_id", "true_class", "pred_class", "k")
             .agg(F.sum("change").alias("change")))
    # a row per cell and alert at which it changes; its count holds until the next change
    over = Window.partitionBy("classifier_id", "true_class", "pred_class").orderBy("k")
    counts = cells.select("classifier_id", "true_class", "pred_class", "k", F.lead("k").over(over).alias("next"),
                          F.sum("change").over(over).alias("n")).where(F.col("n") > 0)
    return counts.select("classifier_id", "true_class", "pred_class",
                         F.explode(F.sequence(F.col("k"), F.col("next") - 1).cast("array<int>")).alias("k"), "n")


def accuracy_by_alerts(t: Tables, most: int | None = 20) -> DataFrame:
    """(classifier_id, true_class, k, n_objects, n_correct, share): objects whose verdict after k alerts is true."""
    right = F.when(F.col("pred_class") == F.col("true_class"), F.col("n")).otherwise(0)
    return (confusion_by_alerts(t, most).groupBy("classifier_id", "true_class", "k")
            .agg(F.sum("n").alias("n_objects"), F.sum(right).alias("n_correct"))
            .withColumn("share", F.col("n_correct") / F.col("n_objects")))
