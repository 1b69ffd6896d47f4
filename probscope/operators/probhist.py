"""Probability histograms by class, true class and time relative to peak.

``probhist`` is the 2-D histogram (tbin x probbin) per classifier, predicted
class and true class, computed from de-duplicated classifications (repeated
messages of a classifier for one source are averaged). Everything downstream
(normalisation, expected probability, heat maps, violin tables) works on the
histogram, which is tiny, so only ``probhist`` touches classification rows.

Plan shape: where the messages are stored as arrays, message rows join the message-grain
context (source, deltat, gentype) and are shuffled once by (classifier, source); else
classification rows are, with a map-side-combined aggregate. The means per class are binned and counted per gentype *before* the
gentype -> class fan-out join, so the fan-out only multiplies histogram rows.

Many messages (``operators.passes``) are worked off in slices: which of them are alone with their classifier and source
is told from ids first, so that the probabilities are shuffled once, to meet their source, and a lone message is counted in its cell there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probscope.functions import bins as B
from probscope.functions import exact as X
from probscope.operators import passes
from probscope.operators.context import classified, laid_out, message_context, plain_arrays, source_deltat
from probscope.sources.fixtures import Tables

HIST_KEYS = ["classifier_id", "true_class_id", "class_id", "tbin", "probbin"]

# Time bins of the violin table, outline half-width per unit fraction,
# and the total-probability audit thresholds.
VIOLIN_TBINS = (5, 7, 13, 19, 27)
VIOLIN_HALF_WIDTH = 0.4
TOTPROB_HI, TOTPROB_LO = 1.001, 0.999

#: Messages of one alert up to which they meet in one task.
MANY_MESSAGES = passes.MANY_MESSAGES


def message_source_context(t: Tables) -> DataFrame:
    """(broker_message_id, alert_id, dia_source_id, dia_object_id, deltat, gentype, filter_name,
    alert_sent_ts, ingest_ts) at message grain.

    When ``t.context`` holds this table already written (the summary job does so
    once per run) it is read instead of repeating the three joins."""
    if t.context is not None:
        return t.context
    # alerts meet their sources first, so that the messages, of which an alert has many, are shuffled once for all of it;
    # both tables hold the object: joining on it, too, takes a filter on objects to both scans
    src = source_deltat(t).select("dia_source_id", "dia_object_id", "deltat", "gentype", "filter_name")
    alerts = t.diaalert.select("alert_id", "dia_source_id", "dia_object_id", "alert_sent_ts").join(
        src, ["dia_source_id", "dia_object_id"])
    return t.broker_message.select("broker_message_id", "alert_id", "ingest_ts").join(alerts, "alert_id").select(
        "dia_source_id", "dia_object_id", "broker_message_id", "alert_id", "ingest_ts", "alert_sent_ts", "deltat", "gentype",
        "filter_name")


def dedupe_mean(t: Tables, ctx: DataFrame | None = None) -> DataFrame:
    """Average probability per (classifier, source, class) over repeated messages.

    Returns classifier_id, dia_source_id, class_id, probability, n_messages,
    deltat, gentype (the last two are functions of the source)."""
    names = ["broker_message_id", "alert_id", "dia_source_id", "deltat", "gentype"]
    if t.message_probs is None:
        ctx = ctx if ctx is not None else message_source_context(t)
        return _mean_per_source(t.broker_classification.join(ctx.select(*names), "broker_message_id"))
    # message rows are shuffled by source, and the classes of a source's messages are averaged where they meet; a
    # source of very many messages (an alert is of one source) is averaged in parts first instead
    if ctx is None and slices(t) > 1:
        return _mean_of_sliced(t)
    many = (t.broker_message.groupBy("alert_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > MANY_MESSAGES).select("alert_id"))
    given = ctx if ctx is not None else t.context

    def part(how: str) -> DataFrame:
        # the messages themselves are parted, so that joins of the (mostly empty) second part end at once
        if given is not None:
            return given.join(many, "alert_id", how).select(*names)
        return message_source_context(t.but(broker_message=t.broker_message.join(many, "alert_id", how))).select(*names)

    rows = plain_arrays(t.message_probs).join(part("left_anti"), "broker_message_id")
    keys = ["classifier_id", "dia_source_id", "deltat", "gentype"]
    # a message that is alone with its classifier and source, and holds no class twice, is its own mean; the rows
    # of its classes need no aggregate, whose state would be a row per source and class
    met = Window.partitionBy("classifier_id", "dia_source_id")
    rows = (rows.select(*keys, "class_ids", "probabilities").repartition("classifier_id", "dia_source_id")
            .withColumn("alone", F.count(F.lit(1)).over(met) == 1))
    hot = classified(t, part("left_semi"))
    return _mean_where_alone(rows).unionByName(_mean_per_source(hot))


def _alone() -> Column:
    """A message that is alone, and holds no class twice."""
    return F.col("alone") & (F.size(F.array_distinct("class_ids")) == F.size("class_ids"))


def _mean_where_alone(rows: DataFrame) -> DataFrame:
    keys = ["classifier_id", "dia_source_id", "deltat", "gentype"]
    single = (rows.where(_alone()).select(*keys, laid_out())
              .withColumn("probability", F.col("probability").cast("double") + 0.0)  # a sum has no -0.0
              .withColumn("n_messages", F.lit(1).cast("long")))
    several = rows.where(~_alone()).select(*keys, laid_out())
    return single.unionByName(_mean_per_source(several))


def slices(t: Tables) -> int:
    """Into how many slices the histogram family works; only stored arrays without a context are cut."""
    return 1 if t.message_probs is None or t.context is not None else passes.slices(t)


def _mean_of_sliced(t: Tables) -> DataFrame:
    """``dedupe_mean`` where it is known beforehand which messages are alone: only the others meet by source."""
    return _mean_where_alone(plain_arrays(t.message_probs).join(passes.message_sources(t), passes.ID))


def mean_cells(t: Tables, n: int, keys: dict[str, Column], sums: bool = False, extra: Sequence[str] = (),
               described: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """The means of ``dedupe_mean`` counted per cell in ``n`` slices: classifier_id, class_id, gentype, the columns
    ``keys`` (of deltat, probability and ``extra``, which ``described`` adds to the messages), ``n``, and with ``sums`` the
    partial sums ``s_*`` and the number ``c`` of the means. A cell may come in several rows.

    One aggregate per slice of messages: the key of a lone message is its cell, that of another one its source, whose
    sums are then added up by slices of sources."""
    msgs = described(passes.message_sources(t))
    by = ["classifier_id", "class_id", "gentype", *extra]
    lone = F.col("lone")
    counted = [*X.partial("probability", "s"), F.count("probability").alias("c")] if sums else []

    def part(k: int) -> DataFrame:
        rows = passes.in_slice(plain_arrays(t.message_probs), passes.ID, k, n).join(
            passes.in_slice(msgs, passes.ID, k, n), passes.ID)
        rows = rows.select("classifier_id", "gentype", *extra, "dia_source_id", "deltat", _alone().alias("lone"), laid_out())
        value = F.col("probability") if sums else F.when(~lone, F.col("probability"))
        return rows.groupBy(*by, "lone", *[F.when(lone, c).alias(f"_{name}") for name, c in keys.items()],
                            *[F.when(~lone, F.col(c)).alias(c) for c in ("dia_source_id", "deltat")]).agg(
            *X.partial(value, "s"), F.count(value).alias("c"), F.count(F.lit(1)).alias("n"))

    first = passes.stored((part(k) for k in range(n)), "means")
    columns = [*by, *keys, *(["s_h", "s_l", "s_r", "c"] if sums else []), "n"]

    def means(k: int) -> DataFrame:
        rows = passes.in_slice(first.where(~lone), "dia_source_id", k, n)
        rows = rows.groupBy(*by, "dia_source_id", "deltat").agg(X.mean_of("s", F.sum("c")).alias("probability"))
        return rows.groupBy(*by, *[c.alias(name) for name, c in keys.items()]).agg(
            *counted, F.count(F.lit(1)).alias("n")).select(*columns)

    single = first.where(lone).withColumnsRenamed({f"_{name}": name for name in keys}).select(*columns)
    return single.unionByName(passes.stored((means(k) for k in range(n)), "mean-cells"))


def _mean_per_source(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("classifier_id", "dia_source_id", "class_id", "deltat", "gentype")
            .agg(X.fmean("probability").alias("probability"), F.count(F.lit(1)).alias("n_messages")))


def probhist(t: Tables, hierarchical: bool = False) -> DataFrame:
    """(classifier_id, class_id, true_class_id, tbin, probbin, n)."""
    keys = {"tbin": B.tbin("deltat"), "probbin": B.probbin(B.settled("probability"))}
    cells = ["classifier_id", "class_id", "gentype", *keys]
    if (n := slices(t)) > 1:
        per_gentype = mean_cells(t, n, keys).groupBy(*cells).agg(F.sum("n").alias("n"))
    else:
        ded = dedupe_mean(t).select("classifier_id", "class_id", "gentype", *[c.alias(name) for name, c in keys.items()])
        per_gentype = ded.groupBy(*cells).agg(F.count(F.lit(1)).alias("n"))
    dim = (t.gentype_hier if hierarchical else t.gentype).select("gentype", F.col("class_id").alias("true_class_id"))
    return (per_gentype.join(dim, "gentype")
            .groupBy("classifier_id", "class_id", "true_class_id", "tbin", "probbin")
            .agg(F.sum("n").alias("n")))


def normalize_over_probbin(hist: DataFrame, value: str = "n", out: str = "frac") -> DataFrame:
    """Fraction of each probbin within (classifier, true class, class, tbin)."""
    w = Window.partitionBy("classifier_id", "true_class_id", "class_id", "tbin")
    return hist.withColumn(out, F.col(value).cast("double") / F.sum(value).over(w))


def merge_top_bin(hist: DataFrame) -> DataFrame:
    """Lump probbin 21 (p >= 1) into 20 and re-count."""
    return (hist.withColumn("probbin", B.merge_top("probbin"))
            .groupBy(*HIST_KEYS).agg(F.sum("n").alias("n")))


def expected_probability(hist: DataFrame, zero_first_bin: bool = True) -> DataFrame:
    """Mean probability per (classifier, true class, tbin, class) from the histogram:
    sum over probbins of frac x bin centre. With ``zero_first_bin`` probbin 1 counts
    as probability 0 (most of it is an exact 0 reported by the classifier).

    Written as one aggregate with integer sums: inner bin ``b`` has centre
    ``(2b - 1) * w / 2`` and the outer bins -1 / +1, so the mean is
    ``(sum n (2b-1) * w/2 + n_over - n_under) / N`` with a single final division,
    exact up to that division and independent of summation order."""
    b, n = F.col("probbin"), F.col("n")
    first_inner = 2 if zero_first_bin else 1
    inner = (b >= first_inner) & (b <= B.PROBBINS.n)
    a = F.sum(F.when(inner, n * (2 * b - 1)).otherwise(0))
    edges = F.sum(F.when(b >= B.PROBBINS.n + 1, n).when(b <= 0, -n).otherwise(0))
    total = F.sum(n)
    prob = (a.cast("double") * (B.PROBBINS.width / 2.0) + edges.cast("double")) / total.cast("double")
    return hist.groupBy("classifier_id", "true_class_id", "tbin", "class_id").agg(prob.alias("prob"))


def lost_probability(expected: DataFrame) -> DataFrame:
    """Sum over classes of the expected probability per (classifier, true class, tbin).

    The per-class values (one per class, bounded by the taxonomy) are added in
    ascending order so the float sum does not depend on row arrival order."""
    vals = F.array_sort(F.collect_list("prob"))
    return (expected.groupBy("classifier_id", "true_class_id", "tbin")
            .agg(F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x).alias("total_prob")))


def heatmap(expected: DataFrame, n_tbins: int = B.TBINS.n + 2) -> DataFrame:
    """Wide form: one row per (classifier, true class, class), one column per tbin
    (``tbin_0`` .. ``tbin_27``); the tbin list is fixed so the pivot is one pass."""
    values = list(range(n_tbins))
    wide = (expected.groupBy("classifier_id", "true_class_id", "class_id")
            .pivot("tbin", values).agg(F.avg("prob")))
    return wide.select("classifier_id", "true_class_id", "class_id",
                       *[F.col(str(v)).alias(f"tbin_{v}") for v in values])


def violin_table(hist: DataFrame, confusion_classes: DataFrame, tbins=VIOLIN_TBINS,
                 half_width: float = VIOLIN_HALF_WIDTH) -> DataFrame:
    """Binned violin outline for chosen tbins and each true class's confusion classes:
    (classifier_id, true_class_id, tbin, class_id, probbin, prob, frac, half_width)."""
    norm = normalize_over_probbin(hist).where(F.col("tbin").isin(list(tbins)))
    return (norm.join(confusion_classes, ["true_class_id", "class_id"])
            .select("classifier_id", "true_class_id", "tbin", "class_id", "probbin",
                    B.probbin_val("probbin").alias("prob"), "frac",
                    (F.col("frac") * half_width).alias("half_width")))


def tbin_counts(hist: DataFrame) -> DataFrame:
    """Counts per (classifier, true class, tbin) over all classes and probbins, with the bin centre."""
    return (hist.groupBy("classifier_id", "true_class_id", "tbin").agg(F.sum("n").alias("n"))
            .withColumn("t", B.tbin_val("tbin")))


def mean_prob_by_tbin(t: Tables) -> DataFrame:
    """Mean of the de-duplicated (unbinned) probabilities per (classifier, true class, tbin, class)."""
    tbin = B.tbin("deltat")
    if (n := slices(t)) > 1:
        per_gentype = mean_cells(t, n, {"tbin": tbin}, sums=True).drop("c").withColumnRenamed("n", "c")
    else:
        per_gentype = (dedupe_mean(t).groupBy("classifier_id", "gentype", tbin.alias("tbin"), "class_id")
                       .agg(*X.partial("probability", "s"), F.count(F.lit(1)).alias("c")))
    return (per_gentype.join(t.gentype.select("gentype", F.col("class_id").alias("true_class_id")), "gentype")
            .groupBy("classifier_id", "true_class_id", "tbin", "class_id")
            .agg(X.mean_of("s", F.sum("c")).alias("mean_prob"), F.sum("c").alias("n")))


def totprob_per_source(t: Tables) -> DataFrame:
    """Total probability per (classifier, source) over all its classifications."""
    ctx = message_context(t).select("broker_message_id", "dia_source_id")
    per_msg = t.broker_classification.groupBy("broker_message_id", "classifier_id") \
        .agg(*X.partial("probability", "p"))
    return (per_msg.join(ctx, "broker_message_id")
            .groupBy("classifier_id", "dia_source_id").agg(X.merged("p").alias("totprob")))


def totprob_audit(tot: DataFrame, hi: float = TOTPROB_HI, lo: float = TOTPROB_LO) -> DataFrame:
    """Per classifier: pairs, and the shares with total probability above ``hi`` / below ``lo``."""
    return tot.groupBy("classifier_id").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg((F.col("totprob") > hi).cast("double")).alias("share_above"),
        F.avg((F.col("totprob") < lo).cast("double")).alias("share_below"),
    )


def prob_sum_check(t: Tables, tol: float = 1e-6) -> DataFrame:
    """Per classifier, at message grain: how many probability vectors sum to 1."""
    per_msg = t.broker_classification.groupBy("broker_message_id", "classifier_id") \
        .agg(X.fsum("probability").alias("total"))
    return per_msg.groupBy("classifier_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.sum((F.abs(F.col("total") - 1.0) <= tol).cast("long")).alias("n_sum_to_one"),
        F.min("total").alias("min_total"), F.max("total").alias("max_total"))
