"""Time in units of a class's characteristic time, which the forced photometry gives.

The characteristic time of a light curve (the points of one object in one band) is its width at half maximum: from
the brightest point backwards and forwards to where straight lines between neighbouring points fall to half of
its flux. If one side never falls so low, twice the other side counts; curves that do on neither side, and curves without
a positive flux, have none. A class's time is the (lower) median over the curves of all its objects, exact at any size.

No curve is sorted: the brightest point, the nearest low point on either side and the neighbour between are each one
aggregate with partial sums, joined back by (object, band), so that a curve of any length is spread over the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probscope.functions import exact as X
from probscope.functions.bins import Bins
from probscope.operators import passes
from probscope.operators import probhist as ph
from probscope.operators.quantiles import exact_quantiles
from probscope.sources.fixtures import Tables

CURVE = ["dia_object_id", "filter_name"]
#: Bins of time rel. peak in units of the characteristic time.
SCALED = Bins(-2.0, 6.0, 16)
#: Widths are located to a tenth of a day up to so many days.
LONGEST = 10_000


def curve_points(t: Tables) -> DataFrame:
    """(dia_object_id, filter_name, t, flux): of several points of one time the brightest; unknown times or fluxes go."""
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    return (t.diaforcedsource.where(known("mid_point_tai") & known("ps_flux"))
            .groupBy(*CURVE, F.col("mid_point_tai").alias("t")).agg(F.max("ps_flux").alias("flux")))


def half_widths(points: DataFrame) -> DataFrame:
    """(dia_object_id, filter_name, width) of the curves that fall to half their maximum on one side at least."""
    # the brightest point, the earliest of several
    peak = points.groupBy(*CURVE).agg(F.max(F.struct("flux", (-F.col("t")).alias("less"))).alias("peak")).select(
        *CURVE, (-F.col("peak.less")).alias("top"), (F.col("peak.flux") / 2).alias("half")).where("half > 0")
    near = points.join(peak, CURVE)
    point = F.struct("t", "flux")
    low = F.col("flux") <= F.col("half")
    sides = near.groupBy(*CURVE, "top", "half").agg(
        F.max(F.when(low & (F.col("t") < F.col("top")), point)).alias("left"),
        F.min(F.when(low & (F.col("t") > F.col("top")), point)).alias("right"))
    sides = sides.where("left is not null or right is not null")
    # the point next to the low one, towards the peak, which is above half
    inner = points.join(sides, CURVE).groupBy(*CURVE, "top", "half", "left", "right").agg(
        F.min(F.when((F.col("t") > F.col("left.t")) & (F.col("t") <= F.col("top")), point)).alias("after"),
        F.max(F.when((F.col("t") < F.col("right.t")) & (F.col("t") >= F.col("top")), point)).alias("before"))

    def crossing(low: str, high: str) -> Column:
        a, b = F.col(low), F.col(high)
        return a["t"] + (F.col("half") - a["flux"]) / (b["flux"] - a["flux"]) * (b["t"] - a["t"])

    rise = F.col("top") - crossing("left", "after")
    fall = crossing("right", "before") - F.col("top")
    width = F.when(rise.isNull(), 2 * fall).when(fall.isNull(), 2 * rise).otherwise(rise + fall)
    return inner.select(*CURVE, width.alias("width"))


def characteristic_times(t: Tables) -> DataFrame:
    """(true_class_id, n_curves, tau): the median width of the curves of each class."""
    truth = t.truth.select("dia_object_id", "gentype").join(
        t.gentype.select("gentype", F.col("class_id").alias("true_class_id")), "gentype")
    widths = half_widths(curve_points(t)).join(truth, "dia_object_id").select("true_class_id", "width")
    bin_ = F.floor(F.least(F.col("width"), F.lit(float(LONGEST))) * 10)
    median = exact_quantiles(widths, ["true_class_id"], "width", {"tau": 0.5}, bin_)
    return widths.groupBy("true_class_id").agg(F.count(F.lit(1)).alias("n_curves")).join(median, "true_class_id")


def mean_prob_by_scaled_time(t: Tables) -> DataFrame:
    """Mean of the de-duplicated probabilities per (classifier, true class, bin of deltat / tau, class), with the bin's
    centre; classes without a characteristic time are left out."""
    taus = t.gentype.select("gentype", F.col("class_id").alias("true_class_id")).join(
        characteristic_times(t), "true_class_id").select("gentype", "true_class_id", "tau")
    scaled = SCALED.bucket(F.col("deltat") / F.col("tau"))
    by = ["classifier_id", "true_class_id", "scaled_bin", "class_id"]
    if (n := ph.slices(t)) > 1:
        taus = passes.stored([taus], "characteristic-times")
        means = ph.mean_cells(t, n, {"scaled_bin": scaled}, sums=True, extra=["true_class_id", "tau"],
                              described=lambda rows: rows.join(taus, "gentype")).groupBy(*by).agg(
            X.mean_of("s", F.sum("c")).alias("mean_prob"), F.sum("n").alias("n"))
    else:
        rows = ph.dedupe_mean(t).select("classifier_id", "class_id", "gentype", "deltat", "probability")
        means = (rows.join(taus, "gentype").withColumn("scaled_bin", scaled).groupBy(*by)
                 .agg(X.fmean("probability").alias("mean_prob"), F.count(F.lit(1)).alias("n")))
    return means.withColumn("scaled_time", SCALED.centre("scaled_bin"))
