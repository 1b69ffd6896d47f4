"""Interval joins by equality of grid cells, for any number of overlapping intervals.

An interval [lo, hi) is put on the grid whose cells are at least as long as it is, the finest of those whose widths are
powers of two times ``base``, where it meets two cells at most. A point has one cell on each grid that is in
use. So both sides join on (grid, cell), which Spark shuffles or broadcasts by size like any equi-join, and the exact
test follows. A point is repeated once per grid in use, which are as many as the intervals' lengths have doublings.
Intervals without an end are on a grid of one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The grid of one cell, and the coarsest other one.
WHOLE, COARSEST = 99, 60


def _grid(lo: Column, hi: Column, base: float) -> Column:
    level = F.ceil(F.log2(F.greatest((hi - lo) / base, F.lit(1.0)))).cast("int")
    return F.when((hi - lo) < float("inf"), F.when(level <= COARSEST, level)).otherwise(None)


def _cell(x: Column, level: Column, base: float) -> Column:
    return F.floor(x / (F.pow(F.lit(2.0), level) * base))


def interval_join(points: DataFrame, intervals: DataFrame, x: str, lo: str, hi: str, base: float = 1.0) -> DataFrame:
    """All pairs of a point and an interval with ``lo <= x < hi``: the columns of both. Null or NaN points and bounds, and
    empty intervals, match nothing."""
    real = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    a, b = F.col(lo).cast("double"), F.col(hi).cast("double")
    spans = intervals.where(real(lo) & real(hi) & (a < b)).withColumn("_grid", F.coalesce(_grid(a, b, base), F.lit(WHOLE)))
    first = F.when(F.col("_grid") == WHOLE, F.lit(0)).otherwise(_cell(a, F.col("_grid"), base)).cast("long")
    # a bound that is a cell's edge does not reach into that cell
    last = F.when(F.col("_grid") == WHOLE, F.lit(0)).otherwise(F.greatest(
        first, -F.floor(-b / (F.pow(F.lit(2.0), F.col("_grid")) * base)) - 1)).cast("long")
    spans = spans.withColumn("_cell", F.explode(F.sequence(first, last)))
    grids = sorted(r["_grid"] for r in spans.select("_grid").distinct().collect())  # one for each doubling of lengths
    p = F.col(x).cast("double")
    cell = lambda g: F.lit(0) if g == WHOLE else _cell(p, F.lit(g), base)
    where = F.array(*[F.struct(F.lit(g).alias("_grid"), cell(g).cast("long").alias("_cell")) for g in grids or [WHOLE]])
    spread = points.where(real(x)).select("*", F.inline(where))
    met = spread.join(spans, ["_grid", "_cell"]).where((F.col(x) >= F.col(lo)) & (F.col(x) < F.col(hi)))
    return met.drop("_grid", "_cell")


def sliding_windows(spark, first: float, last: float, width: float, step: float) -> DataFrame:
    """(window, t0, t1): overlapping windows of ``width`` every ``step`` from ``first`` on, while they begin before ``last``."""
    n = int(-(-(last - first) // step))
    at = F.col("id") * float(step) + float(first)
    return spark.range(n).select((F.col("id") + 1).cast("int").alias("window"), at.alias("t0"), (at + float(width)).alias("t1"))
