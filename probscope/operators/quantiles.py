"""Exact quantiles of large groups without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], bin_: Column,
                    count: str | None = None, few_groups: bool = False) -> DataFrame:
    """``by`` and one column per entry of ``probs`` (name -> share): the smallest value at or below which
    at least that share of the group's values lie. Nulls and NaN are left out. A row stands for ``count`` values, or one.

    ``bin_`` is a non-decreasing function of the value with a bounded number of results. Counts per (group, bin)
    locate the bin of each quantile; only the rows of these bins are counted by distinct value and ranked, so a
    hot group is never sorted in one task and the result is exact at any size.

    ``few_groups`` says that a catalogue bounds the groups: what is asked for is then sent to the tasks, and of the rows
    only those of the bins asked for are shuffled."""
    by = list(by)
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(
        *by, F.col(value).alias("_v"), bin_.alias("_bin"), (F.lit(1) if count is None else F.col(count)).alias("_n"))
    group = Window.partitionBy(*by)
    bins = rows.groupBy(*by, "_bin").agg(F.sum("_n").alias("_c"))
    bins = bins.withColumns({"_upto": F.sum("_c").over(group.orderBy("_bin")), "_total": F.sum("_c").over(group)})
    asked = F.array(*[F.struct(F.lit(n).alias("q"), F.lit(float(p)).alias("p")) for n, p in probs.items()])
    place = F.greatest(F.ceil(F.col("_q.p") * F.col("_total") - 1e-9), F.lit(1))
    target = (bins.select("*", F.explode(asked).alias("_q")).withColumn("_rank", place - (F.col("_upto") - F.col("_c")))
              .where((F.col("_rank") > 0) & (F.col("_rank") <= F.col("_c"))).select(*by, "_bin", "_q.q", "_rank"))
    if few_groups:
        target = F.broadcast(target)
    hits = rows.join(target, [*by, "_bin"]).groupBy(*by, "q", "_rank", "_v").agg(F.sum("_n").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*by, "q").orderBy("_v"))
    found = hits.withColumn("_upto", upto).where(F.col("_upto") >= F.col("_rank"))
    return found.groupBy(*by).agg(*[F.min(F.when(F.col("q") == n, F.col("_v"))).alias(n) for n in probs])
