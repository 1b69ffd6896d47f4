"""Registered queries: one per metric of the survey, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the domain tables derived from the given data set and runs
over all of them (all classifiers, true classes, objects). Double columns are
rounded to 6 places at the very end so that results are comparable across
engines whose float sums differ in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probscope.sources.fixtures import Tables, load_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(load_tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def round_half_up(c, places: int = 6):
    """``floor(x * 10^p + 0.5 + 1e-7) / 10^p``: the same IEEE operations in every engine. Exact ties are common
    (probabilities are small rationals); the tiny offset rounds them up also where another order of
    summation left the last bits different."""
    f = float(10 ** places)
    plain = F.abs(c) < 1e12
    return F.when(plain, F.floor(c * f + 0.5000001) / f).otherwise(c)


def finish(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (top level) to ``places``."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(round_half_up(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def queries() -> dict[str, QueryFn]:
    # import the modules that register queries
    from probscope.plans import catalog_queries, confusion_queries, explore_queries, probdiff_queries  # noqa: F401
    from probscope.plans import added_queries, incremental_queries, probhist_queries, relday_queries, service_queries  # noqa: F401
    return dict(_REGISTRY)
