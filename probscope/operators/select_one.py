"""Top-1-per-group ("DISTINCT ON") operators.

``pick_one`` keeps one row per group with ``max_by(struct(kept), struct(order))``.
Unlike ``row_number() OVER (...) = 1`` it is an ordinary aggregate: Spark
combines map-side before the shuffle, so a hot group (one object holding a
third of all rows) is reduced to one row per map task and never sorted in a
single task.

Because the aggregation buffer holds a struct, Spark runs it as a
(partial + final) SortAggregate: each map task sorts its own rows by the group
key and emits one row per group, and only those rows are shuffled.

Ordering is given as ``(column, 'desc' | 'asc', nulls_first)`` triples with
explicit NULL placement, because engines disagree on the default (PostgreSQL
puts NULLs first in DESC, Spark and DuckDB last).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[tuple[str | Column, str, bool]]


def desc(c, nulls_first: bool = True):
    """PostgreSQL DESC (NULLS FIRST)."""
    return (c, "desc", nulls_first)


def asc(c, nulls_first: bool = False):
    """PostgreSQL ASC (NULLS LAST)."""
    return (c, "asc", nulls_first)


def order_key(order: Order) -> Column:
    """A struct whose maximum is the row that sorts first under ``order``.

    Each term contributes a NULL-placement flag and the value (negated for
    ascending terms, so ascending terms must be numeric)."""
    fields = []
    for i, (c, direction, nulls_first) in enumerate(order):
        col = F.col(c) if isinstance(c, str) else c
        flag = col.isNull() if nulls_first else col.isNotNull()
        if direction == "desc":
            val = col
        elif direction == "asc":
            val = -col
        else:
            raise ValueError(f"direction must be 'asc' or 'desc', got {direction!r}")
        if direction == "asc":  # PostgreSQL holds NaN for the greatest number: last under ASC
            fields += [flag.alias(f"n{i}"), (~F.isnan(col.cast("double"))).alias(f"r{i}"), val.alias(f"v{i}")]
        else:
            fields += [flag.alias(f"n{i}"), val.alias(f"v{i}")]
    return F.struct(*fields)


def pick_one(df: DataFrame, by: Sequence[str], order: Order, keep: Sequence[str]) -> DataFrame:
    """One row per ``by`` group: the first under ``order``; returns ``by + keep``.

    Ties must be broken inside ``order`` (add unique keys last) for a
    deterministic result."""
    chosen = F.max_by(F.struct(*[F.col(k) for k in keep]), order_key(order)).alias("_pick")
    return df.groupBy(*by).agg(chosen).select(*by, *[F.col(f"_pick.{k}").alias(k) for k in keep])


def argmax(df: DataFrame, by: Sequence[str], value: str, keep: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Highest ``value`` per group, ties to the smallest ``tie`` columns."""
    return pick_one(df, by, [desc(value)] + [asc(t) for t in tie], keep)


def argmin(df: DataFrame, by: Sequence[str], value: str | Column, keep: Sequence[str],
           tie: Sequence[str] = ()) -> DataFrame:
    """Smallest ``value`` per group (numeric), ties to the smallest ``tie`` columns."""
    return pick_one(df, by, [asc(value)] + [asc(t) for t in tie], keep)


def one_description(dim: DataFrame, key: str = "class_id", text: str = "description") -> DataFrame:
    """One description per class (the catalogue may list a class several times);
    which one is unspecified upstream, the smallest is taken here."""
    return dim.groupBy(key).agg(F.min(text).alias(text))


def nth_ordinal_filter(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                       name: str = "ndetections") -> DataFrame:
    """Rows whose 1-based ordinal within ``by`` (under ``order``) equals ``n``.

    Written as ``row_number() ... = n`` so that Spark inserts a partial
    WindowGroupLimit before the shuffle: each map task forwards at most ``n``
    rows per group, which keeps a hot group cheap."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) == n)


def latest_per_group(df: DataFrame, by: Sequence[str], ts: str, tie: str, keep: Sequence[str] = ()) -> DataFrame:
    """The latest row per group by ``ts`` then ``tie`` (both descending, NULL oldest)."""
    return pick_one(df, by, [desc(ts, nulls_first=False), desc(tie, nulls_first=False)], [tie, *keep])
