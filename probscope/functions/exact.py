"""Sums and means of probabilities that hardly depend on the order of the rows.

A double sum depends on the order rows arrive in, and for probabilities that are
small rationals (k/640 ...) the last bit decides how the printed value rounds. A
value is therefore split into a whole number of units of 2^-30, whose sums are exact,
and the rest of half a unit at most, an exact difference that is summed as a double: nothing is cut off, and
the sum is the right one but for its last rounding. The whole part is summed in two halves, each far from overflowing. Values that
are no ordinary numbers (NaN, infinite, beyond 4e9) go to the double sum whole, so NaN and
infinity come out as from a plain sum.

``partial`` / ``merged`` / ``total`` serve aggregates in two steps; ``fsum`` and ``fmean`` one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = float(1 << 30)
LARGEST = 4e9
HALF = 1 << 31


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _split(x) -> tuple[Column, Column, Column]:
    x = _c(x).cast("double")
    ordinary = F.abs(x) <= LARGEST  # false for NaN, which is the greatest number
    whole = F.when(ordinary, F.floor(x * UNITS + 0.5)).when(x.isNotNull(), F.lit(0))
    high = F.floor(whole / HALF)
    rest = F.when(ordinary, x - whole.cast("double") / UNITS).otherwise(x)
    return high, whole - high * HALF, rest


def partial(x, name: str) -> list[Column]:
    """The three partial sums of ``x`` as aggregates, columns ``<name>_h``, ``_l`` and ``_r``."""
    return [F.sum(c).alias(f"{name}_{k}") for k, c in zip("hlr", _split(x))]


def merged(name: str) -> Column:
    """The sum from partial sums, as an aggregate over them."""
    return total(*[F.sum(f"{name}_{k}") for k in "hlr"])


def total(high: Column, low: Column, rest: Column) -> Column:
    wide = high.cast("decimal(25,0)") * F.lit(HALF).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    # sums that fit a long, as all of a source or day do, need no decimals; the number is the same
    fits = high.between(-(HALF >> 1), HALF >> 1) & low.between(-(HALF << 30), HALF << 30)
    return F.when(fits, (high * HALF + low).cast("double")).otherwise(wide.cast("double")) / UNITS + rest


def fsum(x) -> Column:
    """Sum of a probability column (double); NULLs are ignored."""
    return total(*[F.sum(c) for c in _split(x)])


def fmean(x) -> Column:
    """Mean of a probability column (double); NULLs are ignored."""
    return fsum(x) / F.count(_c(x)).cast("double")


def mean_of(name: str, count) -> Column:
    """Mean from merged partial sums and a count."""
    return merged(name) / _c(count).cast("double")
