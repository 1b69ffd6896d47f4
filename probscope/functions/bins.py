"""Binning expressions: SQL ``width_bucket`` bins, bin centres, NumPy-style closed histograms.

Two histogram conventions exist and are kept apart on purpose:

* ``Bins.bucket`` is SQL ``width_bucket``: bin 0 below ``lo``, ``n + 1`` at or above
  ``hi`` (so probability 1.0 lands in bin 21 of 20).
* ``closed_histogram_bin`` is ``numpy.histogram`` on ``linspace`` edges: the last
  bin is closed, values outside are dropped (NULL), and the inexact edges
  (``3 * 0.05 = 0.15000000000000002``) are honoured.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class Bins:
    """``n`` equal bins over ``[lo, hi)`` plus under/overflow bins 0 and ``n + 1``."""

    lo: float
    hi: float
    n: int

    @property
    def width(self) -> float:
        return (self.hi - self.lo) / self.n

    def bucket(self, x) -> Column:
        """Bin number (bigint); NULL and NaN give NULL."""
        x = _c(x).cast("double")
        return F.width_bucket(x, F.lit(float(self.lo)), F.lit(float(self.hi)), F.lit(self.n))

    def clamp(self, b) -> Column:
        return F.least(F.greatest(_c(b).cast("double"), F.lit(0.0)), F.lit(float(self.n + 1)))

    def centre(self, b) -> Column:
        """Middle of bin ``b`` (clamped to 0..n+1); the outer bins get a half-width
        beyond the edge. Fractional bin numbers are accepted."""
        return (self.clamp(b) - 1.0) * self.width + self.lo + self.width / 2.0

    def edge_centre(self, b) -> Column:
        """Centre with the outer bins pinned to -1 and +1 (the probability-bin rule)."""
        cb = self.clamp(b)
        mid = (cb - 1.0) * self.width + self.width / 2.0
        return F.when(cb == 0.0, F.lit(-1.0)).when(cb == float(self.n + 1), F.lit(1.0)).otherwise(mid)


# Fixed bin settings of the metrics (time rel. peak, probability, probability difference).
TBINS = Bins(-30.0, 100.0, 26)
PROBBINS = Bins(0.0, 1.0, 20)
DIFFBINS = Bins(-1.025, 1.025, 41)


def tbin(dt) -> Column:
    return TBINS.bucket(dt)


def settled(x) -> Column:
    """``x`` to 12 places. Means of small rationals often lie on a bin's edge, where the last bit, which depends on the
    order of summation, would choose the bin: within 1e-12 of an edge counts as on it."""
    c = _c(x)
    return F.when(F.abs(c) < 1000, F.floor(c * 1e12 + 0.5) / 1e12).otherwise(c)


def probbin(p) -> Column:
    return PROBBINS.bucket(p)


def tbin_val(b) -> Column:
    return TBINS.centre(b)


def probbin_val(b) -> Column:
    return PROBBINS.edge_centre(b)


def probdiffbin(d) -> Column:
    return DIFFBINS.bucket(d)


def probdiff_bin_mean(b) -> Column:
    """Centre of a probability-difference bin: -1.025 + 0.025 + (b - 1) * 0.05."""
    return F.lit(-1.025) + F.lit(0.05 / 2) + (_c(b) - 1).cast("double") * F.lit(0.05)


def merge_top(b, n: int = PROBBINS.n) -> Column:
    """Lump the overflow bin ``n + 1`` into bin ``n``."""
    return F.least(_c(b), F.lit(n).cast("long"))


def tbin_label(b) -> Column:
    """Axis label of a time bin: ``<lo`` and ``>=hi`` at the ends, else the centre."""
    return (F.when(_c(b) <= 0, F.lit(f"<{TBINS.lo}"))
            .when(_c(b) >= TBINS.n + 1, F.lit(f"≥{TBINS.hi}"))
            .otherwise(tbin_val(b).cast("string")))


def closed_histogram_bin(x, lo, hi, n: int) -> Column:
    """1-based bin of ``numpy.histogram(x, bins=linspace(lo, hi, n + 1))``.

    ``lo``/``hi`` may be columns (per-group ranges). The edges are
    ``lo + i * step`` (``step = (hi - lo) / n``), exactly the doubles ``linspace``
    produces, and the bin is one plus the number of inner edges at or below ``x``:
    bins are half open except the last, which is closed; values outside
    ``[lo, hi]`` give NULL (NumPy drops them). The expression is linear in ``n``.
    """
    x = _c(x).cast("double")
    lo = (lo if isinstance(lo, Column) else F.lit(float(lo))).cast("double")
    hi = (hi if isinstance(hi, Column) else F.lit(float(hi))).cast("double")
    step = (hi - lo) / float(n)
    above = [F.when(x >= lo + F.lit(float(i)) * step, 1).otherwise(0) for i in range(1, n)]
    k = F.lit(1)
    for a in above:
        k = k + a
    return F.when((x >= lo) & (x <= hi), k.cast("long"))


def equal_width_range(lo: Column, hi: Column) -> tuple[Column, Column]:
    """NumPy's range rule for ``bins=int``: a zero-width range widens to +-0.5."""
    same = lo == hi
    return F.when(same, lo - 0.5).otherwise(lo), F.when(same, hi + 0.5).otherwise(hi)


# The naive time bin of the exploration notebook, floor((dt + 20) / 5).
NAIVE_BIN_OFFSET, NAIVE_BIN_WIDTH = 20.0, 5.0


def five_day_bin(dt, offset: float = NAIVE_BIN_OFFSET, width: float = NAIVE_BIN_WIDTH) -> Column:
    """``floor((dt + offset) / width)`` (naive time bin of the exploration notebook)."""
    return F.floor((_c(dt) + offset) / width)


def rint_round(x, decimals: int = 2) -> Column:
    """Round half to even, like NumPy/pandas ``round`` on doubles."""
    f = float(10 ** decimals)
    return F.rint(_c(x) * f) / f
