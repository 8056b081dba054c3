"""Equal-width bins with the edge rule of a closed last bin."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_edges(bins: int) -> list[float]:
    """The ``bins + 1`` edges of [0, 1]: multiples of the step, last edge 1."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def unit_bin(x: Column, bins: int) -> Column:
    """Bin number of a value normalised to [0, 1].

    The position is guessed by multiplication and then corrected against the
    exact edges, so that a value such as 0.3 lands left of the edge
    3 * 0.1 = 0.30000000000000004, as a search over the edges would put it.
    """
    step = F.lit(1.0 / bins)
    guess = F.least(F.floor(x * F.lit(float(bins))), F.lit(bins - 1))
    # a missing value has no bin (``least`` alone would pass over the null)
    return F.when(x.isNotNull(), _settle(x, guess, lambda k: k * step, bins)).cast("int")


def span_bin(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin number of ``x`` over edges ``i * (hi - lo) / bins + lo``."""
    step = (hi - lo) / bins
    guess = F.floor((x - F.lit(lo)) / F.lit(step))
    guess = F.greatest(F.lit(0), F.least(guess, F.lit(bins - 1)))
    settled = _settle(x, guess, lambda k: k * F.lit(step) + F.lit(lo), bins)
    return F.when(x.isNotNull(), settled).cast("int")


def span_edges(lo: float, hi: float, bins: int) -> list[float]:
    step = (hi - lo) / bins
    return [i * step + lo for i in range(bins)] + [hi]


def _settle(x: Column, guess: Column, edge, bins: int) -> Column:
    # the guess is off by at most one bin, in either direction
    left = (x < edge(guess)).cast("int")
    right = ((x >= edge(guess + 1)) & (guess + 1 <= bins - 1)).cast("int")
    return guess - left + right
