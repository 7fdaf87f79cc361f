"""Rational-quadratic covariance functions on array columns (A-04, A-05)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, d: s + d)


def rq_kernel(u: Column, v: Column, sf: float, sl: float, alpha: float) -> Column:
    """A-04. One length scale for all features; NULL if the lengths differ."""
    dist = _sum(F.zip_with(u, v, lambda a, b: (a - b) * (a - b)))
    value = F.lit(sf * sf) * F.pow(1 + dist / F.lit(2 * alpha * sl * sl), F.lit(-alpha))
    return F.when(F.size(u) == F.size(v), value)


def ard_rq_kernel(u: Column, v: Column, sf: float, ls: Sequence[float], alpha: float) -> Column:
    """A-05. One length scale per feature; NULL if a length differs from theirs."""
    inverse = F.array(*[F.lit(1.0 / (l * l)) for l in ls])
    squares = F.zip_with(u, v, lambda a, b: (a - b) * (a - b))
    dist = _sum(F.zip_with(squares, inverse, lambda d, w: d * w))
    value = F.lit(sf * sf) * F.pow(1 + dist / F.lit(2 * alpha), F.lit(-alpha))
    return F.when((F.size(u) == len(ls)) & (F.size(v) == len(ls)), value)
