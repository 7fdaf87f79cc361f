"""Small numeric builders shared by the algorithms (F-19, F-20, F-37, F-38)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def poly(x: Column, coefficients: Sequence[float]) -> Column:
    """Polynomial, constant term first, nested so that codegen sees only multiply-adds."""
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def segment_of(x: Column, xs: Sequence[float]) -> Column:
    """Number of the table segment that holds x, from 0; NULL outside the table.

    A staged column of this is shared by all tables over the same knots.
    """
    inner = F.lit(0)
    for knot in xs[1:-1]:
        inner = inner + (x > F.lit(knot)).cast("int")
    return F.when(x.between(F.lit(xs[0]), F.lit(xs[-1])), inner)


def interp_at(x: Column, segment: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Value of the line through the ends of a segment: two look-ups in constant arrays.

    Compared with a CASE over the segments this keeps the generated code small.
    """
    knots = list(zip(xs, ys))
    slopes = [(y1 - y0) / (x1 - x0) for (x0, y0), (x1, y1) in zip(knots, knots[1:])]
    bases = [y0 - s * x0 for (x0, y0), s in zip(knots, slopes)]
    return F.get(F.lit(bases), segment) + x * F.get(F.lit(slopes), segment)


def interp_linear(x: Column, xs: Sequence[float], ys: Sequence[float]) -> Column:
    """Piecewise-linear interpolation on a short table; NULL outside it."""
    return interp_at(x, segment_of(x, xs), xs, ys)


def clamp(col: Column, lo: float, hi: float) -> Column:
    """Bring a value into [lo, hi]; NULL stays NULL (greatest and least would skip it)."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(lo)), F.lit(hi)))


def product_ratio(a: Column, b: Column) -> Column:
    """F-19. Previous product over new product."""
    return F.try_divide(a, b)


def byte_encode(col: Column, scale: float, offset: float) -> Column:
    """F-20. Log-scaled byte 0..254; 255 stands for missing."""
    code = F.least(F.greatest(F.ceil((F.log10(col) - F.lit(offset)) / F.lit(scale)), F.lit(0)), F.lit(254))
    return F.when(col > 0, code).otherwise(F.lit(255)).cast("int")


def byte_decode(code: Column, scale: float, offset: float) -> Column:
    """F-20. Inverse of `byte_encode`; 255 becomes NULL."""
    return F.when(code != 255, F.pow(F.lit(10.0), code * F.lit(scale) + F.lit(offset)))


def byte_roundtrip(col: Column, scale: float, offset: float) -> Column:
    """F-20. What a value becomes after being stored as a byte."""
    return byte_decode(byte_encode(col, scale, offset), scale, offset)


def dot(u: Column, v: Column) -> Column:
    """F-38. Dot product of two arrays."""
    return F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)


def subtract(u: Column, v: Column) -> Column:
    """F-38. Element-wise difference of two arrays."""
    return F.zip_with(u, v, lambda a, b: a - b)


def count_nonzero(u: Column) -> Column:
    """F-38. Number of elements different from zero."""
    return F.size(F.filter(u, lambda a: a != 0))
