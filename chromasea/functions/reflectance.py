"""Reflectance scaling, range filters and band look-up (F-01, F-03 to F-07, F-18, O-02, U-03)."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

from chromasea.schema import BANDS

# --- fixed values: lower limits per band, upper limit, central range, product ranges ---
BAND_MIN = dict(zip(BANDS, (
    -0.0063, -0.0058, -0.0046, -0.0029, -0.0024, -0.0017, -0.0012, -0.00083, -0.000794, -0.00071, -0.00065)))
BAND_MAX = 1.0
CENTRAL_RANGE = (410.0, 670.0)
PRODUCT_RANGE = {"chl": (0.003, 100.0), "kd490": (0.0, 100.0)}
# --- end of fixed values ---


def is_central(wavelength: float) -> bool:
    """Central bands decide together whether a pixel is trusted."""
    return CENTRAL_RANGE[0] < wavelength < CENTRAL_RANGE[1]


def to_rrs(col: Column, collection: Column | int) -> Column:
    """F-01. Collection 3 stores rho and needs the division by pi; collection 4 is already Rrs."""
    collection = F.lit(collection) if isinstance(collection, int) else collection
    return F.when(collection == 3, col / F.lit(pi)).otherwise(col)


def decode_log10(col: Column) -> Column:
    """F-03. Values stored as decimal logarithm."""
    return F.pow(F.lit(10.0), col)


def clip_range(col: Column, lo: float, hi: float) -> Column:
    """F-04, F-05. Outside the closed range the value is missing."""
    return F.when(col.between(F.lit(lo), F.lit(hi)), col)


def clip_band(col: Column, wavelength: float) -> Column:
    """F-04. Range filter with the limits of a band."""
    return clip_range(col, BAND_MIN[wavelength], BAND_MAX)


def clip_product(col: Column, product: str) -> Column:
    """F-05. Range filter with the limits of a product."""
    return clip_range(col, *PRODUCT_RANGE[product])


def nearest_band(wavelength: float, bands: Sequence[float] = BANDS, tol: float = 1.0) -> float | None:
    """F-06. First band closer than `tol` nanometres, resolved while the plan is built."""
    return next((b for b in bands if abs(b - wavelength) < tol), None)


def nearest_band_col(wavelength: Column, bands: Sequence[float] = BANDS, tol: float = 1.0) -> Column:
    """F-06. The same look-up per row; the band list is a short plan-time constant."""
    hits = F.filter(F.array(*[F.lit(float(b)) for b in bands]), lambda b: F.abs(b - wavelength) < tol)
    return F.when(F.size(hits) > 0, hits[0])


def two_nearest(wavelength: Column, bands: Sequence[float] = BANDS) -> Column:
    """O-02. The nearest band, or both if two are equally far, in ascending order."""
    table = F.array(*[F.lit(float(b)) for b in sorted(bands)])
    best = F.array_min(F.transform(table, lambda b: F.abs(b - wavelength)))
    return F.slice(F.filter(table, lambda b: F.abs(b - wavelength) == best), 1, 2)


def merge_bands(a: Column, b: Column) -> Column:
    """U-03. Sorted distinct union of two band lists."""
    return F.sort_array(F.array_union(a, b))


def tile_key(y: Column, x: Column, ystep: int, xstep: int) -> Column:
    """F-18. Tile that holds a cell; used as the repartitioning key of tiled work."""
    return F.struct(F.floor(y / ystep).cast("int").alias("tile_y"), F.floor(x / xstep).cast("int").alias("tile_x"))


def tile_limits(y: Column, x: Column, ystep: int, xstep: int, ny: int, nx: int) -> Column:
    """F-18. Row and column limits of that tile, clipped to the grid."""
    y0 = F.floor(y / ystep).cast("int") * ystep
    x0 = F.floor(x / xstep).cast("int") * xstep
    return F.struct(
        y0.alias("y0"), F.least(y0 + ystep, F.lit(ny)).alias("y1"),
        x0.alias("x0"), F.least(x0 + xstep, F.lit(nx)).alias("x1"),
    )
