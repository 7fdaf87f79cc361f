"""Chain B: daily multi-sensor reflectances on a geographic grid to products and months on a polar grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.functions.projection import LAT_LIMIT, Area, rowcol_to_lonlat
from chromasea.operators.composite import monthly_composite
from chromasea.operators.resample import RADIUS_MULTI_SENSOR, resample_nearest
from chromasea.plans.daily import add_band_ratio_products
from chromasea.plans.plankton import plankton_chain
from chromasea.sources.models import KernelModel


def resample_scene(scene: DataFrame, target: Area, cols: Sequence[str], keys: Sequence[str] = ("obs_date",),
                   radius_m: float = RADIUS_MULTI_SENSOR, lat_min: float = LAT_LIMIT,
                   bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """G-07 and F-15 for a scene with row, col, lat and lon.

    Source rows that cannot reach the domain are left out at the scan: a degree
    of latitude is more than 110 km. A cell's latitude is computed from its place, so no table of cells is joined.
    """
    near = scene.where(F.col("lat") >= lat_min - radius_m / 110_000.0)
    cells = resample_nearest(near, target, radius_m, cols, keys, bits)
    _, lat = rowcol_to_lonlat(F.col("y"), F.col("x"), target)
    inside = cells.withColumn("_inside", lat >= lat_min)
    return inside.withColumns({c: F.when(F.col("_inside"), F.col(c)) for c in cols}).drop("_inside")


def multi_products(scene: DataFrame, target: Area, keys: Sequence[str] = ("obs_date",),
                   radius_m: float = RADIUS_MULTI_SENSOR, bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """Resampling, then A-01, A-03 and F-05 on the polar grid, in one plan.

    `multi_month` goes on to plankton classes and months.
    """
    bands = ["rrs443", "rrs490", "rrs510", "rrs560"]
    return add_band_ratio_products(resample_scene(scene, target, bands, keys, radius_m, bits=bits))


def multi_month(scene: DataFrame, target: Area, bands: Sequence[str], model: KernelModel, kind: str = "doy", products: Sequence[str] = ("chl",),
                clim: DataFrame | None = None, radius_m: float = RADIUS_MULTI_SENSOR, lat_min: float = LAT_LIMIT, bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """Chain B to its end: G-07 with F-15, then A-14 (band check, regression, range, quality index, classes) per day, then R-07 of each product.

    `scene` has obs_date, row, col, lat, lon and the bands, those of the shift from 442.5 nm where 443 is missing. A row per
    product, month and cell; the daily table is shared by the products, which are unpivoted before one aggregation.
    """
    daily = plankton_chain(resample_scene(scene, target, bands, ("obs_date",), radius_m, lat_min, bits), model, kind, clim)
    values = daily.select("obs_date", "y", "x", F.inline(F.array(*[F.struct(F.lit(p).alias("product"), F.col(p).alias("value")) for p in products])))
    return monthly_composite(values, "value", cell=("product", "y", "x"))
