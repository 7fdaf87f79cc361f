"""Chain A: granule pixels to daily and monthly products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.functions.bandratio import kd490_two_pass
from chromasea.functions.flags import default_mask, flag_code
from chromasea.functions.projection import LAT_LIMIT, Area, rowcol_to_lonlat
from chromasea.functions.reflectance import clip_product
from chromasea.operators.composite import daily_composite, enforce_central_bands, monthly_composite
from chromasea.operators.gpr import gpr_chl
from chromasea.operators.quality import screen_latitude, screen_valid
from chromasea.operators.resample import resample_nearest
from chromasea.session import materialise
from chromasea.sources.models import KernelModel


def mask_pixels(pixels: DataFrame, catalogue: Mapping[str, int], names: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """F-12 as a weight: 1 where the pixel is clean, 0 where it is masked."""
    masked = default_mask(F.col("flags"), flag_code(catalogue, names), [F.col(b) for b in bands])
    return pixels.withColumn("mask", 1 - masked)


def daily_reflectance(pixels: DataFrame, limits: Mapping[str, tuple[float, float]], central: Sequence[str]) -> DataFrame:
    """R-03, R-04 and R-05 in one aggregation over (day, cell)."""
    return enforce_central_bands(daily_composite(pixels, limits, with_mask=True), central)


def add_band_ratio_products(daily: DataFrame) -> DataFrame:
    """A-01, A-03 and F-05: chlorophyll and attenuation beside the reflectances."""
    out = kd490_two_pass(daily)
    return out.withColumns({
        "chl": clip_product(F.col("chl_second"), "chl"), "kd490": clip_product(F.col("kd490"), "kd490")
    }).drop("chl_first", "chl_second", "q490")


def monthly_chlorophyll(pixels: DataFrame, catalogue: Mapping[str, int], names: Sequence[str],
                        limits: Mapping[str, tuple[float, float]], central: Sequence[str]) -> DataFrame:
    """The whole chain. Two shuffles: (day, y, x) for the composite and (month, y, x) for the month."""
    masked = mask_pixels(pixels, catalogue, names, list(limits))
    return monthly_composite(add_band_ratio_products(daily_reflectance(masked, limits, central)), "chl")


def landed_granules(swath: DataFrame, target: Area, radius_m: float, bands: Sequence[str], min_lat: float = LAT_LIMIT, th: int = -1,
                    keys: Sequence[str] = ("granule_id", "platform", "obs_date"), bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """F-16, G-07 and F-17: granules that reach `min_lat`, resampled, and of these the ones with more than `th` clean cells.

    The resampled cells are written once; the count and the cells that pass are read from them.
    """
    near = screen_latitude(swath, min_lat)
    cells = materialise(resample_nearest(near, target, radius_m, [*bands, "mask"], keys, bits).drop("distance"), "landed")
    if th < 0:
        return cells
    counts = cells.groupBy("granule_id").agg(F.count_if(F.col("mask") == 1).alias("n_valid"))
    return cells.join(screen_valid(counts, th).select("granule_id"), "granule_id", "left_semi")


def olci_month(swath: DataFrame, target: Area, radius_m: float, limits: Mapping[str, tuple[float, float]], central: Sequence[str],
               model: KernelModel, kind: str = "doy", min_lat: float = LAT_LIMIT, domain_lat: float = LAT_LIMIT, th: int = -1,
               bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """Chain A from swaths to months: F-16, G-07, F-17, R-03 and R-04 inside the domain, R-05, A-06 or A-07, F-05, R-07.

    `swath` has granule_id, platform, obs_date, row, col, lat, lon, the bands and `mask` (1 clean, 0 masked). The domain is a condition on
    the cell, whose latitude is computed from its place, so no table of cells is joined.
    """
    cells = landed_granules(swath, target, radius_m, list(limits), min_lat, th, bits=bits)
    lon, lat = rowcol_to_lonlat(F.col("y"), F.col("x"), target)
    daily = daily_composite(cells, limits, with_mask=True, domain=lat >= domain_lat)
    ready = enforce_central_bands(daily, central).withColumns({"doy": F.dayofyear("obs_date"), "lon": lon})
    chl = gpr_chl(ready, model, kind)
    return monthly_composite(chl.withColumn("chl", clip_product(F.col("chl"), "chl")), "chl")
