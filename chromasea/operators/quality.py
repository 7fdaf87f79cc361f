"""Granule quality counters (R-01, R-02) and match-up filters (F-16, F-17, F-21, A-08)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.flags import NOT_WATER_FLAGS, flag_code, flag_mask
from chromasea.functions.reflectance import tile_key

# --- fixed values: valid input ranges of the two chlorophyll models and of the attenuation; only the last takes its limit ---
MODEL_LIMITS = {"doy": (1e-8, 1 / pi), "lon_doy": (0.0, None), "kd490": (0.0, None)}
LIMIT_ALLOWED = ("kd490",)
# --- end of fixed values ---


def granule_counters(df: DataFrame, catalogue: Mapping[str, int], mask_names: Sequence[str],
                     mask: str = "mask_default", flags: str = "flags", key: str = "granule_id") -> DataFrame:
    """R-01. Totals per granule; the valid share refers to water and is 0 where there is none."""
    f = F.col(flags)
    land = flag_code(catalogue, [n for n in NOT_WATER_FLAGS if n in catalogue])
    counts = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(flag_mask(f, flag_code(catalogue, mask_names)) != 0).alias("n_flagged"),
        F.count_if(flag_mask(f, catalogue["WATER"]) != 0).alias("n_water1"),
        F.count_if(flag_mask(f, land) == 0).alias("n_water2"),
        F.count_if(F.col(mask) == 0).alias("n_valid"),
    )
    share = F.try_divide(F.lit(100.0) * F.col("n_valid"), F.col("n_water2"))
    return counts.withColumn("p_valid", F.coalesce(share, F.lit(0.0)))


def band_qa(df: DataFrame, bands: Sequence[str], mask: str = "mask_default", key: str = "granule_id") -> DataFrame:
    """R-02. Per granule and band: present values, undetected negatives, and the weakest band's count.

    The bands are counted side by side in one aggregation and only then turned
    into rows, so the shuffle carries one row per granule instead of one per band.
    """
    aggs = []
    for b in bands:
        aggs += [
            F.count(b).alias(f"n_{b}"),
            F.count_if((F.col(mask) == 0) & (F.col(b) < 0)).alias(f"neg_{b}"),
        ]
    wide = df.groupBy(key).agg(*aggs)
    weakest = F.least(*[F.col(f"n_{b}") for b in bands]) if len(bands) > 1 else F.col(f"n_{bands[0]}")
    rows = F.array(*[
        F.struct(F.lit(b).alias("band"), F.col(f"n_{b}").alias("n_valid"), F.col(f"neg_{b}").alias("n_negative"))
        for b in bands
    ])
    return wide.select(key, weakest.alias("n_valid_min"), F.inline(rows))


def screen_latitude(df: DataFrame, min_lat: float = 65.0, key: str = "granule_id", lat: str = "lat") -> DataFrame:
    """F-16. Keep the rows of granules that reach `min_lat`.

    A granule reaches it exactly if one of its rows does, so the semi join needs
    only the keys of such rows and those are deduplicated before the shuffle.
    """
    reached = df.where(F.col(lat) >= min_lat).select(key).distinct()
    return df.join(reached, key, "left_semi")


def screen_valid(df: DataFrame, th: int = -1, col: str = "n_valid") -> DataFrame:
    """F-17. Granules with more than `th` valid pixels; a negative threshold keeps all."""
    return df if th < 0 else df.where(F.col(col) > th)


def hour_window(df: DataFrame, first: str, last: str, h0: int, h1: int) -> DataFrame:
    """F-21. Rows whose first time is not before hour h0 and whose last is not after hour h1."""
    return df.where((F.hour(first) >= h0) & (F.hour(last) <= h1))


def inputs_valid(cols: Sequence[Column], kind: str) -> Column:
    """All inputs inside the open range of a chlorophyll model, or not below zero for the attenuation (490 and 560 nm)."""
    lo, hi = MODEL_LIMITS[kind]
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.coalesce(c >= lo if kind in LIMIT_ALLOWED else c > lo, F.lit(False))
        if hi is not None:
            ok = ok & F.coalesce(c < hi, F.lit(False))
    return ok


def valid_inputs(df: DataFrame, cols: Sequence[str], kind: str, ystep: int, xstep: int,
                 keys: Sequence[str] = ()) -> DataFrame:
    """A-08. Pixels fit for a model per tile."""
    tile = tile_key(F.col("y"), F.col("x"), ystep, xstep)
    return (
        df.groupBy(*keys, tile["tile_y"].alias("tile_y"), tile["tile_x"].alias("tile_x"))
        .agg(F.count_if(inputs_valid([F.col(c) for c in cols], kind)).alias("n_valid"))
    )
