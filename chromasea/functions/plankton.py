"""Phytoplankton size classes and functional types from chlorophyll (A-09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.numeric import poly

# --- fixed values: applicability range and regression coefficients ---
CHL_DOMAIN = (0.010, 4.580)
PICO_POLY = (0.18, -0.19, 0.0074, 0.0196)
NANO_PEAKS = ((0.154, -1.24, 0.398), (0.365, 0.0266, 0.719))  # height, centre, width
DINO_POLY = (-2.8893, -0.3687, -0.5394)
CRYPTO_PEAKS = ((0.078, -4.0, 4.0), (0.0908, -0.0709, 0.526))
GREEN_EXP, GREEN_SLOPE = (1.89, -0.638), 9.14
PROKAR_POLY = (-3.4948, -1.5926, -1.1681, -0.3387)
# --- end of fixed values ---

CLASSES = ("pico", "nano", "micro", "dino", "diato", "crypto", "green", "prokar", "hapt")


def _peaks(z: Column, peaks: tuple) -> Column:
    total = None
    for height, centre, width in peaks:
        d = (z - F.lit(centre)) / F.lit(width)
        term = F.lit(height) * F.exp(-(d * d))
        total = term if total is None else total + term
    return total


def _logistic(z: Column, coefficients: tuple) -> Column:
    return 1 / (1 + F.exp(-poly(z, coefficients)))


def plankton_classes(df: DataFrame, chl: str = "chl", as_conc: bool = True, domain: bool = True) -> DataFrame:
    """A-09. Adds nine columns; concentrations if `as_conc`, else fractions.

    Outside the applicability range (or for chl <= 0 when `domain` is off) all
    nine are NULL. Two projections: independent curves first, then the
    differences that refer to them by name.
    """
    value = F.col(chl)
    ok = (value > CHL_DOMAIN[0]) & (value < CHL_DOMAIN[1]) if domain else value > 0
    z = F.col("_z")
    base = (
        df.withColumn("_z", F.when(ok, F.log10(value)))
        .withColumns({
            "pico": poly(z, PICO_POLY),
            "nano": _peaks(z, NANO_PEAKS),
            "dino": _logistic(z, DINO_POLY),
            "crypto": _peaks(z, CRYPTO_PEAKS),
            "green": F.try_divide(F.lit(1.0), F.exp(poly(z, GREEN_EXP)) + F.lit(GREEN_SLOPE) * z),
            "prokar": _logistic(z, PROKAR_POLY),
        })
        .withColumn("micro", 1 - F.col("nano") - F.col("pico"))
        .withColumns({
            "diato": F.col("micro") - F.col("dino"),
            "hapt": 1 - F.col("micro") - F.col("crypto") - F.col("green") - F.col("prokar"),
        })
        .drop("_z")
    )
    if not as_conc:
        return base
    return base.withColumns({c: F.col(c) * value for c in CLASSES})
