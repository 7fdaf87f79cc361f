"""Look-ups in tables of bands and of coefficients (A-12 and F-06 as table operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.operators.ranges import Ranges, as_of, first_active, with_next

# Wavelengths are compared in units of 1e-9.
UNITS = 1e9


def nearest_in_table(points: DataFrame, bands: DataFrame, at: str, position: str, band: str, out: str, tol: float = 1.0) -> DataFrame:
    """F-06 with a table of bands: the first band, by position, that is closer to a wavelength than `tol`.

    Wavelengths count in units of 1e-9. Where bands begin and cease to be in reach is a step function of the wavelength,
    made from the table alone; points then look it up as of their wavelength.
    """
    reach = round(tol * UNITS) - 1
    units = F.round(F.col(band).cast("double") * UNITS).cast("long")
    known = bands.where(F.col(band).isNotNull()).select((units - reach).alias("_start"), (units + reach).alias("_end"), F.col(position).alias("_position"), F.col(band).alias("_band"))
    steps = first_active(known, "_start", "_end", ("_position", "_band"))
    asked = points.withColumn("_units", F.round(F.col(at).cast("double") * UNITS))
    return as_of(asked, steps, "_units", "at", ["_band"]).withColumnRenamed("_band", out).drop("_units")


def interpolate_table(points: DataFrame, table: DataFrame, at: str, x: str, y: str, out: str) -> DataFrame:
    """A-12. Value of the table at every point, linear between its knots and held constant beyond both ends.

    The table may be of any size: knots get the knot behind them and points look them up as of their value.
    Of knots at one place the largest value counts at and behind it. Without knots, a value or a number all
    is null.
    """
    knots = table.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).where("_x IS NOT NULL AND NOT isnan(_x)")
    ranges = Ranges.of(points.select(F.col(at).alias("v")).union(knots.select(F.col("_x").alias("v"))), "v")
    segments = with_next(knots, "_x", ("_x", "_y"), ranges)
    # Below the first knot its value holds.
    below = knots.orderBy("_x", "_y").limit(1).select(F.lit(float("-inf")).alias("_from"), "_x", "_y", F.lit(None).cast("double").alias("next__x"), F.lit(None).cast("double").alias("next__y"))
    pieces = segments.withColumn("_from", F.col("_x")).unionByName(below)
    v, width = F.col(at).cast("double"), F.col("next__x") - F.col("_x")
    value = F.when(F.col("next__x").isNull() | (v <= F.col("_x")), F.col("_y")).otherwise(F.col("_y") + (F.col("next__y") - F.col("_y")) * (v - F.col("_x")) / width)
    found = as_of(points, pieces, at, "_from", ("_x", "_y", "next__x", "next__y"), ranges)
    return found.withColumn(out, value).drop("_x", "_y", "next__x", "next__y")
