"""Target grids, granule boxes and domain tests (G-04 to G-06, G-11, G-15, F-15, J-01)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chromasea.functions.projection import (
    LAT_LIMIT, Area, lonlat_to_rowcol, rowcol_to_lonlat, rowcol_to_xy,
)


def make_grid(spark: SparkSession, target: Area, lat_min: float = LAT_LIMIT) -> DataFrame:
    """G-04. All cells of an area with metres, latitude, longitude and domain mask.

    Generated from a distributed range, so a 300 m grid is built by all tasks.
    The sensor mask is 0 in the domain and NULL below `lat_min`.
    """
    ids = spark.range(target.width * target.height)
    cells = ids.select(
        F.floor(F.col("id") / target.width).cast("int").alias("y"),
        (F.col("id") % target.width).cast("int").alias("x"),
    )
    xm, ym = rowcol_to_xy(F.col("y"), F.col("x"), target)
    lon, lat = rowcol_to_lonlat(F.col("y"), F.col("x"), target)
    located = cells.select("y", "x", xm.alias("x_m"), ym.alias("y_m"), lat.alias("lat"), lon.alias("lon"))
    return located.withColumn("sensormask", F.when(F.col("lat") >= lat_min, F.lit(0)))


def apply_domain(df: DataFrame, grid: DataFrame, cols: Sequence[str], cell: Sequence[str] = ("y", "x")) -> DataFrame:
    """F-15. Values of cells outside the domain become missing."""
    domain = grid.select(*cell, F.col("sensormask").alias("_domain"))
    joined = df.join(domain, list(cell), "left")
    return joined.withColumns({c: F.when(F.col("_domain").isNotNull(), F.col(c)) for c in cols}).drop("_domain")


def granule_box(swath: DataFrame, target: Area, key: str = "granule_id") -> DataFrame:
    """G-05. Box of a granule in the target grid, clamped to it; the maxima are exclusive."""
    row, col = lonlat_to_rowcol(F.col("lon"), F.col("lat"), target)
    extremes = swath.select(key, row.alias("_r"), col.alias("_c")).groupBy(key).agg(
        F.min("_r").alias("r0"), F.max("_r").alias("r1"), F.min("_c").alias("c0"), F.max("_c").alias("c1")
    )
    return extremes.select(
        key,
        F.greatest(F.floor("r0"), F.lit(0)).cast("int").alias("y_min"),
        F.least(F.ceil("r1") + 1, F.lit(target.height)).cast("int").alias("y_max"),
        F.greatest(F.floor("c0"), F.lit(0)).cast("int").alias("x_min"),
        F.least(F.ceil("c1") + 1, F.lit(target.width)).cast("int").alias("x_max"),
    )


def box_geo_limits(boxes: DataFrame, target: Area) -> DataFrame:
    """G-06. Latitude and longitude limits of the four corners of a box, without a shuffle."""
    corners = [rowcol_to_lonlat(F.col(y), F.col(x), target) for y in ("y_min", "y_max") for x in ("x_min", "x_max")]
    lons, lats = F.array(*[c[0] for c in corners]), F.array(*[c[1] for c in corners])
    return boxes.withColumns({"_lons": lons, "_lats": lats}).withColumns({
        "lat_min": F.array_min("_lats"), "lat_max": F.array_max("_lats"),
        "lon_min": F.array_min("_lons"), "lon_max": F.array_max("_lons"),
    }).drop("_lons", "_lats")


def expand_axes(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """G-11. Two axis arrays of a scene become its rows, with row and column numbers.

    The axes of a scene stay together in one row, so the expansion is two local
    explodes; scenes spread over tasks, and rows of a scene are spread before
    the second explode.
    """
    others = [c for c in df.columns if c not in (lat, lon)]
    rows = df.select(*others, lon, F.posexplode(lat).alias("row", "_lat"))
    return rows.select(*others, "row", F.col("_lat").alias(lat), F.posexplode(lon).alias("col", "_lon")) \
        .withColumnRenamed("_lon", lon)


def count_ocean(grid: DataFrame, land: DataFrame, min_lat: float = LAT_LIMIT) -> DataFrame:
    """G-15. Number of cells in the domain that are not land."""
    ocean = grid.where(F.col("lat") >= min_lat).join(land.select("y", "x").distinct(), ["y", "x"], "left_anti")
    return ocean.agg(F.count(F.lit(1)).alias("n_ocean"))


def align(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """J-01. Align two rasters cell by cell. Sides are sized and de-skewed by AQE."""
    return a.join(b, list(keys), how)
