"""Pixel-table scans (S-04) and coefficient files (A-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Small row groups: each is a piece of the curve with statistics of its own.
ROW_GROUP_BYTES = 16 << 20


def in_box(df: DataFrame, box: tuple[int, int, int, int]) -> DataFrame:
    """Rows inside (y_min, y_max, x_min, x_max); the maxima are exclusive."""
    y0, y1, x0, x1 = box
    return df.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))


def read_pixels(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                box: tuple[int, int, int, int] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """S-04. Named variables of a pixel table, optionally inside a box.

    Both the projection and the box reach the Parquet scan: unused columns are
    not read and row groups outside the box are skipped by their statistics.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    if box is not None:
        df = in_box(df, box)
    return df.select(*columns) if columns is not None else df


def curve_key(y: Column, x: Column) -> Column:
    """Place of a cell on the Z-order curve: the bits of y and x in turn, for coordinates of up to 31 bits.

    Cells near on the curve are near on the grid, so rows sorted by it fill files and row groups whose ranges of y and x are both narrow.
    """

    def spread(c: Column) -> Column:
        v = c.cast("bigint")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(y), 1).bitwiseOR(spread(x))


def write_pixels(df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists", row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Pixel table laid out for S-04: rows follow the Z-order curve over files, row groups and pages.

    One exchange by ranges of the curve, with a running number behind it, so that a cell with very many rows is cut as well.
    The statistics of y and x that Parquet keeps then let a box skip all that it doesn't touch.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumns({"_curve": curve_key(F.col("y"), F.col("x")), "_copy": F.monotonically_increasing_id()})
    placed = keyed.repartitionByRange(n, "_curve", "_copy").sortWithinPartitions("_curve", "_copy").drop("_curve", "_copy")
    placed.write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(path)


def read_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """A-12. Text table `wavelength value [value]` separated by blanks."""
    parts = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(F.trim("value") != "").select(
        F.get(parts, F.lit(0)).cast("double").alias("wavelength"),
        F.get(parts, F.lit(1)).cast("double").alias("a"),
        F.get(parts, F.lit(2)).cast("double").alias("b"),
    )
