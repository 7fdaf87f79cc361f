"""Dated folder layouts (S-05, S-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: folder organisations, part name to date pattern ---
LAYOUTS = {
    "YYYYmmdd": {"day": "yyyyMMdd"},
    "YYYY/mm/dd": {"year": "yyyy", "month": "MM", "dom": "dd"},
    "YYYY/jjj": {"year": "yyyy", "doy": "DDD"},
    "YYYY": {"year": "yyyy"},
    "YYYY/mm": {"year": "yyyy", "month": "MM"},
}
# --- end of fixed values ---


def layout_columns(date: Column, layout: str) -> dict[str, Column]:
    """Partition columns of a layout, as zero-padded text."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout}; one of {', '.join(LAYOUTS)}")
    return {f"p_{part}": F.date_format(date, pattern) for part, pattern in LAYOUTS[layout].items()}


def folder_of(date: Column, layout: str) -> Column:
    """Relative folder of a date, e.g. `2019/175`."""
    return F.concat_ws("/", *layout_columns(date, layout).values())


def write_dated(df: DataFrame, path: str, layout: str = "YYYY/jjj", date: str = "obs_date",
                overwrite: bool = False, files_per_day: int = 1) -> None:
    """S-05. Write partitioned by date folders.

    Rows are spread over (folder, salt) first, so a folder gets `files_per_day`
    files and a heavy day is written by as many tasks. With `overwrite` only
    the dates present in `df` are replaced (S-12).
    """
    parts = layout_columns(F.col(date), layout)
    staged = df.withColumns(parts)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_day))
    spread = staged.repartition(*[F.col(c) for c in parts], salt)
    writer = spread.write.option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    writer.mode("overwrite" if overwrite else "append").parquet(path)


def read_dated(spark: SparkSession, path: str, layout: str, start: str, end: str, date: str = "obs_date") -> DataFrame:
    """S-05. Rows of a date range; folders outside it are pruned by the partition columns."""
    df = spark.read.option("basePath", path).parquet(path)
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    parts = layout_columns(first, layout)
    head = next(iter(parts))
    pattern = LAYOUTS[layout][head[2:]]
    part = F.col(head).cast("string")
    pruned = df.where(part.between(F.date_format(first, pattern), F.date_format(last, pattern)))
    return pruned.where(F.col(date).between(first, last)).drop(*parts)


def existing_dates(spark: SparkSession, path: str, date: str = "obs_date") -> DataFrame:
    """S-12. Dates that already have output."""
    return spark.read.parquet(path).select(date).distinct()
