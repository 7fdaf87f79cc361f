"""Day-of-year climatology and the quality index (R-09, J-02, A-13)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.weights import SPATIAL_WEIGHTS, full_weight
from chromasea.operators.neighbours import RING, deal_to_tiles, tile_side

STATS = ("w_avg", "n_avg", "diff_n_w", "n_std", "w_std", "sum_w", "porc_w", "median", "min", "max", "nofobs")
# Values of one step of a tile's work, about.
STEP_VALUES = 1_500_000


def climatology(daily: DataFrame, col: str, ny: int, nx: int, window: int = 11, log: bool = False,
                years: tuple[int, int] | None = None, use_weights: bool = True) -> DataFrame:
    """R-09. Eleven statistics per month-day and cell over a moving window of days and neighbours.

    `daily` holds at most one value per day and cell, as composites do. Without `years` the range is that of
    the data (a subquery of the plan). Values that are null or not a number are missing; rows without a day or cell are left out. Standard deviations of equal values are 0; `w_std` of one value is null.

    One shuffle, of the values and copies of the tiles' rims, to the tile of their cell. A task lays the days of a tile
    out as a grid (cells by days, as large as a tile of the archive is) and slices the windows of all years and neighbours
    from it, some month-days at a time: nothing is copied to its 99 targets as a row, and no list of values is
    aggregated, since order statistics are read off the sorted slices.
    """
    half = window // 2
    value = F.log10(F.when(F.col(col) > 0, F.col(col))) if log else F.col(col).cast("double")
    source = daily.select(F.col("obs_date").cast("date").alias("obs_date"), "y", "x", value.alias("_v")).where(F.col("_v").isNotNull() & F.col("obs_date").isNotNull())
    # One cell beyond the grid is still a neighbour; others, and rows without a cell, are none.
    source = source.where(F.col("y").between(-1, ny) & F.col("x").between(-1, nx))
    if years is None:
        bounds = source.agg(F.struct(F.min(F.year("obs_date")).alias("first"), F.max(F.year("obs_date")).alias("last"))).scalar()
    else:
        bounds = F.struct(F.lit(years[0]).alias("first"), F.lit(years[1]).alias("last"))
    side = tile_side(ny, nx)
    # The number is given because small tables would else come to a single task, however much work a tile is.
    tasks = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = deal_to_tiles(source, ny, nx).withColumns({"_first": bounds["first"], "_last": bounds["last"]}).repartition(tasks, "_ty", "_tx")
    schema = "mmdd string, y int, x int, " + ", ".join(f"{c} {'bigint' if c == 'nofobs' else 'double'}" for c in STATS)

    def statistics(key: tuple, rows: pa.Table) -> pa.Table:
        top, left = int(key[0].as_py()) * side, int(key[1].as_py()) * side
        shape = (min(side, ny - top), min(side, nx - left))
        first, last = rows.column("_first")[0].as_py(), rows.column("_last")[0].as_py()
        names, targets = _month_days(first, last)
        start = targets.min() - half
        grid = np.full((shape[0] + 2, shape[1] + 2, targets.max() + half + 1 - start), np.nan)
        day, y, x, v = (rows.column(c).to_numpy() for c in ("_day", "y", "x", "_v"))
        inside = (day >= start) & (day - start < grid.shape[2])
        grid[y[inside] - top + 1, x[inside] - left + 1, day[inside] - start] = v[inside]
        weights = _weights(half, len(targets[0]), use_weights)
        step = max(1, STEP_VALUES // (shape[0] * shape[1] * len(weights)))
        parts = [_slices(grid, names[i:i + step], targets[i:i + step] - start, half, weights, top, left) for i in range(0, len(names), step)]
        per_year = full_weight(half) if use_weights else 9.0 * (2 * half + 1)
        columns = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        columns["porc_w"] = 100.0 * columns["sum_w"] / (per_year * (last - first + 1))
        return pa.table({c: pa.array(columns[c], from_pandas=True) for c in ("mmdd", "y", "x", *STATS)})

    return tiles.withColumn("_day", F.unix_date("obs_date")).drop("obs_date").groupBy("_ty", "_tx").applyInArrow(statistics, schema)


def _month_days(first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 365 month-days and their day numbers in every year (month-day, year)."""
    days = np.arange(np.datetime64(f"{first}-01-01"), np.datetime64(f"{last + 1}-01-01"))
    names = np.array([f"{d[5:7]}{d[8:]}" for d in days.astype(str)])
    days = days.astype(np.int64)[names != "0229"].reshape(-1, 365)
    return names[names != "0229"][:365], days.T


def _weights(half: int, n_years: int, use_weights: bool) -> np.ndarray:
    """Weights of a slice: neighbours, then years, then days."""
    if not use_weights:
        return np.ones(len(RING) * n_years * (2 * half + 1))
    triangle = (half + 1 - np.abs(np.arange(-half, half + 1))) / (half + 1)
    near = [SPATIAL_WEIGHTS[abs(dy) + abs(dx)] for dy, dx in RING]
    return np.concatenate([np.tile(w * triangle, n_years) for w in near])


def _slices(grid: np.ndarray, names: np.ndarray, targets: np.ndarray, half: int, weights: np.ndarray, top: int, left: int) -> dict:
    """Statistics of the month-days of `targets` in all cells of a tile that have a value."""
    h, w = grid.shape[0] - 2, grid.shape[1] - 2
    days = (targets[:, :, None] + np.arange(-half, half + 1)).reshape(len(targets), -1)
    near = grid[:, :, days]
    values = np.stack([near[1 + dy:1 + dy + h, 1 + dx:1 + dx + w] for dy, dx in RING], axis=3).reshape(h, w, len(names), -1)
    n = np.count_nonzero(~np.isnan(values), axis=-1)
    y, x, at = np.nonzero(n)
    values, n = values[y, x, at], n[y, x, at]
    absent = np.isnan(values)

    def total(a: np.ndarray) -> np.ndarray:
        return np.where(absent, 0.0, a).sum(axis=1)

    def weighted(a: np.ndarray) -> np.ndarray:
        return np.where(absent, 0.0, a) @ weights

    ordered = np.sort(values, axis=1)
    row = np.arange(len(n))
    least, most = ordered[:, 0] if len(n) else np.empty(0), ordered[row, n - 1]
    same = least == most
    mean = np.where(same, least, total(values) / n)
    sum_w = weighted(np.ones_like(values))
    centre = np.where(same, least, weighted(values) / sum_w)
    spread = weighted((values - centre[:, None]) ** 2)
    share = np.where(n > 1, (n - 1) / n, np.nan)
    return {
        "mmdd": names[at], "y": (y + top).astype(np.int32), "x": (x + left).astype(np.int32), "w_avg": centre, "n_avg": mean,
        "diff_n_w": np.abs(mean - centre), "n_std": np.sqrt(total((values - mean[:, None]) ** 2) / n), "w_std": np.sqrt(spread / (share * sum_w)),
        "sum_w": sum_w, "median": (ordered[row, (n - 1) // 2] + ordered[row, n // 2]) / 2, "min": least, "max": most, "nofobs": n.astype(np.int64),
    }


def clim_key(date: Column) -> Column:
    """Month-day used for the look-up: 29 February takes 28 February."""
    mmdd = F.date_format(date, "MMdd")
    return F.when(mmdd == "0229", F.lit("0228")).otherwise(mmdd)


def join_climatology(daily: DataFrame, clim: DataFrame, date: str = "obs_date") -> DataFrame:
    """J-02. Attach the climatology of the day and cell, keeping cells without one."""
    return daily.withColumn("mmdd", clim_key(F.col(date))).join(clim, ["mmdd", "y", "x"], "left")


def quality_index(daily: DataFrame, clim: DataFrame, col: str, log: bool, out: str | None = None) -> DataFrame:
    """A-13. Distance from the climatological median in standard deviations."""
    value = F.log10(F.when(F.col(col) > 0, F.col(col))) if log else F.col(col)
    reference = clim.select("mmdd", "y", "x", F.col("median").alias("_median"), F.col("n_std").alias("_std"))
    joined = join_climatology(daily, reference)
    index = F.try_divide(value - F.col("_median"), F.col("_std"))
    return joined.withColumn(out or f"qi_{col}", index).drop("mmdd", "_median", "_std")
