"""Daily and monthly composites and per-cell summaries (R-03 to R-08, R-15 to R-21).

Every operator is one hash aggregation on scalar accumulators, so partial
aggregation shrinks hot cells, days and granules before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.flags import all_positive

CELL = ("y", "x")
DAY_CELL = ("obs_date", "y", "x")
Limits = Mapping[str, tuple[float, float]]

# --- fixed values: platform bits of the sensor mask ---
PLATFORM_BITS = {"S3A": 1, "S3B": 2}
# --- end of fixed values ---


def _in_range(col: str, limits: tuple[float, float]) -> Column:
    return F.col(col).between(F.lit(limits[0]), F.lit(limits[1]))


def _weighted(col: str, weight: Column, keep: Column, alias: str) -> list[Column]:
    return [
        F.sum(F.when(keep, F.col(col) * weight)).alias(f"_s_{alias}"),
        F.sum(F.when(keep, weight)).alias(f"_w_{alias}"),
    ]


def _mask_aggregates(mask: Column) -> list[Column]:
    bit = F.lit(None).cast("int")
    for platform, value in PLATFORM_BITS.items():
        bit = F.when(F.col("platform") == platform, F.lit(value)).otherwise(bit)
    return [
        F.count_if(mask >= 0).alias("n_granules"),
        F.coalesce(F.sum(F.when(mask > 0, mask)), F.lit(0)).cast("bigint").alias("sum_weights"),
        F.coalesce(F.bit_or(F.when(mask > 0, bit)), F.lit(0)).alias("sensormask"),
    ]


def _within(weight: Column, domain: Column | None) -> Column:
    """The mask, missing outside the domain: an expression of the cell, so no grid is joined."""
    return weight if domain is None else F.when(domain, weight)


def _beyond(df: DataFrame, domain: Column | None, cols: Sequence[str]) -> DataFrame:
    """Columns of the mask product are missing outside the domain."""
    return df if domain is None else df.withColumns({c: F.when(domain, F.col(c)) for c in cols})


def daily_composite(pixels: DataFrame, bands: Limits, mask: str = "mask", keys: Sequence[str] = DAY_CELL,
                    with_mask: bool = False, domain: Column | None = None) -> DataFrame:
    """R-03 (and R-04 with `with_mask`). Weighted mean per cell and band.

    Each band has its own range filter, so bands may rest on different granules.
    The mask is the weight: NULL no data, 0 masked, 1 valid. A mean outside the
    range is missing. All bands and the mask product share one aggregation. Cells
    outside `domain`, a condition on the cell, have neither values nor a mask.
    """
    w = _within(F.col(mask), domain)
    aggs = [a for b, lim in bands.items() for a in _weighted(b, w, (w > 0) & _in_range(b, lim), b)]
    if with_mask:
        aggs += _mask_aggregates(w)
    sums = pixels.groupBy(*keys).agg(*aggs)
    means = sums.withColumns({b: F.try_divide(F.col(f"_s_{b}"), F.col(f"_w_{b}")) for b in bands})
    extra = ["n_granules", "sum_weights", "sensormask"] if with_mask else []
    out = means.select(*keys, *[F.when(_in_range(b, lim), F.col(b)).alias(b) for b, lim in bands.items()], *extra)
    return _beyond(out, domain, extra)


def daily_mask(pixels: DataFrame, mask: str = "mask", keys: Sequence[str] = DAY_CELL, domain: Column | None = None) -> DataFrame:
    """R-04. Granule count, sum of weights and platform bits per cell; all missing outside `domain`."""
    counts = pixels.groupBy(*keys).agg(*_mask_aggregates(_within(F.col(mask), domain)))
    return _beyond(counts, domain, ["n_granules", "sum_weights", "sensormask"])


def enforce_central_bands(daily: DataFrame, central: Sequence[str]) -> DataFrame:
    """R-05. A missing or negative central band voids all central bands and the weight of the cell."""
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() | F.coalesce(F.col(c) < 0, F.lit(True)) for c in central])
    return daily.withColumn("_bad", bad).withColumns({
        **{c: F.when(~F.col("_bad"), F.col(c)) for c in central},
        "sum_weights": F.when(F.col("_bad"), F.lit(0)).otherwise(F.col("sum_weights")),
    }).drop("_bad")


def daily_composite_joint(pixels: DataFrame, bands: Limits, central: Sequence[str], mask: str = "mask",
                          keys: Sequence[str] = DAY_CELL, compat_joint_divisor: bool = False,
                          mask_negatives: bool = False, domain: Column | None = None) -> DataFrame:
    """R-06. A granule pixel counts only if all central bands are in range.

    Outer bands are tested on their own in addition. With `compat_joint_divisor`
    their sum is divided by the joint weight, otherwise by their own.
    """
    joint = reduce(lambda a, b: a & b, [F.coalesce(_in_range(c, bands[c]), F.lit(False)) for c in central])
    if mask_negatives:
        joint = joint & all_positive([F.col(c) for c in central])
    given = _within(F.col(mask), domain)
    src = pixels.withColumn("_m", F.when(given.isNotNull(), F.when(joint, given).otherwise(F.lit(0))))
    w = F.col("_m")
    aggs = []
    for b, lim in bands.items():
        keep = (w > 0) if b in central else (w > 0) & _in_range(b, lim)
        aggs += _weighted(b, w, keep, b)
    sums = src.groupBy(*keys).agg(*aggs, *_mask_aggregates(w))

    def divisor(band: str) -> Column:
        own = F.col(f"_w_{band}")
        if band in central or not compat_joint_divisor:
            return own
        return F.when(own > 0, F.col("sum_weights"))

    out = sums.select(
        *keys, *[F.try_divide(F.col(f"_s_{b}"), divisor(b)).alias(b) for b in bands],
        "n_granules", "sum_weights", "sensormask",
    )
    return _beyond(out, domain, ["n_granules", "sum_weights", "sensormask"])


def monthly_composite(daily: DataFrame, col: str, weights: DataFrame | None = None, date: str = "obs_date",
                      cell: Sequence[str] = CELL, domain: DataFrame | None = None) -> DataFrame:
    """R-07, and R-08 with `weights`. Mean, count and dispersion of the positive daily values.

    `value_error` is the sample variance, the quantity that is stored under that
    name; `value_std` is its square root. Both are NULL for a single value.
    `weights` has one row (date, weight) per scene; a zero weight drops the scene.
    `domain` restricts the result to the cells of a grid.
    """
    v = F.col(col)
    if weights is not None:
        daily = daily.join(weights.select(date, F.col("weight").alias("_scene")), date)
        v = v * F.col("_scene")
    kept = F.when(v > 0, v)
    out = (
        daily.groupBy(F.trunc(date, "month").alias("month"), *cell)
        .agg(F.avg(kept).alias("value"), F.count(kept).alias("value_count"), F.var_samp(kept).alias("value_error"))
        .withColumn("value_std", F.sqrt("value_error"))
    )
    return out if domain is None else out.join(domain.select(*cell), list(cell), "left_semi")


def valid_by_date(daily: DataFrame, cols: Sequence[str], calendar: DataFrame, date: str = "obs_date") -> DataFrame:
    """R-15. Number of present values per day and variable; days of the calendar without data give 0."""
    counts = daily.groupBy(date).agg(*[F.count(c).alias(f"n_{c}") for c in cols])
    return calendar.join(counts, date, "left").fillna(0, [f"n_{c}" for c in cols])


def valid_percent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """R-16. Number and share of present values per variable, from one pass over the table."""
    totals = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols])
    return (
        totals.unpivot("_n", list(cols), "variable", "n_valid")
        .withColumn("percent", F.coalesce(F.try_divide(F.lit(100.0) * F.col("n_valid"), F.col("_n")), F.lit(0.0)))
        .drop("_n")
    )


def sum_masks(pixels: DataFrame, mask: str = "mask", cell: Sequence[str] = CELL) -> DataFrame:
    """R-17. Sum of the masks of all granules per cell; missing masks are skipped."""
    return pixels.groupBy(*cell).agg(F.coalesce(F.sum(mask), F.lit(0)).cast("bigint").alias("mask_sum"))


def last_granule(pixels: DataFrame, limit: int | None = None, angle: str = "oza",
                 cell: Sequence[str] = CELL) -> DataFrame:
    """R-18. Index of the last granule that has an angle there; among the first `limit` granules if one is given."""
    seen = F.col(angle).isNotNull()
    if limit is not None:
        seen = seen & (F.col("granule_index") <= limit)
    return pixels.groupBy(*cell).agg(
        F.coalesce(F.max(F.when(seen, F.col("granule_index"))), F.lit(0)).alias("sensor_id")
    )


def orbit_bits(pixels: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """R-19. Sum of the orbit bits of the granules touching a cell, and their union, one row per block of bits.

    Granules of one pass add its bit once each, so that their sum may leave the range of a bigint: `orbit_total` is the exact sum,
    `orbit_sum` the same as a bigint, null where it doesn't fit.
    """
    low = (1 << 31) - 1
    sums = pixels.groupBy(*cell, "orbit_block").agg(
        F.sum(F.shiftright("orbit_bit", 31)).alias("_high"), F.sum(F.col("orbit_bit").bitwiseAND(low)).alias("_low"),
        F.bit_or("orbit_bit").alias("orbit_set"),
    )
    total = F.col("_high").cast("decimal(19,0)") * F.lit(low + 1).cast("decimal(10,0)") + F.col("_low")
    exact = sums.withColumn("orbit_total", total.cast("decimal(38,0)"))
    return exact.select(*cell, "orbit_block", F.col("orbit_total").try_cast("bigint").alias("orbit_sum"), "orbit_set", "orbit_total")


def time_extent(granules: DataFrame, start: str = "start_ts", keys: Sequence[str] = ()) -> DataFrame:
    """R-20. First and last granule start."""
    return granules.groupBy(*keys).agg(F.min(start).alias("time_min"), F.max(start).alias("time_max"))


def cell_series(daily: DataFrame, y: int, x: int, col: str) -> DataFrame:
    """R-21. Values of one cell by day; the cell filter reaches the scan."""
    return daily.where((F.col("y") == y) & (F.col("x") == x)).select("obs_date", col).orderBy("obs_date")
