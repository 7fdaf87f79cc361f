"""Monthly composites kept up to date from the days that arrive (S-11 with R-07, R-08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chromasea.session import scratch_path

MOMENTS = ("n", "mean", "m2")


def merged(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Number, mean and sum of squared deviations of two samples together; the mean of none is null."""
    n = a["n"] + b["n"]
    ma, mb = F.coalesce(a["mean"], b["mean"]), F.coalesce(b["mean"], a["mean"])
    gap = mb - ma
    return {
        "n": n, "mean": F.when(n > 0, ma + gap * F.try_divide(b["n"], n)),
        "m2": a["m2"] + b["m2"] + F.coalesce(gap * gap * a["n"] * F.try_divide(b["n"], n), F.lit(0.0)),
    }


def removed(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """The sample a without its part b."""
    n = a["n"] - b["n"]
    mean = F.when(n > 0, a["mean"] - (F.coalesce(b["mean"], a["mean"]) - a["mean"]) * F.try_divide(b["n"], n))
    gap = F.coalesce(b["mean"] - mean, F.lit(0.0))
    rest = a["m2"] - b["m2"] - gap * gap * n * F.try_divide(b["n"], a["n"])
    return {"n": n, "mean": mean, "m2": F.when(n > 1, F.greatest(F.coalesce(rest, a["m2"]), F.lit(0.0))).otherwise(0.0)}


class _Versions:
    """A table in folders month=/batch=, whose rows name their part (a day or a month) and its version; the latest of each part counts.

    A repeated batch reads what lay below its own version and writes the same place again. Versions are found by an
    aggregation over the months concerned, a row for each part and batch.
    """

    def __init__(self, spark: SparkSession, path: str, part: str, files: int) -> None:
        self.spark, self.path, self.part, self.files = spark, path, part, files

    def every(self) -> DataFrame | None:
        try:
            every = self.spark.read.parquet(self.path)
        except Exception as error:  # nothing written yet
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise
        # Folder names are read as numbers where they look like them.
        return every.withColumns({c: F.col(c).cast("string") for c in ("month", "batch")})

    def before(self, parts: DataFrame, months: Sequence[str], batch: str) -> tuple[DataFrame | None, DataFrame | None]:
        """The rows of these parts as the batch finds them, and the version of each (part, version)."""
        every = self.every()
        if every is None:
            return None, None
        every = every.where(F.col("month").isin(list(months))).join(parts.select(self.part).distinct(), self.part, "left_semi")
        known = every.groupBy(self.part).agg(F.min(F.when(F.col("batch") == batch, F.col("version"))).alias("_own"))
        others = every.where(F.col("batch") != batch).join(known, self.part).where("_own IS NULL OR version < _own").drop("_own")
        latest = others.groupBy(self.part).agg(F.max("version").alias("version"))
        return others.join(latest, [self.part, "version"], "left_semi").drop("version", "batch"), latest

    def write(self, df: DataFrame, latest: DataFrame | None, batch: str) -> None:
        if latest is None:
            placed = df.withColumn("version", F.lit(0).cast("bigint"))
        else:
            placed = df.join(latest, self.part, "left").withColumn("version", F.coalesce(F.col("version") + 1, F.lit(0)).cast("bigint"))
        placed = placed.withColumn("batch", F.lit(batch)).repartition("month", F.pmod(F.xxhash64("y", "x"), F.lit(self.files)))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch").parquet(self.path)

    def latest(self) -> DataFrame | None:
        every = self.every()
        if every is None:
            return None
        newest = every.groupBy(self.part).agg(F.max("version").alias("version"))
        return every.join(newest, [self.part, "version"], "left_semi").drop("version", "batch")


class MonthlyState:
    """Number, mean and squared deviations of the positive values per month and cell, kept while days arrive or are replaced.

    A batch of whole days touches the months it lies in and no others: what the days held before is taken
    out of the months' state and their new values are merged into it, by month and cell; the values of no other day
    are read. The days themselves are stored, since a later batch may replace them. The same batch name again repeats the batch. One
    value per day and cell is expected; rows without a day or cell are left out, values that are null or
    not above zero count nowhere, as in `monthly_composite`. A month is written as `files` files by that many tasks.
    """

    def __init__(self, spark: SparkSession, col: str, path: str | None = None, date: str = "obs_date", files: int = 1) -> None:
        self.spark, self.col, self.date, path = spark, col, date, path or scratch_path(spark, "months")
        self.days, self.months = _Versions(spark, f"{path}/days", "day", files), _Versions(spark, f"{path}/months", "month", files)

    def _moments(self, days: DataFrame) -> DataFrame:
        v = F.when(F.col("v") > 0, F.col("v"))
        n = F.count(v)
        return days.groupBy("month", "y", "x").agg(
            n.alias("n"), F.avg(v).alias("mean"), F.coalesce(F.var_pop(v) * n, F.lit(0.0)).alias("m2"))

    def update(self, daily: DataFrame, batch: str) -> None:
        """Take in whole days (date, y, x, value), new ones or replacements."""
        new = daily.select(
            F.date_format(F.col(self.date), "yyyy-MM-dd").alias("day"), "y", "x", F.col(self.col).cast("double").alias("v")).dropna(subset=["day", "y", "x"])
        new = new.withColumn("month", F.substring("day", 1, 7))
        # Months as constants keep the scans to their folders.
        months = [r.month for r in new.select("month").distinct().collect()]
        old_days, day_versions = self.days.before(new, months, batch)
        old_months, month_versions = self.months.before(new, months, batch)
        nothing = self._moments(new.limit(0))
        parts = {"new": self._moments(new), "old": nothing if old_days is None else self._moments(old_days),
                 "state": nothing if old_months is None else old_months.select(*nothing.columns)}
        rows = None
        for kind, part in parts.items():
            named = part.withColumn("_kind", F.lit(kind))
            rows = named if rows is None else rows.unionByName(named)
        wide = rows.groupBy("month", "y", "x").agg(*[
            F.sum(F.when(F.col("_kind") == kind, F.col(m))).alias(f"_{kind}_{m}") for kind in parts for m in MOMENTS])

        def of(kind: str) -> dict[str, Column]:
            return {m: F.col(f"_{kind}_{m}") if m == "mean" else F.coalesce(F.col(f"_{kind}_{m}"), F.lit(0)) for m in MOMENTS}

        rest = wide.withColumns({f"_rest_{m}": c for m, c in removed(of("state"), of("old")).items()})
        state = rest.select("month", "y", "x", *[c.cast("bigint" if m == "n" else "double").alias(m) for m, c in merged(of("rest"), of("new")).items()])
        self.months.write(state, month_versions, batch)
        self.days.write(new, day_versions, batch)

    def read(self) -> DataFrame:
        """R-07 as of now: month (its first day), y, x, value, value_count, value_error and value_std."""
        state = self.months.latest()
        if state is None:
            raise ValueError("no days yet")
        error = F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1))
        return state.select(
            F.to_date(F.concat(F.col("month"), F.lit("-01"))).alias("month"), "y", "x", F.col("mean").alias("value"), F.col("n").alias("value_count"),
            error.alias("value_error"), F.sqrt(error).alias("value_std"))
