"""Session settings, shared scratch space, and bounded tables for plans."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Largest table that may become a plan-time constant (kernel models, band lists).
PLAN_TIME_ROWS = 50_000


def build_session(app: str = "chromasea", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    UTC keeps day boundaries stable; AQE sizes and de-skews the shuffles. The
    number of shuffle partitions is left to the caller on a cluster, where AQE
    coalesces from a generous start.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # The JVM interprets methods above 8000 bytes; above this limit Spark falls back
        # to projections split into small methods, which are compiled.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="chromasea-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint directory of the session.

    On a cluster `spark.checkpoint.dir` must name storage that all executors
    see. Only a local master, where driver and executors are one process, falls
    back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to shared scratch and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collect_bounded(df: DataFrame, limit: int = PLAN_TIME_ROWS) -> list:
    """Rows of a small table; raises instead of pulling a large one to the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows: too large for a plan-time table")
    return rows
