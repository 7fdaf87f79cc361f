"""Shared scratch tables, binary files in shared storage, and small text helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space that separates words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="chromasea-llm-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below `spark.checkpoint.dir`, which all executors must see.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to shared scratch and read it back: later steps survive a lost executor."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    with _shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_freed(spark: SparkSession):
    """Shuffle files of the write inside are removed when it ends, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def file_system(uri: str):
    """The pyarrow file system and the path in it of a URI or of a plain local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def task_file(folder: str, suffix: str) -> str:
    """A file name that no other attempt of any task uses; who lists the finished files decides which count."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{folder}/part-{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}{suffix}"


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus`: the fixed folds. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it as needed to differ from all columns of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def broadcast_rows(df: DataFrame, limit: int) -> DataFrame:
    """A broadcast hint for a side of at most `limit` rows, as counted; beyond it Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
