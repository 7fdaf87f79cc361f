"""Near-real-time data replaced by later, better data (T-05)."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chromasea.session import scratch_path
from chromasea.sources.catalogue import best_timeliness


class SupersedeTable:
    """A daily product in which the best timeliness per (date, cell) is kept.

    The table is a folder of date=/version=/batch= partitions; of every date the
    latest version counts. A micro-batch merges only the dates it holds: it reads
    their current version, keeps the best row per key and writes the next version,
    one more than any the date has, under the name of its checkpoint and its
    number. A batch that is repeated finds its own name, merges with the version
    before it and writes the same place again, so the merge is idempotent, and a
    new checkpoint never hides rows that an older one stored.

    A batch reads the folders of its own dates alone, and removes their versions before the last but one, so the
    table doesn't grow with the number of batches; a reader that has begun before has to be run again.
    Rows without a date are stored like those of any date. The checkpoint lies beside the table unless another is named.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, keys: Sequence[str] = ("obs_date", "y", "x"),
                 day: str = "obs_date", tie: Sequence[str] = (), files_per_day: int = 1) -> None:
        self.spark, self.keys, self.day, self.tie = spark, list(keys), day, list(tie)
        self.path, self.files_per_day = path or scratch_path(spark, "supersede"), files_per_day

    def _every(self) -> DataFrame | None:
        """All versions, or None before the first."""
        try:
            return self.spark.read.parquet(f"{self.path}/rows")
        except Exception as error:  # nothing written yet
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise

    def _latest(self, every: DataFrame) -> DataFrame:
        """Of every date the rows of its latest version."""
        latest = every.select(self.day, "version").groupBy(self.day).agg(F.max("version").alias("version"))
        return every.join(latest, [self.day, "version"], "left_semi")

    def merge(self, batch: DataFrame, batch_id: int, source: str = "direct") -> None:
        """Fold one micro-batch of a source (a checkpoint) into the dates it touches."""
        name = f"{source}-{batch_id}"
        every = self._every()
        rows, before = batch, None
        # The dates of a batch, a row each: as constants they keep the scan to the folders of these dates.
        dates = [r[0] for r in batch.select(self.day).distinct().collect()]
        if every is not None:
            every = every.where(F.col(self.day).isin(dates))
            others = every.where(F.col("batch") != name)
            own = every.where(F.col("batch") == name).select(self.day, F.col("version").alias("_own")).distinct()
            # what a repeated batch merges with is what lay below its own version then
            held = others.join(own, self.day, "left").where(F.col("_own").isNull() | (F.col("version") < F.col("_own"))).drop("_own")
            current = self._latest(held)
            before = current.select(self.day, "version").distinct()
            rows = current.drop("version", "batch").unionByName(batch)
        best = best_timeliness(rows, self.keys, tie=self.tie)
        if before is None:
            best = best.withColumn("version", F.lit(0).cast("bigint"))
        else:
            best = best.join(before, self.day, "left").withColumn("version", F.coalesce(F.col("version") + 1, F.lit(0)).cast("bigint"))
        salt = F.pmod(F.xxhash64(*self.keys), F.lit(self.files_per_day))
        best.withColumn("batch", F.lit(name)).repartition(self.day, salt).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(self.day, "version", "batch").parquet(f"{self.path}/rows")
        self._remove_older(dates)

    def _remove_older(self, dates: Sequence) -> None:
        """Of the dates that a batch touched, keep the version it wrote and the one before, from which it may be repeated."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for date in dates:
            found = files.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{self.day}={date}/version=*")) or []
            versions = sorted(((int(f.getPath().getName().split("=")[1]), f.getPath()) for f in found), key=lambda v: v[0])
            for _, path in versions[:-2]:
                files.delete(path, True)

    def read(self) -> DataFrame:
        every = self._every()
        if every is None:
            raise ValueError("nothing merged yet")
        return self._latest(every).drop("version", "batch")

    def run(self, stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
        """Merge everything a stream has available and return the table."""
        checkpoint = checkpoint or f"{self.path}/checkpoint"
        source = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
        query = (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(lambda batch, n: self.merge(batch, n, source)).start()
        )
        query.awaitTermination()
        return self.read()
