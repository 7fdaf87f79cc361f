"""Daily composites that late measurements restate (T-04)."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chromasea.session import scratch_path


class RestatedDays:
    """Means and counts per day and cell, kept as sums, so that a late row changes its day like any other.

    Each micro-batch leaves the sums and counts of its own rows, a row per day and cell that it
    touches, under its source (a checkpoint) and number; a repeated batch writes the same place again. A day is the
    sum of what the batches left. The days of a batch that ended before the watermark of the batches before it were closed:
    their rows are late, and are counted as such, so that append-mode results that have gone out can be restated.
    `compact` folds all that is there into one piece.
    """

    def __init__(self, spark: SparkSession, names: Sequence[str], keys: Sequence[str] = ("y", "x"), ts: str = "start_ts",
                 lateness: str = "1 day", path: str | None = None) -> None:
        self.spark, self.names, self.keys, self.ts, self.lateness = spark, list(names), list(keys), ts, lateness
        self.path = path or scratch_path(spark, "restated")

    def _pieces(self) -> DataFrame | None:
        """What batches left, without pieces that a later one replaces; None before the first."""
        try:
            every = self.spark.read.parquet(f"{self.path}/sums")
        except Exception as error:  # nothing written yet
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise
        # A folded piece stands for all of its generation's; generations are folder names, so others are pruned.
        newest = every.agg(F.max("generation")).first()[0]
        return every.where(F.col("generation") == newest)

    def merge(self, batch: DataFrame, batch_id: int, source: str = "direct") -> None:
        """Add the sums of one micro-batch."""
        pieces = self._pieces()
        name, generation = f"{source}-{batch_id}", 0
        watermark = F.lit(None).cast("timestamp")
        if pieces is not None:
            generation = pieces.select("generation").first()[0]
            others = pieces.where(F.col("piece") != name)
            # Only batches before this one of the same source, and all other sources, were there then.
            earlier = others.where((F.col("source") != source) | (F.col("number") < batch_id))
            watermark = F.lit(earlier.agg(F.max("latest")).first()[0]).cast("timestamp") - F.expr(f"interval {self.lateness}")
        timed = batch.withColumn(self.ts, F.col(self.ts).cast("timestamp")).where(F.col(self.ts).isNotNull()).withColumn("day", F.col(self.ts).cast("date"))
        late = F.coalesce(F.date_add("day", 1).cast("timestamp") <= watermark, F.lit(False))
        sums = timed.groupBy("day", *self.keys).agg(
            *[F.sum(c).alias(f"_s_{c}") for c in self.names], *[F.count(c).alias(f"n_{c}") for c in self.names],
            F.count_if(late).alias("n_late"), F.max(self.ts).alias("latest"))
        named = sums.withColumns({"source": F.lit(source), "number": F.lit(batch_id).cast("bigint")})
        named.write.mode("overwrite").parquet(f"{self.path}/sums/generation={generation}/piece={name}")

    def _folded(self, pieces: DataFrame) -> DataFrame:
        return pieces.groupBy("day", *self.keys).agg(
            *[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in self.names], *[F.sum(f"n_{c}").alias(f"n_{c}") for c in self.names],
            F.sum("n_late").alias("n_late"), F.max("latest").alias("latest"))

    def compact(self) -> None:
        """Fold all pieces into the first of a new generation. Not while a batch is being merged."""
        pieces = self._pieces()
        if pieces is None:
            return
        generation = pieces.select("generation").first()[0] + 1
        folded = self._folded(pieces).withColumns({"source": F.lit("folded"), "number": F.lit(0).cast("bigint")})
        folded.write.mode("overwrite").parquet(f"{self.path}/sums/generation={generation}/piece=folded")

    def read(self) -> DataFrame:
        """day, keys, means and counts, and `n_late`: rows that came after their day was closed."""
        pieces = self._pieces()
        if pieces is None:
            raise ValueError("nothing merged yet")
        means = [a for c in self.names for a in (F.try_divide(F.col(f"_s_{c}"), F.col(f"n_{c}")).alias(c), f"n_{c}")]
        return self._folded(pieces).select("day", *self.keys, *means, "n_late")

    def run(self, stream: DataFrame, checkpoint: str | None = None) -> DataFrame:
        """Merge everything a stream has available and return the days."""
        checkpoint = checkpoint or f"{self.path}/checkpoint"
        source = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]
        writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.foreachBatch(lambda batch, n: self.merge(batch, n, source)).start().awaitTermination()
        return self.read()
