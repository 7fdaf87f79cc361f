"""Streaming composites and pass detection (T-01 to T-04) with their batch twins.

Each operator is one function on a DataFrame with an event-time column. On a
stream it adds a watermark and keeps state per group; on a static table the same
plan is the batch twin.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from chromasea.session import scratch_path


def _timed(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    """Event time as a zoned timestamp (watermarks reject local ones), with a watermark on streams."""
    cast = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return cast.withWatermark(ts, lateness) if df.isStreaming else cast


def _means(cols: Mapping[str, tuple[float, float]] | Sequence[str]) -> list:
    aggs = []
    for c in cols:
        v = F.col(c)
        if isinstance(cols, Mapping):
            v = F.when(v.between(*[F.lit(x) for x in cols[c]]), v)
        aggs += [F.avg(v).alias(c), F.count(v).alias(f"n_{c}")]
    return aggs


def tumbling_composite(df: DataFrame, cols: Mapping | Sequence[str], keys: Sequence[str] = ("y", "x"),
                       ts: str = "start_ts", lateness: str = "1 day") -> DataFrame:
    """T-01. Mean and count per calendar day and cell."""
    grouped = _timed(df, ts, lateness).groupBy(F.window(ts, "1 day").alias("_w"), *keys)
    return grouped.agg(*_means(cols)).withColumn("day", F.col("_w.start").cast("date")).drop("_w")


def sliding_composite(df: DataFrame, cols: Mapping | Sequence[str], keys: Sequence[str] = ("y", "x"),
                      ts: str = "start_ts", days: int = 11, lateness: str = "1 day") -> DataFrame:
    """T-02. Running composite over `days` days, one result per day.

    Measurements are folded per day; on a stream that fold alone is state (run
    `tumbling_composite` to a table, then `slide_days` over it).
    """
    if df.isStreaming:
        raise ValueError("run tumbling_composite on the stream and slide_days on its table")
    return slide_days(tumbling_composite(df, cols, keys, ts, lateness), list(cols), keys, days)


def slide_days(tumbling: DataFrame, names: Sequence[str], keys: Sequence[str] = ("y", "x"), days: int = 11) -> DataFrame:
    """T-02. Fold daily means and counts over `days` days, one result per day.

    Days are partitioned by cell before they are repeated over the windows that
    hold them, and folded in place.
    """
    daily = tumbling.select(
        *keys, "day", *[(F.col(c) * F.col(f"n_{c}")).alias(f"_s_{c}") for c in names], *[f"n_{c}" for c in names]
    ).repartition(*keys)
    spread = daily.withColumn("day", F.explode(F.sequence(F.date_sub("day", days - 1), F.col("day"))))
    sums = spread.groupBy(*keys, "day").agg(
        *[F.sum(f"_s_{c}").alias(f"_s_{c}") for c in names], *[F.sum(f"n_{c}").alias(f"n_{c}") for c in names]
    )
    return sums.select(
        *[a for c in names for a in (F.try_divide(F.col(f"_s_{c}"), F.col(f"n_{c}")).alias(c), f"n_{c}")],
        "day", *keys,
    )


def detect_passes(df: DataFrame, gap: str = "30 minutes", keys: Sequence[str] = ("platform", "rel_orbit"),
                  ts: str = "start_ts", lateness: str = "1 day") -> DataFrame:
    """T-03. Runs of granules of one platform and orbit, closed by a gap."""
    grouped = _timed(df, ts, lateness).groupBy(F.session_window(ts, gap).alias("_s"), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("n_granules")).select(
        *keys, F.col("_s.start").alias("pass_start"), F.col("_s.end").alias("pass_end"), "n_granules"
    )


PASS_STATE = "starts array<timestamp>, ends array<timestamp>, counts array<bigint>"


def follow_passes(stream: DataFrame, gap: str = "30 minutes", keys: Sequence[str] = ("platform", "rel_orbit"),
                  ts: str = "start_ts", lateness: str = "1 day") -> DataFrame:
    """T-03 on a stream, open passes included: every pass a trigger changed, and each that the watermark has closed.

    The state of a key is its open passes (start, end, number); granules extend, join or begin some, and an
    event-time timer at the earliest end closes them. Run it in update mode with `key_of_passes(keys)` as keys: the latest row
    of a start counts, and one with no granules says that the pass was joined to an earlier one. Late granules are
    dropped by the watermark, as in append mode. A null key is a key.
    """
    names = list(keys)
    kinds = dict(stream.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in names) + ", pass_start timestamp, pass_end timestamp, n_granules bigint, closed boolean"
    width = pd.Timedelta(gap)

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = list(zip(*state.get)) if state.exists else []
        out: list[tuple] = []
        if state.hasTimedOut:
            now = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms")
            out = [(*p, True) for p in before if p[1] <= now]
            after = [p for p in before if p[1] > now]
        else:
            arrived = [(t, t + width, 1) for frame in frames for t in frame[ts] if not pd.isna(t)]
            after = []
            for start, end, n in sorted([*((pd.Timestamp(a), pd.Timestamp(b), c) for a, b, c in before), *arrived]):
                if after and start < after[-1][1]:
                    after[-1] = (after[-1][0], max(after[-1][1], end), after[-1][2] + n)
                else:
                    after.append((start, end, n))
            known = {pd.Timestamp(p[0]): p for p in before}
            out = [(*p, False) for p in after if p[0] not in known or tuple(known[p[0]])[1:] != p[1:]]
            out += [(start, p[1], 0, False) for start, p in known.items() if start not in {a[0] for a in after}]
        if after:
            state.update(tuple(map(list, zip(*after))))
            # A timer must lie behind the watermark; a pass that ends there or before is closed by the next one.
            end = int(min(pd.Timestamp(p[1]) for p in after).timestamp() * 1000)
            state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            rows = pd.DataFrame(out, columns=["pass_start", "pass_end", "n_granules", "closed"])
            for at, name in enumerate(names):
                rows.insert(at, name, [key[at]] * len(rows))
            yield rows

    timed = _timed(stream, ts, lateness).select(*names, ts)
    return timed.groupBy(*names).applyInPandasWithState(follow, schema, PASS_STATE, "update", GroupStateTimeout.EventTimeTimeout)


def key_of_passes(keys: Sequence[str] = ("platform", "rel_orbit")) -> list[str]:
    """Columns that name a pass in the table of `follow_passes`."""
    return [*keys, "pass_start"]


def read_stream(spark: SparkSession, path: str, schema: T.StructType, per_trigger: int | None = None) -> DataFrame:
    """Files of a folder (or one file) as a stream, in the order of their arrival."""
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, name: str, mode: str = "append", out: str | None = None,
                 checkpoint: str | None = None, keys: Sequence[str] = ("day", "y", "x")) -> DataFrame:
    """Run a stream over everything available and give back what it wrote.

    Results and checkpoint lie in shared storage. In append mode Spark writes
    the files itself and emits a group when the watermark has passed it. In update
    mode each trigger adds the groups that it changed under its number, and the
    latest row of every `keys` counts; groups leave the state with the watermark.
    A repeated trigger writes the same place again.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", out).start()
        query.awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    if mode != "update":
        raise ValueError(f"mode {mode!r}: append or update")

    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer.outputMode("update").foreachBatch(add).start().awaitTermination()
    every = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    rest = [c for c in stream.columns if c not in keys]
    latest = every.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in stream.columns])
