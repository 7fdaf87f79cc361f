"""Queries for the streaming operators and their batch twins (T-01 to T-05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chromasea.queries.base import query, table, view
from chromasea.session import scratch_path
from chromasea.sources.catalogue import best_timeliness
from chromasea.streaming import composites
from chromasea.streaming.restated import RestatedDays
from chromasea.streaming.supersede import SupersedeTable

KEYS = ("y", "x")


def _pixels(events):
    """A measurement per event, in a 6 x 5 grid."""
    return events.select(
        F.col("ts").alias("start_ts"), (F.col("user_id") % 6).cast("int").alias("y"),
        (F.col("event_id") % 5).cast("int").alias("x"), (F.col("value") / 1.0037).alias("chl"))


def _event_stream(spark, sf):
    # a pattern, since a stream may not start from the path of a single file
    schema = table(spark, sf, "events").schema
    return composites.read_stream(spark, f"{sf}/event[s].parquet", schema)


_PIX = "select ts, cast(user_id % 6 as integer) as y, cast(event_id % 5 as integer) as x, value / 1.0037e0 as chl from events"
_TUMBLING = f"""
    select cast(ts as date) as day, y, x, avg(chl) as chl, count(chl) as n_chl from ({_PIX}) as p group by 1, 2, 3
"""
_SLIDING = f"""
    select cast(cast(ts as date) - cast(k as integer) as date) as day, y, x, avg(chl) as chl, count(chl) as n_chl
    from ({_PIX}) as p cross join range(0, 11) as r(k) group by 1, 2, 3
"""


@query("t01_tumbling_batch", _TUMBLING, 8, ("chl",))
def _(spark, sf):
    return composites.tumbling_composite(_pixels(table(spark, sf, "events")), ["chl"], KEYS)


@query("t01_tumbling_stream", _TUMBLING, 8, ("chl",))
def _(spark, sf):
    stream = composites.tumbling_composite(_pixels(_event_stream(spark, sf)), ["chl"], KEYS)
    return composites.run_to_table(stream, "tumbling", "update")


@query("t02_sliding_batch", _SLIDING, 8, ("chl",))
def _(spark, sf):
    return composites.sliding_composite(_pixels(table(spark, sf, "events")), ["chl"], KEYS)


@query("t02_sliding_stream", _SLIDING, 8, ("chl",))
def _(spark, sf):
    # the state of the stream is one row per day and cell; windows are folded from its table
    stream = composites.tumbling_composite(_pixels(_event_stream(spark, sf)), ["chl"], KEYS)
    return composites.slide_days(composites.run_to_table(stream, "sliding", "update"), ["chl"], KEYS)


_PASSES = """
    with g as (select platform, rel_orbit, start_ts,
        case when start_ts < lag(start_ts) over w + interval 12 hour then 0 else 1 end as fresh
      from granules window w as (partition by platform, rel_orbit order by start_ts)),
    s as (select *, sum(fresh) over (partition by platform, rel_orbit order by start_ts
        rows between unbounded preceding and current row) as run from g)
    select platform, rel_orbit, epoch_us(min(start_ts)) as pass_start,
      epoch_us(max(start_ts) + interval 12 hour) as pass_end, count(*) as n_granules
    from s group by platform, rel_orbit, run
"""


def _micros(df):
    return df.withColumns({c: F.unix_micros(c) for c in ("pass_start", "pass_end")})


@query("t03_passes_batch", _PASSES)
def _(spark, sf):
    return _micros(composites.detect_passes(view(spark, sf, "granules"), "12 hours"))


def _in_arrivals(spark, rows, ts, n=3, name="arrivals"):
    """The rows as a stream of `n` micro-batches in the order of time, from files written one after the other."""
    source = scratch_path(spark, name)
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    borders = rows.select(seconds.cast("double").alias("s")).approxQuantile("s", [i / n for i in range(1, n)], 0.01)
    for low, high in zip([None, *borders], [*borders, None]):
        part = rows if low is None else rows.where(seconds >= low)
        (part if high is None else part.where(seconds < high)).coalesce(1).write.mode("append").parquet(source)
    return composites.read_stream(spark, source, rows.schema, per_trigger=1)


@query("t03_passes_stream", f"""
    select *, pass_end <= (select epoch_us(max(start_ts)) from granules) - 86400000000 as closed from ({_PASSES}) as p
""")
def _(spark, sf):
    # closed and open passes both come from the state of the stream, over several micro-batches
    granules = view(spark, sf, "granules").select("platform", "rel_orbit", "start_ts")
    followed = composites.follow_passes(_in_arrivals(spark, granules, "start_ts"), "12 hours")
    passes = composites.run_to_table(followed, "passes", "update", keys=composites.key_of_passes())
    return _micros(passes.where("n_granules > 0"))


@query("t04_restated_days", f"""
    with s as (select cast(ts as timestamp) as ts, cast(user_id % 6 as integer) as y, cast(event_id % 5 as integer) as x, value / 1.0037e0 as chl,
        event_id % 10 = 0 as held from events),
      w as (select max(ts) - interval 1 day as mark from s where not held)
    select cast(ts as date) as day, y, x, avg(chl) as chl, count(chl) as n_chl,
      count(*) filter (where held and date_trunc('day', ts) + interval 1 day <= mark) as n_late
    from s cross join w group by 1, 2, 3
""", 8, ("chl",))
def _(spark, sf):
    """A tenth of the rows arrives after all others, most of it when its day is closed."""
    events = table(spark, sf, "events")
    rows = events.select("event_id", F.col("ts").alias("start_ts"), (F.col("user_id") % 6).cast("int").alias("y"),
                         (F.col("event_id") % 5).cast("int").alias("x"), (F.col("value") / 1.0037).alias("chl"))
    source, checkpoint = scratch_path(spark, "late"), scratch_path(spark, "late-checkpoint")
    days, out = RestatedDays(spark, ["chl"], KEYS), None
    for held in (False, True):
        rows.where((F.col("event_id") % 10 == 0) == held).write.mode("append").parquet(source)
        out = days.run(composites.read_stream(spark, source, rows.schema), checkpoint)
        days.compact()
    return out


@query("t04_late_data", f"""
    select * from ({_TUMBLING}) as t
    where cast(day as timestamp) + interval 1 day <= (select max(ts) from events) - interval 2 day
""", 8, ("chl",))
def _(spark, sf):
    # closed days only: later granules could still change the others
    stream = composites.tumbling_composite(_pixels(_event_stream(spark, sf)), ["chl"], KEYS, lateness="2 days")
    return composites.run_to_table(stream, "late", "append")


_BEST = """
    select obs_date, y, x, timeliness, chl, event_id from (
      select cast(ts as date) as obs_date, cast(user_id % 6 as integer) as y, cast(event_id % 5 as integer) as x,
        case when event_type = 'purchase' then 'NR' when event_type = 'error' then 'NT' else 'other' end as timeliness,
        value as chl, event_id,
        row_number() over (partition by cast(ts as date), user_id % 6, event_id % 5
          order by case event_type when 'error' then 1 when 'purchase' then 2 else 3 end, event_id) as rn
      from events) as s where rn = 1
"""


def _timely(events):
    kind = F.when(F.col("event_type") == "purchase", "NR").when(F.col("event_type") == "error", "NT").otherwise("other")
    return events.select(
        F.col("ts").cast("date").alias("obs_date"), (F.col("user_id") % 6).cast("int").alias("y"),
        (F.col("event_id") % 5).cast("int").alias("x"), kind.alias("timeliness"), F.col("value").alias("chl"),
        "event_id")


@query("t05_supersede_batch", _BEST, 8, ("chl",))
def _(spark, sf):
    return best_timeliness(_timely(table(spark, sf, "events")), ["obs_date", "y", "x"], tie=["event_id"])


@query("t05_supersede_stream", _BEST, 8, ("chl",))
def _(spark, sf):
    # rows of other timeliness arrive first, near-real-time rows then, their replacements last
    source = scratch_path(spark, "arrivals")
    rows = _timely(table(spark, sf, "events"))
    merged = SupersedeTable(spark, tie=["event_id"])
    checkpoint = scratch_path(spark, "arrivals-checkpoint")
    out = None
    for kind in ("other", "NR", "NT"):
        rows.where(F.col("timeliness") == kind).write.mode("append").parquet(source)
        out = merged.run(composites.read_stream(spark, source, rows.schema), checkpoint)
    return out.select("obs_date", "y", "x", "timeliness", "chl", "event_id")
