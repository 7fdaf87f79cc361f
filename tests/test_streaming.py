"""Streams against their batch twins, over several files and with late data."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chromasea.streaming import composites
from chromasea.streaming.restated import RestatedDays
from chromasea.streaming.supersede import SupersedeTable

SCHEMA = "start_ts timestamp, y int, x int, chl double, platform string, rel_orbit int"


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def row(day, hour, chl, y=0, platform="S3A", orbit=1):
    return (datetime(2024, 1, day, hour), y, 0, chl, platform, orbit)


@pytest.fixture()
def folder(spark, tmp_path):
    path = str(tmp_path / "in")
    for day in range(1, 8):
        write(spark, path, [row(day, h, day + h / 24, y, orbit=day) for h in (1, 9, 17) for y in (0, 1)])
    return path


def same(a, b):
    cols = sorted(a.columns)
    key = lambda r: [str(v) for v in r]
    rows = [sorted((tuple(r) for r in df.select(*cols).collect()), key=key) for df in (a, b)]
    assert len(rows[0]) == len(rows[1])
    for p, q in zip(*rows):
        assert list(p) == pytest.approx(list(q)) if all(isinstance(v, (int, float)) for v in p) else \
            [round(v, 9) if isinstance(v, float) else v for v in p] == [round(v, 9) if isinstance(v, float) else v for v in q]


def test_stream_equals_batch(spark, folder):
    stream = composites.read_stream(spark, folder, spark.read.parquet(folder).schema, per_trigger=2)
    out = composites.run_to_table(composites.tumbling_composite(stream, ["chl"]), "t", "update")
    same(out, composites.tumbling_composite(spark.read.parquet(folder), ["chl"]))
    same(composites.slide_days(out, ["chl"]), composites.sliding_composite(spark.read.parquet(folder), ["chl"]))


def test_groups_change_over_triggers(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in ([row(1, 1, 1.0)], [row(1, 5, 3.0), row(2, 1, 5.0)]):
        write(spark, path, rows)
        stream = composites.tumbling_composite(composites.read_stream(spark, path, schema), ["chl"], lateness="3 days")
        got = composites.run_to_table(stream, "u", "update", out, check)
    assert {r.day.day: (r.chl, r.n_chl) for r in got.collect()} == {1: (2.0, 2), 2: (5.0, 1)}


def test_open_passes_come_from_state(spark, folder):
    static = spark.read.parquet(folder)
    followed = composites.follow_passes(composites.read_stream(spark, folder, static.schema, per_trigger=2), "9 hours")
    every = composites.run_to_table(followed, "p", "update", keys=composites.key_of_passes())
    every = every.where("n_granules > 0")
    # The watermark lies a day behind the last granule; the passes of that day and the one before have not ended by then.
    assert {r.rel_orbit: r.closed for r in every.collect()} == {d: d <= 5 for d in range(1, 8)}
    same(every.drop("closed"), composites.detect_passes(static, "9 hours"))


def test_passes_joined_by_a_later_granule_and_late_ones(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        followed = composites.follow_passes(composites.read_stream(spark, path, schema), "6 hours")
        table = composites.run_to_table(followed, "p", "update", out, check, composites.key_of_passes())
        return {(r.rel_orbit, r.pass_start.day, r.pass_start.hour, r.pass_end.hour, r.n_granules, r.closed) for r in table.where("n_granules > 0").collect()}

    write(spark, path, [row(1, 0, 1.0), row(1, 10, 1.0), row(1, 10, 1.0, orbit=None)])
    assert run() == {(1, 1, 0, 6, 1, False), (1, 1, 10, 16, 1, False), (None, 1, 10, 16, 1, False)}
    write(spark, path, [row(1, 5, 1.0)])  # joins both
    assert run() == {(1, 1, 0, 16, 3, False), (None, 1, 10, 16, 1, False)}
    write(spark, path, [row(4, 0, 1.0, orbit=2)])  # the watermark goes by
    assert run() == {(1, 1, 0, 16, 3, True), (None, 1, 10, 16, 1, True), (2, 4, 0, 6, 1, False)}
    write(spark, path, [row(1, 12, 1.0), row(5, 0, 1.0, orbit=3)])  # too late: dropped
    assert {r for r in run() if r[0] == 1} == {(1, 1, 0, 16, 3, True)}


def test_late_rows_restate_their_day(spark, tmp_path):
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    schema = spark.createDataFrame([], SCHEMA).schema
    days = RestatedDays(spark, ["chl"], path=str(tmp_path / "days"))

    def run():
        return {r.day.day: (r.chl, r.n_chl, r.n_late) for r in days.run(composites.read_stream(spark, path, schema), check).collect()}

    write(spark, path, [row(1, 1, 1.0), row(2, 1, 2.0), row(2, 1, None)])
    assert run() == {1: (1.0, 1, 0), 2: (2.0, 1, 0)}
    write(spark, path, [row(1, 5, 3.0), row(4, 1, 4.0)])
    days.compact()
    assert run() == {1: (2.0, 2, 0), 2: (2.0, 1, 0), 4: (4.0, 1, 0)}
    write(spark, path, [row(1, 6, 8.0), row(7, 1, 7.0)])
    days.compact()
    days.compact()
    assert run() == {1: (4.0, 3, 1), 2: (2.0, 1, 0), 4: (4.0, 1, 0), 7: (7.0, 1, 0)}  # closed by the fourth
    same(days.read().drop("n_late"), composites.tumbling_composite(spark.read.parquet(path), ["chl"]))


def test_a_repeated_batch_counts_once(spark, tmp_path):
    days = RestatedDays(spark, ["chl"], path=str(tmp_path / "days"))
    with pytest.raises(ValueError):
        days.read()
    days.compact()
    batch = spark.createDataFrame([row(1, 1, 1.0), row(1, 2, 3.0)], SCHEMA)
    for number, source in ((0, "a"), (0, "a"), (0, "b"), (1, "a"), (1, "a")):
        days.merge(batch, number, source)
    assert [(r.chl, r.n_chl) for r in days.read().collect()] == [(2.0, 6)]


def test_range_filter_in_composite(spark, folder):
    got = composites.tumbling_composite(spark.read.parquet(folder), {"chl": (0.0, 2.0)}, keys=("y",)).where("y = 0")
    assert {r.day.day: r.n_chl for r in got.collect()} == {1: 3, **{d: 0 for d in range(2, 8)}}


def test_passes(spark, folder):
    batch = composites.detect_passes(spark.read.parquet(folder), "9 hours")
    assert {(r.rel_orbit, r.n_granules) for r in batch.collect()} == {(d, 6) for d in range(1, 8)}


def test_late_rows_are_dropped_after_the_day_has_closed(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream = composites.read_stream(spark, path, schema)
        df = composites.tumbling_composite(stream, ["chl"], lateness="1 day")
        return {r.day.day: (r.chl, r.n_chl) for r in composites.run_to_table(df, "late", "append", out, check).collect()}

    write(spark, path, [row(1, 1, 1.0), row(2, 1, 2.0)])
    assert run() == {}
    write(spark, path, [row(1, 5, 3.0), row(4, 1, 4.0)])  # late but within the watermark: still counted
    assert run() == {1: (2.0, 2), 2: (2.0, 1)}
    write(spark, path, [row(1, 6, 99.0), row(7, 1, 7.0)])  # the first has closed: dropped
    assert run() == {1: (2.0, 2), 2: (2.0, 1), 4: (4.0, 1)}


def test_supersede_is_idempotent_and_keeps_the_best(spark):
    def batch(rows):
        return spark.createDataFrame(rows, "obs_date date, y int, x int, timeliness string, v double")

    from datetime import date
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    table = SupersedeTable(spark)
    table.merge(batch([(d1, 0, 0, "NR", 1.0), (d1, 0, 1, "NR", 2.0), (d2, 0, 0, "NR", 3.0)]), 0)
    second = batch([(d1, 0, 0, "NT", 10.0), (d1, 0, 2, "NT", 30.0)])
    table.merge(second, 1)
    table.merge(second, 1)  # a repeated batch after a failure
    table.merge(batch([(d1, 0, 0, "NR", 5.0)]), 2)  # a late near-real-time row changes nothing
    table.merge(batch([(d2, 0, 0, "NR", 4.0), (d2, 1, 1, "ST", 7.0)]), 0, "another checkpoint")  # numbers start again
    got = {(str(r.obs_date), r.x): (r.timeliness, r.v) for r in table.read().collect()}
    kept = [len(os.listdir(f"{table.path}/rows/obs_date={d}")) for d in (d1, d2)]
    assert max(kept) <= 2  # the version before may be merged with again
    assert got == {("2024-01-01", 0): ("NT", 10.0), ("2024-01-01", 1): ("NR", 2.0), ("2024-01-01", 2): ("NT", 30.0),
                   ("2024-01-02", 0): ("NR", 3.0), ("2024-01-02", 1): ("ST", 7.0)}


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    from datetime import date
    schema = "obs_date date, y int, x int, timeliness string, v double"
    table = SupersedeTable(spark, str(tmp_path / "table"))
    for n, rows in enumerate(([(date(2024, 1, 1), 0, 0, "NT", 1.0)], [(date(2024, 1, 1), 1, 1, "NR", 2.0)])):
        path = str(tmp_path / f"in{n}")
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(path)
        out = table.run(composites.read_stream(spark, path, df.schema), str(tmp_path / f"check{n}"))
    assert {(r.y, r.v) for r in out.collect()} == {(0, 1.0), (1, 2.0)}
