"""Operators against brute force, properties and edge rows."""

import bisect
import itertools
import math
import random
import statistics
from collections import defaultdict
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from chromasea.functions import projection
from chromasea.functions.weights import spatial_weight, temporal_weight
from chromasea.operators import climatology, composite, coefficients, grid, grouping, neighbours, overlap, quality, ranges, resample
from chromasea.operators.months import MonthlyState
from chromasea.operators.neighbours import smooth_3x3
from chromasea.sources import catalogue

PIX = "granule_id bigint, platform string, obs_date date, y int, x int, mask int, a double, b double"
LIMITS = {"a": (-1.0, 1.0), "b": (0.0, 1.0)}
D = date(2024, 3, 1)


def pixels(spark, rows):
    return spark.createDataFrame(rows, PIX)


def test_composite_of_one_granule_is_the_granule(spark):
    rows = [(1, "S3A", D, y, x, 1, y * 0.1, x * 0.1) for y in range(3) for x in range(3)]
    out = composite.daily_composite(pixels(spark, rows), LIMITS, with_mask=True).collect()
    assert {(r.y, r.x): (r.a, r.b, r.sum_weights, r.sensormask) for r in out} == {
        (y, x): (y * 0.1, x * 0.1, 1, 1) for *_, y, x, _, _, _ in rows}


def test_composite_edges_and_order(spark):
    rows = [
        (1, "S3A", D, 0, 0, 1, 0.2, 0.4), (2, "S3B", D, 0, 0, 1, 0.4, 2.0),   # b out of range in one granule
        (1, "S3A", D, 0, 1, 0, 0.2, 0.4),                                       # masked
        (1, "S3A", D, 0, 2, None, 0.2, 0.4),                                    # no data
        (1, "S3A", D, 0, 3, 1, None, None),                                     # all missing
        (1, "S3A", D, 0, 4, 1, -0.5, 0.4), (2, "S3B", D, 0, 4, 1, 0.1, 0.2),   # negative central mean
    ]
    a = composite.daily_composite(pixels(spark, rows), LIMITS, with_mask=True)
    b = composite.daily_composite(pixels(spark, random.Random(1).sample(rows, len(rows))), LIMITS, with_mask=True)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    got = {r.x: r for r in a.collect()}
    assert got[0].a == pytest.approx(0.3) and got[0].b == 0.4 and got[0].sensormask == 3 and got[0].n_granules == 2
    assert got[1].a is None and got[1].n_granules == 1 and got[1].sum_weights == 0
    assert got[2].n_granules == 0 and got[2].sensormask == 0
    assert got[3].a is None and got[3].sum_weights == 1
    central = {r.x: r for r in composite.enforce_central_bands(a, ["a"]).collect()}
    assert central[4].a is None and central[4].sum_weights == 0 and central[4].b == pytest.approx(0.3)
    assert central[0].a is not None and central[0].sum_weights == 2


def test_joint_composite_divisors(spark):
    rows = [(1, "S3A", D, 0, 0, 1, 0.2, 0.4), (2, "S3B", D, 0, 0, 1, 0.4, 5.0), (3, "S3B", D, 0, 0, 1, 9.0, 0.5)]
    own = composite.daily_composite_joint(pixels(spark, rows), LIMITS, ["a"]).first()
    joint = composite.daily_composite_joint(pixels(spark, rows), LIMITS, ["a"], compat_joint_divisor=True).first()
    assert own.a == pytest.approx(0.3) and own.b == 0.4 and joint.b == 0.2 and own.sum_weights == 2


def test_monthly_single_value_has_no_variance(spark):
    df = spark.createDataFrame(
        [(date(2024, 2, 1), 0, 0, 2.0), (date(2024, 2, 2), 0, 0, 4.0), (date(2024, 2, 3), 0, 0, -1.0), (date(2024, 2, 29), 0, 1, 3.0)],
        "obs_date date, y int, x int, chl double")
    got = {r.x: r for r in composite.monthly_composite(df, "chl").collect()}
    assert (got[0].value, got[0].value_count, got[0].value_error) == (3.0, 2, 2.0)
    assert got[0].value_std == pytest.approx(math.sqrt(2)) and got[1].value_error is None and got[1].value_count == 1


def brute_climatology(values, side, years):
    """Plain loops over the sample of every month-day and cell."""
    out = defaultdict(list)
    for (d, y, x), v in values.items():
        for off in range(-5, 6):
            t = d - timedelta(days=off)
            if (t.month, t.day) == (2, 29) or not years[0] <= t.year <= years[1]:
                continue
            for dy, dx in itertools.product((-1, 0, 1), repeat=2):
                ty, tx = y - dy, x - dx
                if 0 <= ty < side and 0 <= tx < side:
                    w = (1.0, 0.5, 0.25)[abs(dy) + abs(dx)] * (6 - abs(off)) / 6
                    out[(t.strftime("%m%d"), ty, tx)].append((v, w))
    return out


def test_climatology_brute_force(spark):
    rng = random.Random(5)
    days = [date(2019, 12, 30), date(2020, 1, 2), date(2020, 2, 26), date(2020, 2, 29), date(2020, 3, 3), date(2021, 3, 1),
            date(2021, 12, 31), date(2021, 7, 1)]
    values = {(d, y, x): rng.uniform(0.1, 5) for d in days for y in range(4) for x in range(4) if rng.random() < 0.5}
    values[(date(2021, 7, 1), 0, 0)] = 1.5
    df = spark.createDataFrame([(*k, v) for k, v in values.items()], "obs_date date, y int, x int, chl double")
    years = (2020, 2021)
    got = {(r.mmdd, r.y, r.x): r for r in climatology.climatology(df, "chl", 4, 4, years=years).collect()}
    want = brute_climatology(values, 4, years)
    assert got.keys() == want.keys() and "0229" not in {k[0] for k in got}
    for key, sample in want.items():
        v, w = [s[0] for s in sample], [s[1] for s in sample]
        r, n = got[key], len(v)
        mu = sum(a * b for a, b in sample) / sum(w)
        assert (r.nofobs, r.min, r.max) == (n, min(v), max(v))
        assert r.median == pytest.approx(statistics.median(v)) and r.n_avg == pytest.approx(statistics.fmean(v))
        assert r.n_std == pytest.approx(statistics.pstdev(v), abs=1e-9) and r.w_avg == pytest.approx(mu)
        assert r.sum_w == pytest.approx(sum(w)) and r.porc_w == pytest.approx(100 * sum(w) / 48)
        if n == 1:
            assert r.w_std is None
        else:
            spread = sum(b * (a - mu) ** 2 for a, b in sample)
            assert r.w_std == pytest.approx(math.sqrt(spread / ((n - 1) / n * sum(w))), abs=1e-7)


def test_climatology_shuffles_once(spark):
    df = spark.range(10).selectExpr("date'2020-01-01' as obs_date", "cast(id as int) y", "cast(id as int) x", "1d as chl")
    plan = climatology.climatology(df, "chl", 10, 10, years=(2020, 2020))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_quality_index_of_29_february(spark):
    daily = spark.createDataFrame([(date(2024, 2, 29), 0, 0, 10.0), (date(2024, 2, 28), 1, 0, 10.0)], "obs_date date, y int, x int, chl double")
    clim = spark.createDataFrame([("0228", 0, 0, 0.5, 0.25)], "mmdd string, y int, x int, median double, n_std double")
    got = {r.y: r.qi_chl for r in climatology.quality_index(daily, clim, "chl", log=True).collect()}
    assert got == {0: 2.0, 1: None}


def test_smooth_3x3(spark):
    rows = [(D, 0, 0, 1.0), (D, 0, 1, 3.0), (D, 1, 1, None)]
    df = spark.createDataFrame(rows, "obs_date date, y int, x int, v double")
    got = {(r.y, r.x): r for r in smooth_3x3(df, "v", 2, 2).collect()}
    assert got[(0, 0)].avg == 2.0 and got[(0, 0)].weighted_avg == pytest.approx((1 + 1.5) / 1.5)
    assert got[(1, 0)].weighted_avg == pytest.approx((0.5 * 1 + 0.25 * 3) / 0.75) and got[(1, 1)].n == 2


TOY = projection.Area("polarn", 30, 30, (-2751778, 2751778, 2751778, -2751778))


def test_resample_brute_force(spark):
    rng = random.Random(3)
    pts = [(g, i, 0, rng.uniform(66, 90), rng.uniform(-180, 180), float(i)) for g in (1, 2) for i in range(150)]
    pts += [(1, 500, 0, 80.0, 10.0, -1.0), (1, 499, 0, 80.0, 10.0, -2.0)]  # equal distances: the lower row wins
    df = spark.createDataFrame(pts, "granule_id int, row int, col int, lat double, lon double, v double")
    radius = 120_000.0
    got = {(r.granule_id, r.y, r.x): r for r in resample.resample_nearest(df, TOY, radius, ["v"]).collect()}
    cells = [tuple(r) for r in grid.make_grid(spark, TOY).select("y", "x", "lon", "lat").collect()]

    def xyz(lon, lat):
        a, b = math.radians(lon), math.radians(lat)
        return math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)

    want = {}
    for g, row, col, lat, lon, v in pts:
        p = xyz(lon, lat)
        for y, x, clon, clat in cells:
            d = projection.EARTH_RADIUS * math.dist(p, xyz(clon, clat))
            if d <= radius:
                want[(g, y, x)] = min(want.get((g, y, x), (9e9,)), (d, row, v))
    assert got.keys() == want.keys()
    for k, (d, _, v) in want.items():
        assert got[k].v == v and got[k].distance == pytest.approx(d, abs=1e-3)


def test_resample_real_grid_ring():
    fine = projection.area("polar_stereographic")
    assert resample.search_ring(fine, resample.RADIUS_FULL_RESOLUTION) == 3
    assert resample.map_radius(fine, 500.0) > 500.0 * 1.02


def test_three_state_mask(spark):
    df = spark.createDataFrame([(1, 0, 0, 89.0, 0.0, 0), (1, 0, 1, 80.0, 0.0, 1), (2, 0, 0, 20.0, 0.0, 0)],
                               "granule_id int, row int, col int, lat double, lon double, mask_default int")
    boxes = spark.createDataFrame([(1, 0, 30, 0, 30), (2, 3, 5, 3, 5)], "granule_id int, y_min int, y_max int, x_min int, x_max int")
    out = resample.resample_mask(df, boxes, TOY, 150_000.0)
    states = {r["mask"]: r["count"] for r in out.groupBy("mask").count().collect()}
    assert sum(states.values()) == 900 and states[0] >= 1 and states[1] >= 1 and states[None] > 800
    report = resample.resample_report(out).collect()
    assert len(report) == 1 and report[0].resampled_n_total == states[0] + states[1]


def boxes(spark, rows):
    return spark.createDataFrame([(i, D, *b) for i, b in enumerate(rows)],
                                 "granule_id int, obs_date date, y_min int, y_max int, x_min int, x_max int")


def brute_pairs(rows, rule):
    def touch(a, b, k, spans):
        inside = a[k] <= b[k] <= a[k + 1] or a[k] <= b[k + 1] <= a[k + 1]
        return inside or (spans and b[k] < a[k] and b[k + 1] > a[k + 1])

    out = set()
    for i, j in itertools.permutations(range(len(rows)), 2):
        a, b = rows[i], rows[j]
        if rule == "intersect":
            hit = i < j and not (b[0] > a[1] or b[1] < a[0] or b[2] > a[3] or b[3] < a[2])
        else:
            hit = all(touch(a, b, k, rule == "ninecase") for k in (0, 2))
        if hit:
            out.add((i, j))
    return out


@pytest.mark.parametrize("rule", ["intersect", "endpoint", "ninecase"])
@pytest.mark.parametrize(("hot", "step", "tile"), [(2000, 1 << 20, 256), (3, 7, 64)])
def test_overlap_rules(spark, monkeypatch, rule, hot, step, tile):
    monkeypatch.setattr(overlap, "HOT_TILE", hot)  # 3: every tile is cut into strips
    monkeypatch.setattr(overlap, "SWEEP_STEP", step)
    rng = random.Random(9)
    rows = [(0, 300, 0, 300), (50, 60, 50, 60)]  # containment
    rows += [(y, y + rng.randint(0, 90), x, x + rng.randint(0, 90)) for y, x in ((rng.randint(-40, 250), rng.randint(0, 250)) for _ in range(40))]
    got = {(r.a_id, r.b_id) for r in overlap.overlap_pairs(boxes(spark, rows), rule, tile=tile).collect()}
    pairs = overlap.overlap_pairs(boxes(spark, rows), rule, tile=tile).count()
    assert got == brute_pairs(rows, rule) and pairs == len(got)
    if rule == "endpoint":
        assert (1, 0) not in got and (0, 1) in got  # the spanning box is missed from inside


def test_group_granules_is_the_repeated_scan(spark):
    rng = random.Random(11)
    rows = [(y, y + rng.randint(5, 60), x, x + rng.randint(5, 60)) for y, x in ((rng.randint(0, 700), rng.randint(0, 700)) for _ in range(300))]
    df = boxes(spark, rows).withColumn("granule_index", F.col("granule_id"))
    two_days = df.unionByName(df.withColumn("obs_date", F.lit(D + timedelta(days=1))))
    got = {(r.obs_date, r.granule_id): r.group_id for r in grouping.group_granules(two_days, cap=10).collect()}
    free, want, group = list(range(len(rows))), {}, 0
    while free:
        group += 1
        members, box = [], None
        for i in list(free):
            if len(members) == 10:
                break
            b = rows[i]
            if box is None or (b[0] <= box[1] and b[1] >= box[0] and b[2] <= box[3] and b[3] >= box[2]):
                box = b if box is None else (min(box[0], b[0]), max(box[1], b[1]), min(box[2], b[2]), max(box[3], b[3]))
                members.append(i)
                free.remove(i)
        want.update({i: group for i in members})
    for day in (D, D + timedelta(days=1)):
        assert {i: got[(day, i)] for i in range(len(rows))} == want


def test_granule_sets_and_spectra(spark):
    rows = [(g, "S3A" if g % 2 else "S3B", D, 0, x, 1, g * 0.1, 0.1) for x in range(4) for g in ((1, 2) if x < 3 else (1, 2, 3))]
    p = pixels(spark, rows)
    sets = overlap.granule_sets(p, 2).collect()
    assert [(r.granules, r.n_pixels) for r in sets] == [([1, 2], 3)]
    spectra = overlap.set_spectra(overlap.set_table(p, 3, ["a"])).collect()
    assert {(r.granule_id, round(r.a, 6)) for r in spectra} == {(1, 0.1), (2, 0.2), (3, 0.3)}
    hist = {(r.kind, r.n): r.value for r in overlap.overlap_histogram(composite.daily_mask(p)).collect()}
    assert hist == {("count", 2): 3.0, ("count", 3): 1.0, ("valid", None): 4.0, ("percent_overlap", None): 100.0}


def test_a_day_without_empty_rows_falls_into_regions(spark):
    # Two columns of boxes: the left one fills all rows, the right one has a gap that only the second cut along y can see.
    rows = [(y, y + 12, 0, 9) for y in range(0, 100, 10)] + [(y, y + 5, 40, 49) for y in (0, 4, 60, 64)]
    df = boxes(spark, rows).withColumn("granule_index", F.col("granule_id"))
    blocks, names = grouping.separate_blocks(df)
    assert blocks.select(*names).distinct().count() == 3
    grouped = grouping.group_granules(df, cap=4)
    assert grouped._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    got = {r.granule_id: r.group_id for r in grouped.collect()}
    assert [got[i] for i in range(len(rows))] == [1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 4, 4, 5, 5]


def test_extent_by_brute_force_without_rows_for_pairs(spark, monkeypatch):
    monkeypatch.setattr(overlap, "HOT_TILE", 5)
    rng = random.Random(2)
    rows = [(y, y + rng.randint(0, 90), x, x + rng.randint(0, 90)) for y, x in ((rng.randint(-40, 250), rng.randint(0, 250)) for _ in range(60))]
    df = boxes(spark, rows + rows[:3]).withColumn("_ty", F.lit("clash"))
    swept = overlap.overlap_extent(df, tile=64)
    for r in swept.collect():
        a = rows[r.granule_id % 60]
        near = [b for b in rows if b[0] <= a[1] and b[1] >= a[0] and b[2] <= a[3] and b[3] >= a[2]]
        assert (r.y_min, r.y_max, r.x_min, r.x_max) == (min(b[0] for b in near), max(b[1] for b in near), min(b[2] for b in near), max(b[3] for b in near))
    plan = overlap.overlap_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan ExistingRDD") == 1


def test_extent_of_a_full_tile_by_its_cells(spark, monkeypatch):
    monkeypatch.setattr(overlap, "FEW", 3)  # most tiles are laid on their cells
    rng = random.Random(4)
    rows = [(-200, 300, 5, 5), (7, 7, -90, 290)]
    rows += [(y, y + rng.randint(0, 90), x, x + rng.randint(0, 90)) for y, x in ((rng.randint(-40, 250), rng.randint(0, 250)) for _ in range(150))]
    for side in (1, 7, 64):
        got = {r.granule_id: (r.y_min, r.y_max, r.x_min, r.x_max) for r in overlap.overlap_extent(boxes(spark, rows if side > 1 else rows[2:5]), tile=side).collect()}
        for i, a in enumerate(rows if side > 1 else rows[2:5]):
            near = [b for b in (rows if side > 1 else rows[2:5]) if b[0] <= a[1] and b[1] >= a[0] and b[2] <= a[3] and b[3] >= a[2]]
            assert got[i] == (min(b[0] for b in near), max(b[1] for b in near), min(b[2] for b in near), max(b[3] for b in near))


def test_extent_asks_less_than_all_pairs(spark, monkeypatch):
    def no_pairs(*_):
        raise AssertionError("pairs are made")

    monkeypatch.setattr(overlap, "_meetings", no_pairs)
    same = overlap.overlap_extent(boxes(spark, [(0, 50, 0, 50)] * 5000 + [(50, 90, 20, 30)]))
    assert {(r.y_max, r.x_max) for r in same.collect()} == {(90, 50)}


def test_a_hot_tile_has_no_strip_narrower_than_its_boxes(spark, monkeypatch):
    monkeypatch.setattr(overlap, "HOT_TILE", 2)
    df = boxes(spark, [(i, i + 9, 0, 99) for i in range(60)])
    assert overlap._dealt(df, "granule_id", "obs_date", 256).count() == 60  # one strip; strips of a width of 8 made 780 rows
    pairs = overlap.overlap_pairs(df, limits=False)
    assert pairs.columns == ["obs_date", "a_id", "b_id"] and pairs.count() == sum(min(9, 59 - i) for i in range(60))


def test_pairs_take_one_exchange_and_leave_tasks_as_lists(spark):
    plan = overlap.overlap_pairs(boxes(spark, [(0, 5, 0, 5), (1, 2, 1, 2)]), "endpoint", limits=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan
    assert "Generate explode(partners" in plan


@pytest.mark.parametrize("rule", ["intersect", "endpoint", "ninecase"])
@pytest.mark.parametrize(("hot", "side", "far"), [(1 << 14, 4, 0), (500, 4, 70_000), (500, 90, 1 << 40)])
def test_pairs_of_full_tiles(spark, monkeypatch, rule, hot, side, far):
    """Tiles in strips of their own, strips within them, limits of any size, text as ids, and ids given twice."""
    monkeypatch.setattr(overlap, "HOT_TILE", hot)
    rng = random.Random(side)
    rows = [(y, y + rng.randint(0, side), x, x + rng.randint(0, 2 * side)) for y, x in ((rng.randint(-30, 270), rng.randint(-60, 300)) for _ in range(1500))]
    rows = [tuple(v + far * (i % 2) for v in r) for i, r in enumerate(rows)]
    names = [f"g{i % 1490}" for i in range(1500)]
    df = spark.createDataFrame([(n, D, *r) for n, r in zip(names, rows)], "granule_id string, obs_date date, y_min long, y_max long, x_min long, x_max long")
    got = overlap.overlap_pairs(df, rule).collect()
    y0, y1, x0, x1 = np.array(rows).T

    def touch(lo, hi):
        a, b = (lo[:, None], hi[:, None]), (lo[None], hi[None])
        inside = (b[0] >= a[0]) & (b[0] <= a[1]) | (b[1] >= a[0]) & (b[1] <= a[1])
        return inside if rule == "endpoint" else (a[0] <= b[1]) & (b[0] <= a[1])

    text = np.array(names, object)
    hit = touch(y0, y1) & touch(x0, x1) & (text[:, None] < text[None] if rule == "intersect" else text[:, None] != text[None])
    want = sorted((names[i], names[j], *rows[i], *rows[j]) for i, j in zip(*np.nonzero(hit)))
    assert len(want) > 100 and sorted(tuple(r)[1:] for r in got) == want


def test_overlaps_of_incomplete_and_no_boxes(spark):
    df = boxes(spark, [(0, 5, 0, 5), (1, 2, 1, 2)])
    bad = df.withColumn("y_max", F.lit(None).cast("int")).unionByName(df.withColumn("obs_date", F.lit(None).cast("date")))
    assert overlap.overlap_pairs(df.unionByName(bad)).count() == 1 and overlap.overlap_pairs(df.limit(0), "endpoint").count() == 0
    same = boxes(spark, [(0, 5, 0, 5)] * 40)
    assert overlap.overlap_pairs(same).count() == 40 * 39 / 2


def test_sets_read_pixels_once_and_shuffle_twice(spark):
    p = pixels(spark, [(1, "S3A", D, 0, 0, 1, 0.1, None), (2, "S3B", D, 0, 0, 1, 0.5, None), (1, "S3A", D, 0, 0, 0, 0.3, 1.0)])
    p = p.withColumn("start_ts", F.timestamp_seconds(F.col("granule_id") * 3600))
    table = overlap.set_table(p, 2, ["a", "b"], ["b"])
    plan = overlap.set_summary(table, ["a"], ["b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Scan ExistingRDD") == 1
    assert [tuple(r)[:4] for r in overlap.set_spectra(table).collect()] == [([1, 2], 1, "S3A", 0.2), ([1, 2], 2, "S3B", 0.5)]
    s = overlap.set_summary(table, ["a"], ["b"]).first()
    assert (s.n_pixels, s.a, s.b_span, s.hours, s.mixed) == (1, 0.35, 0.0, 1.0, True)
    assert overlap.set_table(p.limit(0), 2, ["a"]).count() == 0


def test_tasks_of_sets_grow_with_the_pixels(spark, monkeypatch):
    monkeypatch.setattr(overlap, "TASK_PIXELS", 10)
    p = pixels(spark, [(g, "S3A", D, 0, x, 1, 0.1, None) for x in range(100) for g in (1, 2)])
    members = overlap.cell_members(p, 2)
    assert "REPARTITION_BY_NUM" in members._jdf.queryExecution().executedPlan().toString() and members.rdd.getNumPartitions() == 20
    assert [tuple(r) for r in overlap.granule_sets(p, 2).collect()] == [([1, 2], 100)]


def test_months_follow_any_order_of_arrivals_and_replacements(spark, tmp_path):
    r = random.Random(6)
    days = [date(2001, m, d) for m in (1, 2) for d in range(1, 7)]

    def values(ds):
        return {(d, y, x): r.choice([r.random() * 9, r.random(), None, -1.0]) for d in ds for y in range(3) for x in range(2) if r.random() < 0.7}

    months, stored = MonthlyState(spark, "chl", str(tmp_path / "months")), {}
    with pytest.raises(ValueError):
        months.read()
    r.shuffle(days)
    batches = [days[:5], days[5:], days[2:8], days[:1], days]
    for n, ds in enumerate(batches):
        new = values(ds)
        # A day is replaced as a whole, so cells that it no longer holds go; a day without any row is no part of the batch.
        seen = {d for d, _, _ in new}
        stored = {k: v for k, v in stored.items() if k[0] not in seen} | new
        df = spark.createDataFrame([(*k, v) for k, v in new.items()] + [(None, 0, 0, 1.0)], "obs_date date, y int, x int, chl double")
        for _ in range(2 if n == 2 else 1):  # the third batch is repeated
            months.update(df, f"batch{n}")
        whole = composite.monthly_composite(spark.createDataFrame([(*k, v) for k, v in stored.items()], df.schema), "chl")
        expected = {(m.month, m.y, m.x): (m.value, m.value_count, m.value_error) for m in whole.collect() if m.value_count}
        got = {(m.month, m.y, m.x): (m.value, m.value_count, m.value_error) for m in months.read().collect() if m.value_count}
        assert got.keys() == expected.keys()
        for key, (value, count, error) in expected.items():
            assert got[key][:2] == (pytest.approx(value), count) and got[key][2] == (error if error is None else pytest.approx(error, abs=1e-9))


def test_gap_on_a_limit_is_in_the_upper_class(spark):
    df = spark.createDataFrame([(99, 1.5, True), (100, 3.0, False), (1000, 23.9, True), (5, 24.0, True)], "n_pixels int, hours double, mixed boolean")
    got = [(r.size_class, r.gap_class) for r in overlap.classify_sets(df).collect()]
    assert got == [("under_100", "1.5_to_3h"), ("under_1000", "3_to_12h"), ("from_1000", "12_to_24h"), ("under_100", None)]


def test_index_granules(spark):
    names = [f"S3{p}_OL_2_WFR____20240101T{h:02d}0000_x" for h in (0, 0, 1, 5, 5, 7) for p in "AB"]
    df = spark.createDataFrame([(D, f"{n}_{i:02d}", n[:3], i % 3) for i, n in enumerate(names)],
                               "obs_date date, name string, platform string, rel_orbit int")
    got = sorted(catalogue.index_granules(df).collect(), key=lambda r: r.name)
    assert [r.granule_index for r in got] == list(range(1, 13))
    seen, bits = {}, []
    for r in got:
        bits.append(seen.setdefault((r.platform, r.rel_orbit), 1 << len(seen)))
    assert [r.orbit_bit for r in got] == bits and {r.orbit_block for r in got} == {0}


def test_any_number_of_passes_has_its_bits(spark):
    rows = [(D, f"S3A_OL_2_WFR____20240101T{i // 60:02d}{i % 60:02d}00_x", "S3A", i, 0, 0) for i in range(200)]
    df = catalogue.index_granules(spark.createDataFrame(rows, "obs_date date, name string, platform string, rel_orbit int, y int, x int"))
    got = {(r.orbit_block, r.orbit_bit) for r in df.collect()}
    assert len(got) == 200 and all(b > 0 for _, b in got)
    cells = {r.orbit_block: (r.orbit_sum, r.orbit_set) for r in composite.orbit_bits(df).collect()}
    full = (1 << 62) - 1
    assert cells == {0: (full, full), 1: (full, full), 2: (full, full), 3: ((1 << 14) - 1,) * 2}


def test_orbit_bits_of_many_granules_of_a_pass(spark):
    rows = [(0, 0, 0, g, 1 << 61) for g in range(5)] + [(0, 1, 0, 7, 1 << 61), (0, 1, 0, 8, 1), (0, 2, 0, 9, None)]
    df = spark.createDataFrame(rows, "y int, x int, orbit_block int, granule_id long, orbit_bit long")
    got = {r.x: (r.orbit_sum, r.orbit_set, r.orbit_total) for r in composite.orbit_bits(df).collect()}
    assert got == {0: (None, 1 << 61, 5 << 61), 1: ((1 << 61) + 1,) * 2 + ((1 << 61) + 1,), 2: (None, None, None)}


def test_last_granule_has_no_limit_of_its_own(spark):
    df = spark.createDataFrame([(0, 0, i, 1.0 if i != 12 else None) for i in range(1, 13)], "y int, x int, granule_index int, oza double")
    assert composite.last_granule(df).first().sensor_id == 11 and composite.last_granule(df, limit=10).first().sensor_id == 10


def test_any_timeliness_is_kept_but_comes_last(spark):
    df = spark.createDataFrame([(1, "ST", 1.0), (2, "ST", 2.0), (2, "NR", 3.0), (3, None, 4.0)], "k int, timeliness string, v double")
    got = {r.k: r.v for r in catalogue.best_timeliness(df, ["k"]).collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 4.0}


def test_deviations_of_values_that_hardly_differ(spark):
    values = [1000 + 1e-5 * k for k in range(11)]
    df = spark.createDataFrame([(date(2001, 6, 10 + k), 1, 1, v) for k, v in enumerate(values)], "obs_date date, y int, x int, chl double")
    row = climatology.climatology(df, "chl", 3, 3, years=(2001, 2001)).where("mmdd = '0615' AND y = 1 AND x = 1").first()
    w = [(6 - abs(k - 5)) / 6 for k in range(11)]
    mean = sum(a * v for a, v in zip(w, values)) / sum(w)
    exact = (sum(a * (v - mean) ** 2 for a, v in zip(w, values)) / (10 / 11 * sum(w))) ** 0.5
    assert row.w_std == pytest.approx(exact, rel=1e-6) and row.n_std == pytest.approx(np.std(values), rel=1e-6)


def test_equal_values_have_no_deviation_and_years_follow_from_the_data(spark):
    rows = [(date(y, 6, d), 0, x, 0.1) for y in (2001, 2003) for d in range(1, 12) for x in range(3)] + [(date(2001, 1, 3), 0, 0, 7.0), (date(2003, 12, 31), 1, 1, None)]
    df = spark.createDataFrame(rows, "obs_date date, y int, x int, chl double")
    derived, given = (climatology.climatology(df, "chl", 3, 3, years=y) for y in (None, (2001, 2003)))
    order = ["mmdd", "y", "x"]
    assert derived.orderBy(order).collect() == given.orderBy(order).collect()
    same = derived.where("mmdd BETWEEN '0520' AND '0620'")
    assert same.where("n_std <> 0 OR w_std <> 0 OR n_avg <> 0.1 OR w_avg <> 0.1").count() == 0 and same.where("w_std = 0").count() > 0
    daily = spark.createDataFrame([(date(2002, 6, 5), 0, 0, 0.1)], df.schema)
    assert climatology.quality_index(daily, derived, "chl", log=False).first().qi_chl is None
    assert climatology.climatology(df.where("chl > 100"), "chl", 3, 3).collect() == []


def test_climatology_of_rows_beyond_the_grid_and_without_a_cell(spark):
    inside = [(date(2001, 6, d), y, x, d + y + 0.5 * x) for d in (3, 9) for y in range(5) for x in range(5)]
    rim = [(date(2001, 6, 5), -1, 2, 50.0), (date(2001, 6, 5), 5, 5, 60.0)]
    odd = [(date(2001, 6, 5), -2, 0, 1.0), (date(2001, 6, 5), 0, 7, 1.0), (date(2001, 6, 5), None, 0, 1.0), (None, 0, 0, 1.0), (date(2001, 6, 5), 0, 0, float("nan"))]
    df = spark.createDataFrame(inside + rim + odd, "obs_date date, y int, x int, chl double")
    got = {(r.mmdd, r.y, r.x): r for r in climatology.climatology(df, "chl", 5, 5).collect()}
    want = brute_climatology({(d, y, x): v for d, y, x, v in inside + rim}, 5, (2001, 2001))
    assert got.keys() == want.keys()
    assert all((got[k].nofobs, got[k].max) == (len(v), max(s[0] for s in v)) for k, v in want.items())


def test_moving_sums_are_those_of_the_copies(spark):
    rng = random.Random(8)
    days = [date(2019, 12, 25) + timedelta(days=i) for i in range(90)]
    rows = [(d, y, 0, rng.choice([rng.random(), None])) for d in days for y in range(4) if rng.random() < (0.1, 0.4, 0.9, 1.0)[y]]
    rows += rows[::7]
    df = spark.createDataFrame(rows, "obs_date date, y int, x int, chl double")
    w = temporal_weight(F.col("offset"), 5)
    plain = neighbours.day_window(df.where("chl IS NOT NULL")).groupBy("y", "x", "target_date").agg(
        F.count("chl").alias("n"), F.sum("chl").alias("sum"), F.sum("offset").alias("offsets"), F.sum(F.col("chl") * w).alias("w_sum"), F.sum(w).alias("w"))
    expected = {(r.y, r.target_date): (r.n, r.offsets, r.sum, r.w_sum, r.w) for r in plain.collect()}
    sums = neighbours.moving_sums(df, "chl")
    assert sums._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {(r.y, r.target_date): (r.n, r.offsets, r.sum, r.w_sum, r.w) for r in sums.collect()}
    assert got.keys() == expected.keys() and sums.count() == len(got)
    for key, values in expected.items():
        assert got[key] == pytest.approx(values)


def test_smoothing_by_axes_is_that_of_the_ring(spark):
    rng = random.Random(9)
    rows = [(D + timedelta(days=d), y, x, rng.choice([rng.random(), None])) for d in range(2) for y in range(30) for x in range(21) if rng.random() < 0.4]
    df = spark.createDataFrame(rows, "obs_date date, y int, x int, chl double")
    w = F.when(F.col("chl").isNotNull(), spatial_weight(F.col("dy"), F.col("dx")))
    plain = neighbours.neighbours_3x3(df, 30, 21).groupBy("obs_date", "y", "x").agg(
        F.avg("chl").alias("a"), (F.sum(F.col("chl") * w) / F.sum(w)).alias("b"), F.count("chl").alias("n")).where("n > 0")
    expected = {tuple(r)[:3]: tuple(r)[3:] for r in plain.collect()}
    smooth = neighbours.smooth_3x3(df, "chl", 30, 21)
    assert smooth._jdf.queryExecution().executedPlan().toString().count("Generate explode([-1,0,1])") == 2
    got = {(r.obs_date, r.y, r.x): (r.avg, r.weighted_avg, r.n) for r in smooth.collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got)


def test_copies_are_made_behind_the_exchange(spark):
    df = spark.createDataFrame([], "obs_date date, y int, x int, chl double")
    for out in (neighbours.smooth_3x3(df, "chl", 400, 400), climatology.climatology(df, "chl", 400, 400, years=(2000, 2001)),
                neighbours.day_window(df).groupBy("target_date", "y", "x").count()):
        text = out._jdf.queryExecution().executedPlan().toString()
        below = text.split("Exchange hashpartitioning", 1)[1]
        assert text.count("Exchange hashpartitioning") == 1 and below.count("Generate") <= 1 and "[struct(dy" not in below


def test_tiles_give_every_neighbour_once(spark):
    rng = random.Random(4)
    rows = [(D, y, x, rng.random()) for y in range(23) for x in range(17) if rng.random() < 0.7]
    df = spark.createDataFrame(rows, "obs_date date, y int, x int, chl double")
    a = {(r.y, r.x, r.dy, r.dx): r.chl for r in neighbours.neighbours_3x3(df, 23, 17).collect()}
    b = [((r.y, r.x, r.dy, r.dx), r.chl) for r in neighbours.neighbours_in_tiles(df, 23, 17, ["obs_date"]).collect()]
    assert len(b) == len(a) and dict(b) == a


def test_domain_leaves_cells_outside_without_a_mask(spark):
    p = pixels(spark, [(1, "S3A", D, 0, 0, 1, 0.1, 0.1), (1, "S3A", D, 0, 5, 1, 0.1, 0.1)])
    inside = F.col("x") < 3
    for df in (composite.daily_mask(p, domain=inside), composite.daily_composite(p, {"a": (0, 1)}, with_mask=True, domain=inside),
               composite.daily_composite_joint(p, {"a": (0, 1)}, ["a"], domain=inside)):
        got = {r.x: (r.sensormask, r.n_granules) for r in df.collect()}
        assert got == {0: (1, 1), 5: (None, None)}


def test_counters_without_water(spark):
    df = spark.createDataFrame([(1, 4, 1), (1, 4, 1), (2, 2, 0), (2, 2, 1)], "granule_id int, flags bigint, mask_default int")
    got = {r.granule_id: r for r in quality.granule_counters(df, {"WATER": 2, "LAND": 4}, ["LAND"]).collect()}
    assert (got[1].p_valid, got[1].n_water2, got[1].n_flagged) == (0.0, 0, 2) and got[2].p_valid == 50.0


def test_interpolate_table_ends_and_knots(spark):
    table = spark.createDataFrame([(400.0, 1.0), (410.0, 3.0), (430.0, 5.0)], "wl double, v double")
    points = spark.createDataFrame([(v,) for v in (390.0, 400.0, 405.0, 410.0, 420.0, 430.0, 500.0)] + [(None,)], "w double")
    got = {r.w: r.c for r in coefficients.interpolate_table(points, table, "w", "wl", "v", "c").collect()}
    assert got == {390.0: 1.0, 400.0: 1.0, 405.0: 2.0, 410.0: 3.0, 420.0: 4.0, 430.0: 5.0, 500.0: 5.0, None: None}


@pytest.mark.parametrize("n", [1, 3, 40])
def test_as_of_and_next_against_bisection(spark, n):
    r = random.Random(n)
    knots = [(r.choice([float(r.randrange(50)), r.random() * 50]), r.randrange(5)) for _ in range(120)] + [(None, 1), (float("nan"), 2)]
    points = [(i, r.choice([float(r.randrange(-5, 56)), 17.0, r.random() * 60 - 5])) for i in range(600)] + [(900, None), (901, float("nan"))]
    table, asked = spark.createDataFrame(knots, "x double, p int"), spark.createDataFrame(points, "i int, v double").repartition(5)
    cut = ranges.Ranges.of(asked, "v", n)
    known = sorted(k for k in knots if k[0] is not None and k[0] == k[0])
    expected = {}
    for i, v in points:
        place = bisect.bisect_right([k[0] for k in known], v) if v is not None and v == v else 0
        expected[i] = known[place - 1][1] if place else None
    assert {r.i: r.p for r in ranges.as_of(asked, table, "v", "x", ["p"], cut).collect()} == expected
    following = sorted((tuple(r) for r in ranges.with_next(table, "x", ("x", "p"), cut).collect()), key=lambda r: r[:2])
    assert [r[:2] for r in following] == known and [r[2:] for r in following] == [*known[1:], (None, None)]


def test_as_of_spreads_a_hot_value_and_shuffles_points_once(spark):
    points = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id") / 300.0).alias("v"))
    cut = ranges.Ranges.of(points, "v", 12)
    assert max(cut.salts) >= 6 and cut.number_of(5.0) == points.where("v = 5").select(cut.number(F.col("v")).alias("r")).first().r
    table = spark.createDataFrame([(float(x), x) for x in range(10)], "x double, p int")
    found = ranges.as_of(points, table, "v", "x", ["p"], cut)
    # Points take part in the exchange by range and salt alone; the others deal the table.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum("_salt" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 1 and "CartesianProduct" not in plan
    assert found.count() == 3000 and found.where("p <> floor(v)").count() == 0


def test_band_table_by_brute_force(spark):
    r = random.Random(4)
    bands = [(i, r.randrange(4000, 4400) / 10) for i in r.sample(range(1000), 150)] + [(2000, None), (5, 400.5), (5, 400.5)]
    points = [(i, r.randrange(3980, 4420) / 10) for i in range(400)] + [(500, None)]
    asked = spark.createDataFrame(points, "i int, w double").withColumn("_row", F.lit(1))
    for tol in (0.1, 1.0, 7.5):
        got = {x.i: x.b for x in coefficients.nearest_in_table(asked, spark.createDataFrame(bands, "position int, band double"), "w", "position", "band", "b", tol).collect()}
        for i, w in points:
            near = sorted((p, b) for p, b in bands if w is not None and b is not None and abs(round(b * 10) - round(w * 10)) < round(tol * 10))
            assert got[i] == (near[0][1] if near else None)
    none = spark.createDataFrame([], "position int, band double")
    assert {x.b for x in coefficients.nearest_in_table(asked, none, "w", "position", "band", "b").collect()} == {None}


def test_interpolation_needs_no_limit_on_knots(spark):
    table = spark.range(5000).select((F.col("id") * 0.1).alias("wl"), (F.col("id") % 7).cast("double").alias("v"))
    points = spark.range(3000).select((F.col("id") * 0.2 - 20.03).alias("w"))
    xs, ys = np.arange(5000) * 0.1, (np.arange(5000) % 7).astype(float)
    for r in coefficients.interpolate_table(points, table, "w", "wl", "v", "c").collect():
        assert r.c == pytest.approx(np.interp(r.w, xs, ys), abs=1e-9)
    empty = spark.createDataFrame([], "wl double, v double")
    assert {r.c for r in coefficients.interpolate_table(points, empty, "w", "wl", "v", "c").collect()} == {None}


def test_tie_points_reproduce_a_plane(spark):
    # a field linear in tie coordinates must come back exactly, also past the last tie row and column
    tie = spark.createDataFrame([(1, j, i, 3.0 * j + 2.0 * i) for j in range(4) for i in range(5)], "granule_id int, j int, i int, oza double")
    pix = spark.createDataFrame([(1, r, c) for r in range(16) for c in range(40)], "granule_id int, row int, col int")
    for r in resample.interpolate_tie(pix, tie, 4, 8, ["oza"], (4, 5)).collect():
        assert r.oza == pytest.approx(3 * (r.row + 0.5) / 4 + 2 * (r.col + 0.5) / 8)


def test_composites_combine_before_the_shuffle(spark):
    text = composite.daily_composite(pixels(spark, []), LIMITS, with_mask=True)._jdf.queryExecution().executedPlan().toString()
    below = text.split("Exchange hashpartitioning")[1]
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in below and "SortAggregate" not in text


def test_a_swath_beyond_its_bits_is_an_error(spark):
    df = spark.createDataFrame([(1, 1 << 16, 0, 89.0, 0.0, 1.0)], "granule_id int, row int, col int, lat double, lon double, v double")
    with pytest.raises(Exception, match="exceeds its bits"):
        resample.resample_nearest(df, TOY, 120_000.0, ["v"]).collect()
    assert resample.resample_nearest(df, TOY, 120_000.0, ["v"], bits=(20, 12)).count() > 0


def test_groups_of_one(spark):
    df = boxes(spark, [(0, 9, 0, 9)] * 3).withColumn("granule_index", F.col("granule_id"))
    assert sorted(r.group_id for r in grouping.group_granules(df, cap=1).collect()) == [1, 2, 3]
