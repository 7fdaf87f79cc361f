"""Sources, sinks, catalogues and models."""

import json
import os
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from chromasea.operators import gpr
from chromasea.plans.plankton import ensure_443, plankton_chain
from chromasea.schema import fill_to_null, null_to_fill, require_columns
from chromasea.session import collect_bounded
from chromasea.sources import catalogue, layout, manifest, models, pixels, reports


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_manifest_files(spark, tmp_path):
    for i in (1, 2):
        folder = tmp_path / f"g{i}.SEN3"
        folder.mkdir()
        (folder / "xfdumanifest.xml").write_text(
            f"<a>\n  <gml:posList>70.0 {i}.0 71.0 {i}.5 72.5 -{i}.25</gml:posList>\n"
            f"<sentinel-safe:cycleNumber>{i}7</sentinel-safe:cycleNumber>\n"
            '<sentinel-safe:orbitNumber type="start">99</sentinel-safe:orbitNumber>\n</a>\n')
    got = {r.granule_id.split("/")[-2]: r for r in manifest.read_manifests(spark, str(tmp_path)).collect()}
    assert set(got) == {"g1.SEN3", "g2.SEN3"}
    assert [(p.lon, p.lat) for p in got["g2.SEN3"].polygon] == [(2.0, 70.0), (2.5, 71.0), (-2.25, 72.5)]
    assert got["g1.SEN3"].params == {"cycleNumber": "17", "orbitNumber": "99"}
    names = {r.name for r in catalogue.list_granules(spark, str(tmp_path)).collect()}
    assert names == {"xfdumanifest.xml"}


@pytest.mark.parametrize("org, folder", [("YYYYmmdd", "20240229"), ("YYYY/mm/dd", "2024/02/29"), ("YYYY/jjj", "2024/060"),
                                         ("YYYY", "2024"), ("YYYY/mm", "2024/02")])
def test_layouts(spark, tmp_path, org, folder):
    df = spark.sql("select explode(sequence(date'2024-01-15', date'2024-03-15')) as obs_date").withColumn("v", F.lit(1.0))
    path = str(tmp_path / "t")
    layout.write_dated(df, path, org)
    assert df.where("obs_date = '2024-02-29'").select(layout.folder_of(F.col("obs_date"), org)).first()[0] == folder
    back = layout.read_dated(spark, path, org, "2024-02-10", "2024-03-01")
    assert back.columns == ["obs_date", "v"] and back.count() == 21
    assert "PartitionFilters: [isnotnull(p_" in plan(back)
    # overwriting one day leaves the other folders alone
    if org == "YYYYmmdd":
        layout.write_dated(df.where("obs_date = '2024-02-29'").withColumn("v", F.lit(2.0)), path, org, overwrite=True)
        sums = layout.read_dated(spark, path, org, "2024-01-01", "2024-12-31").agg(F.count("v"), F.sum("v")).first()
        assert tuple(sums) == (61, 62.0)
        assert layout.existing_dates(spark, path).count() == 61


def test_box_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(400).selectExpr("cast(id div 20 as int) y", "cast(id % 20 as int) x", "id * 1d a", "id * 2d b").coalesce(1) \
        .createOrReplaceTempView("tmp_pixels")
    pixels.write_pixels(spark.table("tmp_pixels"), path)
    df = pixels.read_pixels(spark, path, ["y", "x", "a"], (2, 5, 3, 7))
    text = plan(df)
    assert df.count() == 12 and "GreaterThanOrEqual(y,2)" in text and "GreaterThanOrEqual(x,3)" in text and "b:double" not in text


def rows_scanned(df):
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_curve_interleaves_bits(spark):
    r = random.Random(1)
    cells = [(r.getrandbits(k), r.getrandbits(k)) for k in (1, 3, 8, 16, 31) for _ in range(20)]
    df = spark.createDataFrame(cells, "y int, x int").withColumn("k", pixels.curve_key(F.col("y"), F.col("x")))
    for row in df.collect():
        assert row.k == sum((row.y >> i & 1) << (2 * i + 1) | (row.x >> i & 1) << (2 * i) for i in range(31))


def test_rows_scanned_shrink_with_the_box(spark, tmp_path):
    side = 256
    grid = spark.range(side * side).selectExpr(f"cast(id div {side} as int) y", f"cast(id % {side} as int) x", "id a", "hash(id) b").repartition(8, "b")
    pixels.write_pixels(grid, str(tmp_path / "p"), files=16, row_group_bytes=20_000)
    scanned = []
    for size in (256, 128, 32):
        df = pixels.read_pixels(spark, str(tmp_path / "p"), ["y", "x", "a"], (64, 64 + size, 32, 32 + size))
        scanned.append(rows_scanned(df))
        assert {(r.y, r.x) for r in df.collect()} == {(y, x) for y in range(64, min(64 + size, side)) for x in range(32, min(32 + size, side))}
    assert scanned[0] > scanned[1] > scanned[2] and scanned[1] < 2 * 128 * 128 and scanned[2] < side * side / 10


def test_a_hot_cell_is_spread_over_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("5 as y", "7 as x", "id a")
    pixels.write_pixels(df, str(tmp_path / "p"), files=4)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "p")).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_reports(spark, tmp_path):
    path = str(tmp_path / "r")
    reports.write_report(spark.createDataFrame([(["a", "b"], 3)], "granules array<string>, n int"), path)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert "granules;n\na,b;3\n" in [(tmp_path / "r" / f).read_text() for f in files]
    assert reports.read_report(spark, path, "granules string, n int").first().n == 3
    wide = spark.range(1).selectExpr(
        "'g' name", "'20240101T000000' start_date", "7 rel_orbit", "1 granule_index", "1L orbit_bit", "10 width", "20 height",
        "200 n_total", "5 n_flagged", "150 n_water1", "160 n_water2", "100 n_valid", "62.5 p_valid", "1 y_min", "5 y_max",
        "2 x_min", "9 x_max", "28 resampled_n_total", "14 resampled_n_valid", "50.0 resampled_p_valid")
    row = reports.resample_report_rows(wide).first()
    assert len(row) == 22 and (row.Width, row.Height, row.NValid) == (7, 4, 14)


def test_completeness(spark):
    df = spark.createDataFrame([(1.0, -999.0)], "rrs443 double, b double")
    assert require_columns(df, ["rrs442_5"], {"rrs442_5": "rrs443"}).columns == ["rrs442_5", "b"]
    with pytest.raises(ValueError, match="missing variables: c"):
        require_columns(df, ["b", "c"])
    row = df.select(fill_to_null(F.col("b")).alias("x"), null_to_fill(fill_to_null(F.col("b"))).alias("y")).first()
    assert row.x is None and row.y == -999.0


def test_bounded_helpers(spark):
    assert len(collect_bounded(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        collect_bounded(spark.range(6), 5)


def test_granule_names(spark):
    rows = [("S3A_OL_2_WFR____20190624T101010_20190624T101310_20190625T101010_0180_087_165______MAR_O_NT_003.SEN3",),
            ("S3B_OL_2_WFR____bad_x_x_x_x_x",), ("short",)]
    got = catalogue.parse_granule_name(spark.createDataFrame(rows, "name string")).collect()
    assert (got[0].platform, str(got[0].start_ts), got[0].rel_orbit) == ("S3A", "2019-06-24 10:10:10", 165)
    assert got[1].start_ts is None and got[1].rel_orbit == -1 and got[2].rel_orbit == -1


def test_missing_and_pending(spark):
    df = spark.createDataFrame([(date(2024, 2, 28),), (date(2024, 3, 1),)], "obs_date date")
    assert [str(r[0]) for r in catalogue.missing_dates(df, "obs_date", "2024-02-28", "2024-03-02").orderBy("obs_date").collect()] == [
        "2024-02-29", "2024-03-02"]
    assert catalogue.pending_dates(df, df.limit(1)).count() == 1
    assert catalogue.pending_dates(df, df.limit(1), overwrite=True).count() == 2


VECTORS = ((170.0, -2.5, -2.4, -2.5, -2.7), (200.0, -2.2, -2.3, -2.4, -2.5), (100.0, -3.0, -2.9, -2.8, -2.6))
ALPHA, BETA = (0.2, -0.1, 0.05), (0.1, 0.001, -0.2, 0.1, 0.05, 0.3)


def scalar_log_chl(f, scales, sf, a):
    """The regression written for one vector."""
    total = BETA[0] + sum(b * v for b, v in zip(BETA[1:], f))
    for w, u in zip(ALPHA, VECTORS):
        dist = sum(((p - q) / s) ** 2 for p, q, s in zip(f, u, scales))
        total += w * sf**2 * (1 + dist / (2 * a)) ** -a
    return total


@pytest.mark.parametrize("kernel", [{"Name": "RationalQuadratic", "SigmaL": 0.9},
                                    {"Name": "ARDRationalQuadratic", **{f"LengthScale{i}": 0.4 * i for i in range(1, 6)}}])
def test_model_file_and_three_predictors(spark, tmp_path, kernel):
    path = tmp_path / "model.json"
    path.write_text(json.dumps({"Kernel": {"AlphaRQ": 0.7, "SigmaF": 1.3, **kernel}, "ActiveSetVectors": VECTORS,
                                "Alpha": ALPHA, "Sigma": 0.1, "Beta": BETA}, indent=1))
    model = models.read_model(spark, str(path))
    scales = [kernel.get("SigmaL") or kernel[f"LengthScale{i}"] for i in range(1, 6)]
    assert model.length_scales == tuple(scales)
    rows = [(d, *b) for d, b in zip(range(150, 210, 6), np.random.default_rng(2).uniform(0.001, 0.02, (10, 4)).tolist())]
    rows += [(160, 0.01, None, 0.01, 0.01), (160, 0.01, 1e-8, 0.01, 0.01), (160, 0.01, 0.4, 0.01, 0.01)]
    df = spark.createDataFrame(rows, "doy int, rrs443 double, rrs490 double, rrs510 double, rrs560 double")
    chl = gpr.gpr_chl(df, model, "doy").collect()
    jvm = gpr.gpr_predict_sql(df.withColumn("f", gpr.features("doy")), model, "f").collect()
    for row, r, s in zip(rows[:10], chl, jvm):
        want = scalar_log_chl((row[0], *np.log10(row[1:])), scales, 1.3, 0.7)
        assert s.log_chl == pytest.approx(want) and np.log10(r.chl) == pytest.approx(want)
    assert [r.chl for r in chl[10:]] == [None] * 3 and [r.log_chl for r in jvm[10:]] == [None] * 3


def test_chain_shifts_the_band_when_443_is_absent(spark):
    model = models.KernelModel(VECTORS, ALPHA, BETA, 1.0, 0.7, (20.0, 1.0, 1.0, 1.0, 1.0))
    df = spark.createDataFrame([(date(2024, 6, 20), 0, 0, 0.0045, 0.005, 0.006, 0.0045, 0.003, 0.0004)],
                               "obs_date date, y int, x int, rrs412_5 double, rrs442_5 double, rrs490 double, rrs510 double, rrs560 double, rrs665 double")
    assert ensure_443(df).first().rrs443 == pytest.approx(0.0050052831, rel=1e-7)
    clim = spark.createDataFrame([("0620", 0, 0, 0.0, 0.5)], "mmdd string, y int, x int, median double, n_std double")
    row = plankton_chain(df, model, "doy", clim).first()
    want = 10 ** scalar_log_chl((172, *np.log10([0.0050052831, 0.006, 0.0045, 0.003])), (20.0, 1, 1, 1, 1), 1.0, 0.7)
    assert row.chl == pytest.approx(want, rel=1e-6) and row.qi_chl == pytest.approx(np.log10(want) / 0.5, rel=1e-6)
    assert row.micro + row.crypto + row.green + row.prokar + row.hapt == pytest.approx(row.chl)


def test_model_sizes_must_agree():
    with pytest.raises(ValueError):
        models.KernelModel(VECTORS, ALPHA[:2], BETA, 1.0, 0.7, (1.0,) * 5)


def test_coefficient_file(spark, tmp_path):
    (tmp_path / "c.txt").write_text("400.0\t0.1\t0.2\n402.5 0.3\n\n")
    assert [tuple(r) for r in pixels.read_coefficients(spark, str(tmp_path / "c.txt")).collect()] == [(400.0, 0.1, 0.2), (402.5, 0.3, None)]


def test_scratch_needs_shared_storage_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from chromasea.session import scratch_path

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder),
                               sparkContext=SimpleNamespace(master=master))

    assert scratch_path(session("spark://x", "/shared"), "a").startswith("/shared/a-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://x"), "a")
    assert "chromasea-" in scratch_path(session("local[2]"), "a")


def test_hundreds_of_rules_in_a_plan_of_constant_size(spark):
    r = random.Random(3)
    choices = {"product": ["rrs", "chl", None], "timeliness": ["NR", "NT", None], "sensor": ["S3A", "S3B", None]}
    rules = [{**{c: v for c, vs in choices.items() if (v := r.choice(vs)) is not None}, "set": {f"k{r.randrange(6)}": i, f"m{i % 3}": "x"}} for i in range(300)]
    scenes = [(i, *(r.choice(vs) for vs in choices.values()), {"k0": "base", "z": "own"} if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(scenes, "i int, product string, timeliness string, sensor string, attributes map<string,string>")
    few, many = (catalogue.overlay_attributes(df, catalogue.rules_table(spark, rules[:n])) for n in (3, 300))
    size = [len(x._jdf.queryExecution().optimizedPlan().toString().splitlines()) for x in (few, many)]
    assert size[0] == size[1] and many.columns == df.columns
    for row in many.collect():
        expected = dict(row_before) if (row_before := scenes[row.i][4]) is not None else None
        for rule in rules:
            if expected is not None and all(rule.get(c) in (None, row[c]) for c in choices):
                expected.update({k: str(v) for k, v in rule["set"].items()})
        assert row.attributes == expected
    assert catalogue.overlay_attributes(df, []).where("attributes['z'] = 'own'").count() == 48


def test_granules_without_name_platform_or_orbit_keep_an_index(spark):
    rows = [("2024-01-01", "S3A_x_1", "S3A", 5), ("2024-01-01", None, "S3A", 5), ("2024-01-01", "S3B_x_2", None, 5), ("2024-01-01", "S3B_x_3", None, None), (None, "S3A_x_4", "S3A", 1)]
    df = spark.createDataFrame(rows, "obs_date string, name string, platform string, rel_orbit int")
    got = {(r.name, r.granule_index, r.orbit_bit) for r in catalogue.index_granules(df).collect()}
    assert got == {(None, 1, 1), ("S3A_x_1", 2, 1), ("S3B_x_2", 3, 2), ("S3B_x_3", 4, 4), ("S3A_x_4", 1, 1)}


def test_model_elements_of_either_kind_of_scale(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"Kernel": {"SigmaL": 2.5}, "ActiveSetVectors": [[1, 2], [3, 4]], "Alpha": [0.1, 0.2], "Sigma": 1.0, "Beta": [9, 8, 7]}))
    table = spark.read.schema(models.SCHEMA).json(str(tmp_path / "m.json"), multiLine=True)
    got = [tuple(r) for r in models.model_elements(table).orderBy("vector", "element").collect()]
    assert got == [(1, 1, 1.0, 0.1, 2.5, 8.0), (1, 2, 2.0, 0.1, 2.5, 7.0), (2, 1, 3.0, 0.2, 2.5, 8.0), (2, 2, 4.0, 0.2, 2.5, 7.0)]
