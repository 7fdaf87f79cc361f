"""Column builders against hand-computed values and closed forms."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chromasea.functions import bandratio, dates, flags, iop, numeric, plankton, polygon, projection, reflectance, weights


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


@pytest.mark.parametrize("bands, first, second, q490, kd", [
    ((0.005, 0.006, 0.0045, 0.003), 0.5063522813, 0.5018428834, 0.99555000, 0.0682343326),
    ((0.0015, 0.002, 0.0022, 0.0024), 3.7901802272, 3.6711329174, 0.9836878232, 0.2141645503),
])
def test_band_ratio(spark, bands, first, second, q490, kd):
    df = spark.createDataFrame([bands], "rrs443 double, rrs490 double, rrs510 double, rrs560 double")
    row = bandratio.kd490_two_pass(df).first()
    assert [row.chl_first, row.chl_second, row.q490, row.kd490] == pytest.approx([first, second, q490, kd], rel=1e-8)
    cols = [F.col(c) for c in df.columns]
    staged = df.withColumn("a", bandratio.chl_oc4(*cols)).withColumn("b", bandratio.chl_oc4(*cols, chl=F.col("a")))
    same = staged.select("a", "b", bandratio.kd490_ok2(cols[1], cols[3], F.col("b")).alias("k")).first()
    assert list(same) == pytest.approx([first, second, kd], rel=1e-8)


def test_band_ratio_missing_bands(spark):
    rows = [(None, 0.006, 0.0045, 0.003), (0.005, 0.006, None, 0.003), (0.005, 0.0, 0.0045, 0.003), (0.005, 0.006, 0.0045, 0.0)]
    df = spark.createDataFrame(rows, "rrs443 double, rrs490 double, rrs510 double, rrs560 double")
    no443, no510, no490, no560 = bandratio.kd490_two_pass(df).collect()
    assert no443.chl_second is not None and no490.chl_second is not None and no490.kd490 is None
    # without 510 there is no chlorophyll, and Kd uses an f/Q of one
    assert no510.chl_second is None and no510.q490 == 1.0 and no510.kd490 is not None
    assert no560.chl_first is None and no560.kd490 is None


def test_fq_is_one_outside_table(spark):
    row = one(spark, *[bandratio.fq_ratio(F.lit(v), 443) for v in (0.02, 10.5)], bandratio.fq_ratio(F.lit(None).cast("double"), 443),
              bandratio.fq_ratio(F.lit(1.0), 443))
    assert list(row)[:3] == [1.0, 1.0, 1.0] and row.c3 == pytest.approx(3.74683 / 3.94203)


def test_plankton_values_and_closure(spark):
    df = spark.createDataFrame([(1.0,), (0.3,), (0.010,), (4.580,), (4.5799,)], "chl double")
    a, b, lo, hi, inside = plankton.plankton_classes(df, as_conc=False).collect()
    assert [a.pico, a.nano, a.micro, a.dino, a.diato, a.crypto, a.green, a.prokar, a.hapt] == pytest.approx(
        [0.18, 0.364510143, 0.455489857, 0.052685044, 0.402804813, 0.117859785, 0.151071809, 0.029460549, 0.246117999], abs=1e-8)
    assert [b.pico * 0.3, b.nano * 0.3, b.micro * 0.3, b.green * 0.3, b.hapt * 0.3] == pytest.approx(
        [0.083570459, 0.062859166, 0.153570375, 0.067243553, 0.040013183], abs=1e-8)
    assert lo.pico is None and hi.pico is None and inside.pico is not None
    conc = plankton.plankton_classes(df).where("pico is not null").collect()
    for r in conc:
        assert r.micro + r.crypto + r.green + r.prokar + r.hapt == pytest.approx(r.chl)
        assert r.dino + r.diato == pytest.approx(r.micro)
        assert r.pico + r.nano + r.micro == pytest.approx(r.chl)
    assert plankton.plankton_classes(df, domain=False).where("pico is null").count() == 0


@pytest.mark.parametrize("bands, r443, adg, aph, eta, lam", [
    ((0.0045, 0.005, 0.006, 0.003, 0.0004), 0.0050052831, 0.0503342130, 0.0141701530, 1.4592949, 560.0),
    ((0.0012, 0.0015, 0.0024, 0.0045, 0.0018), 0.0015139913, 0.4801499348, 0.3457213605, None, 665.0),
])
def test_band_shift(spark, bands, r443, adg, aph, eta, lam):
    names = ["rrs412", "rrs443", "rrs490", "rrs560", "rrs665"]
    df = spark.createDataFrame([bands, (None, *bands[1:])], ", ".join(f"{n} double" for n in names))
    row, missing = iop.with_iop(iop.band_shift(df, [443.0], names, names=["out"]), *names).collect()
    assert row.out == pytest.approx(r443, rel=1e-7)
    assert [row.iop.adg443, row.iop.aph443, row.iop.lambda0] == pytest.approx([adg, aph, lam], rel=1e-7)
    assert eta is None or row.iop.eta == pytest.approx(eta, rel=1e-6)
    assert missing.out is None and missing.iop is None


def test_band_shift_to_an_input_band_returns_it(spark):
    names = ["rrs412", "rrs443", "rrs490", "rrs560", "rrs665"]
    df = spark.createDataFrame([(0.0045, 0.005, 0.006, 0.003, 0.0004)], ", ".join(f"{n} double" for n in names))
    row = iop.band_shift(df, [490.0, 560.0], names).first()
    assert [row.rrs490_shifted, row.rrs560_shifted] == pytest.approx([0.006, 0.003])


def test_inputs_are_chosen_by_wavelength(spark):
    df = spark.createDataFrame([(0.0045, 0.005, 0.006, 0.0055, 0.003, 0.0004)], ", ".join(f"r{w} double" for w in (412, 443, 490, 510, 555, 670)))
    bands = {float(w): f"r{w}" for w in (412, 443, 490, 510, 555, 670)}
    row = iop.band_shift(df, [510.0, 520.0], bands, tables={n: {w: c[i] for w, c in iop.COEFFICIENTS.items()} for i, n in enumerate(("aw", "bbw", "aph_a", "aph_b"))}).first()
    assert row.rrs510_shifted == pytest.approx(0.0055) and 0.003 < row.rrs520_shifted < 0.0055
    assert iop.wanted_bands([412.5, 442.5, 490.0, 510.0, 560.0, 665.0]) == (412.5, 442.5, 490.0, 560.0, 665.0)
    for odd, text in (([412.0, 443.0, 490.0, 530.0, 670.0], "green"), ([412.0, 443.0, 490.0, 555.0, 681.0], "red")):
        with pytest.raises(ValueError, match=text):
            iop.wanted_bands(odd)
    with pytest.raises(KeyError):
        iop.band_shift(df, [520.0], bands)


def test_coefficient_table():
    table = {400.0: 1.0, 410.0: 3.0, 430.0: 5.0}
    assert [iop.coefficient("aw", w, table) for w in (390, 400, 405, 420, 430, 500)] == [1, 1, 2, 4, 5, 5]
    assert iop.coefficient("bbw", 490.0) == 0.001495
    with pytest.raises(KeyError):
        iop.coefficient("aw", 491.0)


def test_projection_round_trip_and_self_check(spark):
    df = spark.range(500).selectExpr("66 + (id * 7919 % 23000) / 1000.0D as lat", "-179.9D + (id * 104729 % 359000) / 1000.0D as lon")
    for name in projection.AREAS:
        a = projection.area(name)
        row, col = projection.lonlat_to_rowcol(F.col("lon"), F.col("lat"), a)
        back = df.withColumns({"row": row, "col": col})
        lon, lat = projection.rowcol_to_lonlat(F.col("row"), F.col("col"), a)
        worst = back.select(F.max(F.abs(lat - F.col("lat"))), F.max(F.abs(lon - F.col("lon")))).first()
        assert max(worst) < 1e-8
    a = projection.area("polar_stereographic")
    lon, lat = projection.rowcol_to_lonlat(F.lit(0), F.lit(a.width // 2), a)
    assert one(spark, lat).c0 == pytest.approx(64.98783, abs=1e-4) and abs(a.pixel_x) == pytest.approx(300.003, abs=1e-3)


def test_cell_vector_agrees_with_inverse_projection(spark):
    a = projection.Area("polarn", 41, 41, (-2751778, 2751778, 2751778, -2751778))  # odd: a cell on the pole
    cells = spark.range(41 * 41).selectExpr("cast(id div 41 as int) y", "cast(id % 41 as int) x")
    lon, lat = projection.rowcol_to_lonlat(F.col("y"), F.col("x"), a)
    u = projection.unit_vector(lon, lat)
    v = projection.with_cell_vector(cells, "y", "x", a)
    worst = v.select(*[F.max(F.abs(p - F.col(f"_k{n}"))) for p, n in zip(u, "xyz")]).first()
    assert max(worst) < 1e-12


def test_flags_with_the_sign_bit(spark):
    cat = {"A": 1, "B": 1 << 62, "TOP": 1 << 63}
    code = flags.flag_code(cat, ["A", "TOP"])
    assert code == -(2**63) + 1
    df = spark.createDataFrame([(-(2**63),), (1 << 62,), (0,)], "flags bigint")
    got = df.select((flags.flag_mask(F.col("flags"), code) != 0).alias("m"), flags.flag_decode(F.col("flags"), cat).alias("n"),
                    flags.flag_vector(F.col("flags"), cat).alias("v")).collect()
    assert [r.m for r in got] == [True, False, False]
    assert [r.n for r in got] == [["TOP"], ["B"], []] and got[0].v == [0, 0, 1]
    with pytest.raises(KeyError):
        flags.flag_code(cat, ["NONE"])


def test_unsigned_flags(spark):
    df = spark.sql("select cast(v as decimal(20,0)) as v from values ('18446744073709551615'), ('9223372036854775808'), ('5') as t(v)")
    assert [r[0] for r in df.select(flags.unsigned_to_signed(F.col("v"))).collect()] == [-1, -(2**63), 5]


def test_flag_lists():
    assert len(flags.MASK_FLAGS[3]) == 21 and len(flags.MASK_FLAGS[4]) == 22
    assert "HIGHGLINT" not in flags.MASK_FLAGS[4] and "ADJAC" in flags.MASK_FLAGS[4]


def test_dates(spark):
    row = one(spark, dates.doy_parse(F.lit("2019175")), dates.doy_format(F.lit("2019-06-24").cast("date")),
              dates.doy_parse(F.lit("20x")), dates.to_epoch1981(F.lit("1981-01-02").cast("date")),
              dates.month_name(F.lit("2020-02-10").cast("date"), "O", "kd490"))
    assert str(row.c0) == "2019-06-24" and row.c1 == "2019175" and row.c2 is None
    assert row.c3 == 86400 and row.c4 == "O2020032060-kd490_monthly"


def test_relative_dates(spark):
    ref = F.lit("2024-03-10").cast("date")
    row = one(spark, dates.resolve_date(F.lit("-3"), ref), dates.resolve_date(F.lit("2023-12-31"), ref),
              dates.resolve_date(F.lit("soon"), ref), F.size(dates.resolve_range(F.lit("-3"), F.lit("none"), ref)),
              F.size(dates.resolve_range(F.lit("0"), F.lit("-1"), ref)),
              dates.month_to_process(F.lit("2024-01-07").cast("date"), "NR"), dates.month_to_process(F.lit("2024-01-08").cast("date"), "NR"),
              dates.month_to_process(F.lit("2024-01-08").cast("date"), "NT"))
    assert [str(row.c0), str(row.c1), row.c2, row.c3, row.c4] == ["2024-03-07", "2023-12-31", None, 1, 0]
    assert [str(row.c5), row.c6, str(row.c7)] == ["2023-12-01", None, "2023-12-01"]


def test_two_nearest(spark):
    bands = (400.0, 410.0, 430.0)
    row = one(spark, *[reflectance.two_nearest(F.lit(w), bands) for w in (404.0, 405.0, 420.0, 999.0)])
    assert list(row) == [[400.0], [400.0, 410.0], [410.0, 430.0], [430.0]]
    assert reflectance.nearest_band(442.0) == 442.5 and reflectance.nearest_band(441.5) is None


def test_point_and_box_in_polygon(spark):
    ring = "array(struct(0d as lon, 0d as lat), struct(10d as lon, 0d as lat), struct(13d as lon, 5d as lat), struct(3d as lon, 5d as lat))"
    p = F.expr(ring)
    empty = F.lit(None).cast("array<struct<lon:double,lat:double>>")

    def meets(s, n, w, e, poly=p):
        return polygon.polygon_meets_box(poly, *[F.lit(float(v)) for v in (s, n, w, e)])

    row = one(spark, polygon.point_in_polygon(F.lit(5.0), F.lit(2.0), p), polygon.point_in_polygon(F.lit(0.5), F.lit(4.0), p),
              polygon.point_in_polygon(F.lit(5.0), F.lit(2.0), empty),
              meets(1, 2, 4, 5), meets(-9, 9, -9, 99), meets(2, 3, -50, 50), meets(6, 9, 0, 10), meets(3.9, 4.9, 0, 1), meets(0, 1, 0, 1, empty))
    assert list(row) == [1, 0, -1, 1, 1, 1, 0, 0, -1]


def test_weights(spark):
    row = one(spark, *[weights.temporal_weight(F.lit(d), 5) for d in (0, 5, -5)], weights.spatial_weight(F.lit(-1), F.lit(1)))
    assert list(row) == pytest.approx([1.0, 1 / 6, 1 / 6, 0.25]) and weights.full_weight(5) == pytest.approx(24.0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0.001, 90.0), min_size=1, max_size=20))
def test_byte_roundtrip_stays_within_one_step(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, got in df.select("v", numeric.byte_roundtrip(F.col("v"), 0.02, -3.0)).collect():
        assert math.log10(got) - math.log10(v) == pytest.approx(0.01, abs=0.0100001)


def test_interpolation(spark):
    xs, ys = (0.0, 1.0, 3.0), (0.0, 10.0, 0.0)
    row = one(spark, *[numeric.interp_linear(F.lit(v), xs, ys) for v in (-0.1, 0.0, 0.5, 1.0, 2.0, 3.0, 3.1)])
    assert [row[0], *row[1:6], row[6]] == [None, 0.0, 5.0, 10.0, 5.0, 0.0, None]
    assert one(spark, numeric.poly(F.lit(2.0), (1.0, 2.0, 3.0))).c0 == 17.0


def test_flags_of_other_widths(spark):
    df = spark.sql("select cast(f as smallint) as f from values (1025), (6), (-32768) as t(f)")
    got = df.select(flags.general_mask(F.col("f")).alias("g"), (flags.flag_mask(F.col("f"), 6) != 0).alias("m")).collect()
    assert [(r.g, r.m) for r in got] == [(1, False), (6, True), (0, False)]


def test_pi_repair_changes_collection_3_only(spark):
    df = spark.createDataFrame([(0.02, 3), (0.02, 4), (None, 3)], "rho double, c int")
    a, b, c = (r[0] for r in df.select(reflectance.to_rrs(F.col("rho"), F.col("c"))).collect())
    assert a / 0.02 == pytest.approx(1 / math.pi) and b == 0.02 and c is None
