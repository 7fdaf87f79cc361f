"""Queries for the per-pixel algorithms and the chains (A-01 to A-14, plans)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chromasea.functions import bandratio, iop, kernels, plankton
from chromasea.operators import coefficients, gpr
from chromasea.operators.climatology import climatology
from chromasea.plans.archive import archive_quality
from chromasea.plans.daily import add_band_ratio_products, daily_reflectance, mask_pixels, monthly_chlorophyll, olci_month
from chromasea.plans.multi import multi_month, multi_products
from chromasea.plans.plankton import plankton_chain
from chromasea.queries import geography
from chromasea.queries.aggregates import CENTRAL, LIMITS
from chromasea.queries.base import VECTOR, query, table, view
from chromasea.queries.expressions import BANDS5, FLAGS, MASKING
from chromasea.queries.joins import ALPHA_RQ, SCALES, SIGMA_F, SIGMA_L
from chromasea.queries.windows import SIDE, clim_sql
from chromasea.sources.models import model_from_frame

RRS = ("rrs443", "rrs490", "rrs510", "rrs560")


# --- SQL forms of the formulas ---
def sql_poly(x: str, c: tuple) -> str:
    return "(" + " + ".join(f"{v!r} * power({x}, {i})" if i else repr(v) for i, v in enumerate(c)) + ")"


def sql_interp(x: str, band: int) -> str:
    xs, ys = bandratio.FQ_CHL, bandratio.FQ[band]
    parts = " ".join(
        f"when {x} between {xs[i]} and {xs[i + 1]} then {ys[i]} + ({x} - {xs[i]}) * {ys[i + 1] - ys[i]!r} / {xs[i + 1] - xs[i]!r}"
        for i in range(5))
    return f"(case {parts} end)"


def sql_fq(x: str, band: int) -> str:
    return f"coalesce({sql_interp(x, band)} / {sql_interp(x, 560)}, 1)"


def sql_chl(first: str | None) -> str:
    r = [f"case when rrs{b} > 0 and rrs560 > 0 then rrs{b} / rrs560 / {sql_fq(first, b) if first else '1'} end"
         for b in (443, 490, 510)]
    return (f"case when rrs510 > 0 and rrs560 > 0 then power(10e0, "
            f"{sql_poly(f'log10(greatest({r[0]}, {r[1]}, {r[2]}))', bandratio.CHL_POLY)}) end")


_RATIO = f"""
    select *, 0.0166 + power(10e0, {sql_poly('l', bandratio.KD_POLY)}) as kd490 from (
      select *, case when rrs490 > 0 and rrs560 > 0 then log10(rrs490 / rrs560 / q490) end as l from (
        select *, {sql_fq('chl_second', 490)} as q490 from (
          select *, {sql_chl('chl_first')} as chl_second from (
            select *, {sql_chl(None)} as chl_first from _SOURCE_) as a1) as a2) as a3) as a4
"""


@query("a01_chl_oc4", f"""
    select granule_id, y, x, chl_first, chl_second from ({_RATIO.replace('_SOURCE_', 'obs')}) as r
""", 8, ("chl_first", "chl_second"))
def _(spark, sf):
    o = view(spark, sf, "obs").select("granule_id", "y", "x", *RRS)
    return bandratio.kd490_two_pass(o).select("granule_id", "y", "x", "chl_first", "chl_second")


@query("a02_fq_ratio", f"""
    select obs_date, y, x, {sql_fq('c', 443)} as q443, {sql_fq('c', 490)} as q490, {sql_fq('c', 510)} as q510
    from (select *, power(chl, 3) * 0.2 as c from daily) as d
""", 9, ("q443", "q490", "q510"))
def _(spark, sf):
    d = view(spark, sf, "daily").withColumn("c", F.pow(F.col("chl"), 3.0) * 0.2)
    return d.select("obs_date", "y", "x", *[bandratio.fq_ratio(F.col("c"), b).alias(f"q{b}") for b in (443, 490, 510)])


@query("a03_kd490", f"""
    select granule_id, y, x, q490, kd490 from ({_RATIO.replace('_SOURCE_', 'obs')}) as r
""", 8, ("q490", "kd490"))
def _(spark, sf):
    o = view(spark, sf, "obs").select("granule_id", "y", "x", *RRS)
    return bandratio.kd490_two_pass(o).select("granule_id", "y", "x", "q490", "kd490")


_D2 = " + ".join(f"power(cast(e.embedding[{i}] as double) - m.f{i}, 2)" for i in range(1, VECTOR + 1))
_ARD = " + ".join(f"power((cast(e.embedding[{i}] as double) - m.f{i}) / {s}, 2)" for i, s in enumerate(SCALES, 1))


def _pairs(spark, sf):
    """Every vector beside the mean vector of its own label."""
    means = view(spark, sf, "gpr_active").select("label", F.array(*[F.col(f"f{i}") for i in range(1, VECTOR + 1)]).alias("v"))
    u = F.transform("embedding", lambda e: e.cast("double"))
    return table(spark, sf, "embeddings").select("vec_id", "label", u.alias("u")).join(means, "label")


@query("a04_rq_kernel", f"""
    select e.vec_id, {SIGMA_F**2} * power(1 + ({_D2}) / {2 * ALPHA_RQ * SIGMA_L**2!r}, {-ALPHA_RQ}) as k
    from embeddings as e join gpr_active as m on e.label = m.label
""", 9, ("k",))
def _(spark, sf):
    return _pairs(spark, sf).select(
        "vec_id", kernels.rq_kernel(F.col("u"), F.col("v"), SIGMA_F, SIGMA_L, ALPHA_RQ).alias("k"))


@query("a05_ard_rq_kernel", f"""
    select e.vec_id, {SIGMA_F**2} * power(1 + ({_ARD}) / {2 * ALPHA_RQ}, {-ALPHA_RQ}) as k
    from embeddings as e join gpr_active as m on e.label = m.label
""", 9, ("k",))
def _(spark, sf):
    return _pairs(spark, sf).select(
        "vec_id", kernels.ard_rq_kernel(F.col("u"), F.col("v"), SIGMA_F, SCALES, ALPHA_RQ).alias("k"))


# A regression model shaped like a real one: the mean feature vectors of seven
# classes of granules on two platforms (14 vectors at any scale).
_LON = "(x * 18e0 - 175e0)"
_FEATURES = {
    "doy": (("doy", None), ("rrs443", 1e-8), ("rrs490", 1e-8), ("rrs510", 1e-8), ("rrs560", 1e-8)),
    "lon_doy": (("lon", None), ("doy", None), ("rrs443", 0), ("rrs490", 0), ("rrs560", 0), ("rrs665", 0)),
}
_MODEL = {
    "doy": dict(beta=(-0.4, 0.0005, -0.3, 0.1, 0.05, 0.2), sigma_f=0.9, alpha_rq=0.7, length_scales=(40.0,) * 5),
    "lon_doy": dict(beta=(-0.2, 0.0003, 0.0004, -0.3, 0.1, 0.2, 0.05), sigma_f=0.8, alpha_rq=1.2,
                    length_scales=(60.0, 45.0, 0.6, 0.7, 0.8, 0.9)),
}


def _fit(kind: str) -> str:
    """Validity test of the model inputs in SQL."""
    hi = " and {0} < 1 / pi()" if kind == "doy" else ""
    return " and ".join((f"{c} > {lo}" + hi.format(c)) for c, lo in _FEATURES[kind] if lo is not None)


def _value(c: str, lo: float | None) -> str:
    return c if lo is None else f"log10(case when {c} > 0 then {c} end)"


_PIX = f"(select *, dayofyear(obs_date) as doy, {_LON} as lon, granule_id % 7 as grp from obs)"


def _gpr_sql(kind: str, source: str = _PIX, keys: str = "granule_id, obs_date, y, x, rrs490") -> str:
    m, feats = _MODEL[kind], _FEATURES[kind]
    means = ", ".join(f"avg({_value(*f)}) as v{i}" for i, f in enumerate(feats))
    dist = " + ".join(f"power((f{i} - v{i}) / {s}, 2)" for i, s in enumerate(m["length_scales"]))
    trend = " + ".join([repr(m["beta"][0]), *(f"{b!r} * f{i}" for i, b in enumerate(m["beta"][1:]))])
    return f"""
    select {keys}, case when ok then power(10e0, {trend} + (select sum((grp - 3) * 0.02
        * {m['sigma_f'] ** 2!r} * power(1 + ({dist}) / {2 * m['alpha_rq']!r}, {-m['alpha_rq']!r}))
        from (select grp, platform, {means} from {_PIX} as p where {_fit(kind)} group by 1, 2) as a)) end as chl
    from (select *, ({_fit(kind)}) as ok, {', '.join(f'{_value(*f)} as f{i}' for i, f in enumerate(feats))}
      from {source} as o) as q
    """


def _gpr_pixels(spark, sf):
    return view(spark, sf, "obs").withColumns({
        "doy": F.dayofyear("obs_date"), "lon": F.col("x") * 18.0 - 175.0, "grp": F.col("granule_id") % 7})


def _gpr_model(spark, sf, kind: str):
    p = _gpr_pixels(spark, sf).withColumn("_f", gpr.features(kind)).where(F.col("_f").isNotNull())
    n = len(_FEATURES[kind])
    active = p.groupBy("grp", "platform").agg(F.array(*[F.avg(F.col("_f")[i]) for i in range(n)]).alias("vector"))
    return model_from_frame(active.withColumn("alpha", (F.col("grp") - 3) * 0.02), **_MODEL[kind])


def _gpr(spark, sf, kind: str):
    out = gpr.gpr_chl(_gpr_pixels(spark, sf), _gpr_model(spark, sf, kind), kind)
    return out.select("granule_id", "obs_date", "y", "x", "rrs490", "chl")


@query("a06_gpr_doy", _gpr_sql("doy"), {"chl": 7, "rrs490": 12})
def _(spark, sf):
    return _gpr(spark, sf, "doy")


@query("a07_gpr_lon_doy", _gpr_sql("lon_doy"), {"chl": 7, "rrs490": 12})
def _(spark, sf):
    return _gpr(spark, sf, "lon_doy")


def sql_plankton(source: str, keys: str) -> str:
    """Nine concentrations from `chl` of a subquery."""
    return f"""
    select {keys}, pico * chl as pico, nano * chl as nano, micro * chl as micro, dino * chl as dino,
      (micro - dino) * chl as diato, crypto * chl as crypto, green * chl as green, prokar * chl as prokar,
      (1 - micro - crypto - green - prokar) * chl as hapt
    from (select *, 1 - nano - pico as micro from (
      select *, 0.0196 * z * z * z + 0.0074 * z * z - 0.19 * z + 0.18 as pico,
        0.154 * exp(-power((z + 1.24) / 0.398, 2)) + 0.365 * exp(-power((z - 0.0266) / 0.719, 2)) as nano,
        1 / (1 + exp(0.5394 * z * z + 0.3687 * z + 2.8893)) as dino,
        0.078 * exp(-power((z + 4) / 4, 2)) + 0.0908 * exp(-power((z + 0.0709) / 0.526, 2)) as crypto,
        1 / (exp(-0.638 * z + 1.89) + 9.14 * z) as green,
        1 / (1 + exp(0.3387 * z * z * z + 1.1681 * z * z + 1.5926 * z + 3.4948)) as prokar
      from (select *, case when chl > 0.010 and chl < 4.580 then log10(chl) end as z from ({source}) as p0) as p1) as p2) as p3
    """


@query("a09_plankton_classes", sql_plankton("select obs_date, y, x, chl * 2 - 1 as chl from daily", "obs_date, y, x, chl"),
       8, ("chl", *plankton.CLASSES))
def _(spark, sf):
    d = view(spark, sf, "daily").withColumn("chl", F.col("chl") * 2 - 1)
    return plankton.plankton_classes(d)


# the inversion in SQL: one nested step per line of the method
_C = iop.COEFFICIENTS
_TABLES = {n: {w: c[i] for w, c in _C.items()} for i, n in enumerate(("aw", "bbw", "aph_a", "aph_b"))}


def sql_qaa(source: str, bands: tuple = iop.INPUT_BANDS) -> str:
    """The inversion over columns r412, r443, r490, r560, r665 of a subquery, which stand for five wavelengths."""
    aw = [_C[b][0] for b in bands]
    bw = [_C[b][1] for b in bands]
    u = ", ".join(
        f"(sqrt(0.089 * 0.089 + 4 * 0.1245 * b{n}) - 0.089) / (2 * 0.1245) as u{n}" for n in ("412", "443", "490", "560", "665"))
    b = ", ".join(f"{v} / (0.52 + 1.7 * {v}) as b{n}" for n, v in
                  (("412", "r412"), ("443", "r443"), ("490", "r490"), ("560", "r560"), ("665", "red")))

    def a(n: str, i: int) -> str:
        return f"(1 - u{n}) * ({bw[i]!r} + bbp0 * power(lam0 / {bands[i]}, eta)) / u{n}"

    steps = [
        """case when r665 <= 0 or r665 > 20 * power(r560, 1.5) or r665 < 0.9 * power(r560, 1.7)
             then 1.27 * power(r560, 1.47) + 0.00018 * power(r490 / r560, -3.19) else r665 end as red""",
        b, u,
        "log10((b443 + b490) / (b560 + 5 * (b665 / b490) * b665)) as chi, b443 / b560 as ratio",
        f"""case when red >= 0.0015 then {bands[4]}e0 else {bands[3]}e0 end as lam0,
           case when red >= 0.0015 then {aw[4]!r} + 0.39 * power(b665 / (b443 + b490), 1.14)
             else {aw[3]!r} + power(10e0, -1.1459 - 1.3658 * chi - 0.4693 * chi * chi) end as a0,
           2 * (1 - 1.2 * exp(-0.9 * ratio)) as eta, 0.74 + 0.2 / (0.8 + ratio) as zeta, 0.015 + 0.002 / (0.6 + ratio) as s""",
        f"""case when red >= 0.0015 then u665 * a0 / (1 - u665) - {bw[4]!r}
             else u560 * a0 / (1 - u560) - {bw[3]!r} end as bbp0""",
        f"{a('412', 0)} as a412, {a('443', 1)} as a443, {a('560', 3)} as a555, exp(s * 27) as z",
        f"((a412 - zeta * a443) - ({aw[0]!r} - zeta * {aw[1]!r})) / (z - zeta) as adg1",
        f"a443 - adg1 - {aw[1]!r} as aph1",
        f"""case when aph1 / a443 < 0.15 or aph1 / a443 > 0.6 then a443 * least(greatest(
             -0.8 + 1.4 * (a443 - {aw[1]!r} / a412 - {aw[0]!r}), 0.15), 0.6) else aph1 end as aph443""",
        f"""case when aph1 / a443 < 0.15 or aph1 / a443 > 0.6 then a443 - aph443 - {aw[1]!r} else adg1 end as adg443,
           bbp0 * power(lam0 / {bands[1]}, eta) as bbp443, bbp0 * power(lam0 / {bands[2]}, eta) as bbp510""",
    ]
    text = source
    for i, step in enumerate(steps):
        text = f"select *, {step} from ({text}) as s{i}"
    return text


def sql_forward(wl: float, reference: float) -> str:
    # between the built-in wavelengths the coefficients are interpolated
    aw, bw, ca, cb = (iop.coefficient(n, wl, _TABLES[n]) for n in ("aw", "bbw", "aph_a", "aph_b"))
    _, _, ra, rb = _C[reference]
    bb = f"(bbp0 * power(lam0 / {wl}, eta) + {bw!r})"
    a = (f"(adg443 * exp(-s * ({wl} - 443)) + {ca!r} * power(aph443 / {ra!r}, {(1 - cb) / (1 - rb)!r}) + {aw!r})")
    r = f"(0.089 * {bb} / ({bb} + {a}) + 0.1245 * power({bb} / ({bb} + {a}), 2))"
    return f"(0.52 * {r} / (1 - 1.7 * {r}))"


_INPUTS = "select * from spectra5 where r412 > 0 and r443 > 0 and r490 > 0 and r560 > 0 and r665 is not null"
_IOP_DIGITS = dict.fromkeys(iop.IOP_FIELDS, 8)


@query("a10_qaa_iop", f"""
    select l_orderkey, l_linenumber, bbp443, adg443, aph443, lam0 as lambda0, eta, s, a555, bbp0, a0, bbp510
    from ({sql_qaa(_INPUTS)}) as q
""", _IOP_DIGITS)
def _(spark, sf):
    d = iop.with_iop(view(spark, sf, "spectra5"), "r412", "r443", "r490", "r560", "r665")
    return d.select("l_orderkey", "l_linenumber", *[F.col("iop")[f].alias(f) for f in iop.IOP_FIELDS])


_SPECTRA = ("r412", "r443", "r490", "r560", "r665")
_F = {w: sql_forward(w, 443.0) for w in (442.5, 443.0, 490.0, 510.0, 555.0, 560.0, 665.0, 670.0)}


@query("a11_band_shift", f"""
    select l_orderkey, l_linenumber, f443 * r443 / f442 as s443,
      (50 * f510 * r490 / f490 + 20 * f510 * r560 / f560) / 70 as s510, f555 * r560 / f560 as s555,
      f670 * red / f665 as s670
    from (select *, {_F[443.0]} as f443, {_F[442.5]} as f442, {_F[510.0]} as f510, {_F[490.0]} as f490,
      {_F[560.0]} as f560, {_F[555.0]} as f555, {_F[670.0]} as f670, {_F[665.0]} as f665
      from ({sql_qaa(_INPUTS)}) as q) as f
""", 9, ("s443", "s510", "s555", "s670"))
def _(spark, sf):
    shifted = iop.band_shift(view(spark, sf, "spectra5"), [443.0, 510.0, 555.0, 670.0], _SPECTRA,
                             names=["s443", "s510", "s555", "s670"])
    return shifted.select("l_orderkey", "l_linenumber", "s443", "s510", "s555", "s670")


# the same columns read as the bands of the multi-sensor product
_OTHER_BANDS = (412.0, 443.0, 490.0, 555.0, 670.0)
_G = {w: sql_forward(w, 443.0) for w in (490.0, 520.0, 555.0, 560.0, 620.0, 665.0, 670.0)}


@query("a10_qaa_iop_multi", f"""
    select l_orderkey, l_linenumber, bbp443, adg443, aph443, lam0 as lambda0, eta, s, a555, bbp0, a0, bbp510
    from ({sql_qaa(_INPUTS, _OTHER_BANDS)}) as q
""", _IOP_DIGITS)
def _(spark, sf):
    d = iop.with_iop(view(spark, sf, "spectra5"), dict(zip(_OTHER_BANDS, _SPECTRA)))
    return d.select("l_orderkey", "l_linenumber", *[F.col("iop")[f].alias(f) for f in iop.IOP_FIELDS])


@query("a11_band_shift_multi", f"""
    select l_orderkey, l_linenumber,
      (35 * f520 * r490 / f490 + 30 * f520 * r560 / f555) / 65 as s520, f560 * r560 / f555 as s560,
      (50 * f620 * r560 / f555 + 65 * f620 * red / f670) / 115 as s620, f665 * red / f670 as s665
    from (select *, {', '.join(f'{q} as f{w:g}' for w, q in _G.items())} from ({sql_qaa(_INPUTS, _OTHER_BANDS)}) as q) as f
""", 9, ("s520", "s560", "s620", "s665"))
def _(spark, sf):
    shifted = iop.band_shift(view(spark, sf, "spectra5"), [520.0, 560.0, 620.0, 665.0], dict(zip(_OTHER_BANDS, _SPECTRA)),
                             names=["s520", "s560", "s620", "s665"], tables=_TABLES)
    return shifted.select("l_orderkey", "l_linenumber", "s520", "s560", "s620", "s665")


# A knot for every part, at places of their own and some at one place.
_KNOTS = "(select 400e0 + (p_partkey * 7919 % 20011) / 64e0 as wl, max(p_retailprice) as v from part group by 1)"


@query("a12_coefficient", f"""
    with k as (select wl, v, lead(wl) over (order by wl) as wl1, lead(v) over (order by wl) as v1 from {_KNOTS} as t),
      e as (select min(wl) as lo, max(wl) as hi, arg_min(v, wl) as vlo, arg_max(v, wl) as vhi from {_KNOTS} as t),
      p as (select l_orderkey, l_linenumber, 380e0 + l_quantity * 7.3e0 + l_suppkey / 7e0 as w from lineitem)
    select l_orderkey, l_linenumber, w, case when w <= lo then vlo when w >= hi then vhi
      else v + (v1 - v) * (w - wl) / (wl1 - wl) end as coefficient
    from p cross join e asof left join k on p.w >= k.wl
""", 6, ("w", "coefficient"))
def _(spark, sf):
    place = F.lit(400.0) + (F.col("p_partkey") * 7919 % 20011) / 64.0
    knots = table(spark, sf, "part").groupBy(place.alias("wl")).agg(F.max("p_retailprice").alias("v"))
    points = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.lit(380.0) + F.col("l_quantity") * 7.3 + F.col("l_suppkey") / 7.0).alias("w"))
    return coefficients.interpolate_table(points, knots, "w", "wl", "v", "coefficient")


@query("f06_band_table", """
    with b as (select p_partkey as position, 400e0 + (p_partkey * 7919 % 20011) / 64e0 as band from part),
      p as (select distinct 380e0 + l_quantity * 7e0 as w from lineitem),
      n as (select w, arg_min(band, position) as band from p join b on abs(b.band - p.w) < 0.5 group by 1)
    select l_orderkey, l_linenumber, n.band from lineitem left join n on n.w = 380e0 + l_quantity * 7e0
""", 6, ("band",))
def _(spark, sf):
    bands = table(spark, sf, "part").select(F.col("p_partkey").alias("position"), (F.lit(400.0) + (F.col("p_partkey") * 7919 % 20011) / 64.0).alias("band"))
    points = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.lit(380.0) + F.col("l_quantity") * 7.0).alias("w"))
    return coefficients.nearest_in_table(points, bands, "w", "position", "band", "band", 0.5).drop("w")


# --- chains ---
_REFLECTANCE = ", ".join(
    f"case when v_{b} between {lo} and {hi} then v_{b} end as {b}" for b, (lo, hi) in LIMITS.items())
_SUMS = ", ".join(f"avg(case when {b} between {lo} and {hi} then {b} end) as v_{b}" for b, (lo, hi) in LIMITS.items())
_VOID = " or ".join(f"{b} is null or {b} < 0" for b in BANDS5)
_DAILY_RRS = f"""
    select obs_date, y, x, {', '.join(f'case when not ({_VOID}) then {b} end as {b}' for b in BANDS5)}
    from (select obs_date, y, x, {_REFLECTANCE} from (
      select obs_date, y, x, {_SUMS} from (select obs_date, y, x,
        {', '.join(f'case when mask_default = 0 then {b} end as {b}' for b in BANDS5)} from scene) as c0
      group by 1, 2, 3) as c1) as c2
"""
_PRODUCTS = f"""
    select obs_date, y, x, case when chl_second between 0.003 and 100 then chl_second end as chl,
      case when kd490 between 0 and 100 then kd490 end as kd490
    from ({_RATIO.replace('_SOURCE_', f'({_DAILY_RRS})')}) as r
"""


@query("plan_monthly_chlorophyll", f"""
    select cast(date_trunc('month', obs_date) as date) as month, y, x, avg(chl) as value, count(chl) as value_count,
      var_samp(chl) as value_error, sqrt(var_samp(chl)) as value_std
    from ({_PRODUCTS}) as p group by 1, 2, 3
""", 7, ("value", "value_error", "value_std"))
def _(spark, sf):
    return monthly_chlorophyll(view(spark, sf, "obs"), FLAGS, MASKING, LIMITS, BANDS5)


@query("plan_daily_products", _PRODUCTS, 7, ("chl", "kd490"))
def _(spark, sf):
    masked = mask_pixels(view(spark, sf, "obs"), FLAGS, MASKING, BANDS5)
    return add_band_ratio_products(daily_reflectance(masked, LIMITS, BANDS5)).select("obs_date", "y", "x", "chl", "kd490")


_BANDS_FROM_V = {"rrs443": "v / 6e7 + 0.001e0", "rrs490": "v / 5e7 + 0.0015e0", "rrs510": "v / 7e7 + 0.001e0",
                 "rrs560": "v / 9e7 + 0.0008e0"}
_MULTI = f"""
    (select granule_id, y, x, {', '.join(f'case when cell_lat >= 65 then {e} end as {b}' for b, e in _BANDS_FROM_V.items())}
      from (select n.*, {geography.sql_lonlat('n.y', 'n.x', geography.TOY)[1]} as cell_lat
        from ({geography.NEAREST}) as n) as m)
"""


@query("plan_multi_products", f"""
    select granule_id, y, x, case when chl_second between 0.003 and 100 then chl_second end as chl,
      case when kd490 between 0 and 100 then kd490 end as kd490
    from ({_RATIO.replace('_SOURCE_', _MULTI + ' as src')}) as r
""", 7, ("chl", "kd490"))
def _(spark, sf):
    s = view(spark, sf, "swath_pts").selectExpr(
        "granule_id", "row", "col", "lat", "lon", *[f"{e} as {b}" for b, e in _BANDS_FROM_V.items()])
    out = multi_products(s, geography.TOY, ["granule_id"], geography.RADIUS, geography.BITS)
    return out.select("granule_id", "y", "x", "chl", "kd490")


_DAY = "(case when strftime(d.obs_date, '%m%d') = '0229' then '0228' else strftime(d.obs_date, '%m%d') end)"
_AVG = "(select obs_date, y, x, avg(rrs443) as rrs443, avg(rrs490) as rrs490, avg(rrs510) as rrs510, " \
       "avg(rrs560) as rrs560, dayofyear(obs_date) as doy from obs group by obs_date, y, x)"
_CHAIN = f"""
    select obs_date, y, x, case when chl between 0.003 and 100 then chl end as chl
    from ({_gpr_sql('doy', _AVG, 'obs_date, y, x')}) as g
"""


@query("a14_plankton_chain", f"""
    select p.*, (log10(case when p.chl > 0 then p.chl end) - c.median) / nullif(c.n_std, 0) as qi_chl
    from ({sql_plankton(_CHAIN, 'obs_date, y, x, chl')}) as p
    left join ({clim_sql('log10(chl)')}) as c
      on c.mmdd = {_DAY.replace('d.obs_date', 'p.obs_date')} and c.y = p.y and c.x = p.x
""", 6, ("chl", *plankton.CLASSES, "qi_chl"))
def _(spark, sf):
    daily = view(spark, sf, "obs").groupBy("obs_date", "y", "x").agg(*[F.avg(b).alias(b) for b in RRS])
    clim = climatology(view(spark, sf, "daily"), "chl", SIDE, SIDE, log=True)
    out = plankton_chain(daily, _gpr_model(spark, sf, "doy"), "doy", clim)
    return out.select("obs_date", "y", "x", "chl", *plankton.CLASSES, "qi_chl")


@query("plan_archive_quality", f"""
    select d.obs_date, d.y, d.x, d.chl,
      (log10(case when chl > 0 then chl end) - c.median) / nullif(c.n_std, 0) as qi_chl
    from daily as d left join ({clim_sql('log10(chl)')}) as c on c.mmdd = {_DAY} and c.y = d.y and c.x = d.x
""", 6, ("chl", "qi_chl"))
def _(spark, sf):
    return archive_quality(view(spark, sf, "daily"), "chl", SIDE, SIDE)


# Swaths of eight granules, nine days apart.
_OLCI_BANDS = ("rrs443", "rrs490", "rrs510", "rrs560")
_OLCI_LAT, _OLCI_DOMAIN, _OLCI_VALID = 89.99, 70.0, 300
_INSIDE = f"{geography.sql_lonlat('y', 'x', geography.TOY)[1]} >= {_OLCI_DOMAIN}"
_OLCI_DAY = f"""(select obs_date, y, x, dayofyear(obs_date) as doy, rrs560, {', '.join(f'case when {" and ".join(f"{c} >= 0" for c in CENTRAL)} then {b} end as {b}' for b in CENTRAL)}
    from (select obs_date, y, x, {', '.join(f'avg(case when mask > 0 and {b} between {LIMITS[b][0]} and {LIMITS[b][1]} and {_INSIDE} then {b} end) as {b}' for b in _OLCI_BANDS)}
      from (select *, count(case when mask = 1 then 1 end) over (partition by granule_id) as n_valid from (
          select granule_id, y, x, cast(date '2000-03-01' + cast(granule_id * 9 as integer) as date) as obs_date, 1 - mask_default as mask,
            {', '.join(f'{e} as {b}' for b, e in _BANDS_FROM_V.items())}
          from ({geography.NEAREST}) as k
          where granule_id in (select granule_id from swath_pts group by 1 having max(lat) >= {_OLCI_LAT})) as l) as m
      where n_valid > {_OLCI_VALID} group by 1, 2, 3) as c)"""


@query("plan_olci_month", f"""
    select cast(date_trunc('month', obs_date) as date) as month, y, x, avg(case when chl > 0 then chl end) as value,
      count(case when chl > 0 then 1 end) as value_count, var_samp(case when chl > 0 then chl end) as value_error,
      sqrt(var_samp(case when chl > 0 then chl end)) as value_std
    from (select obs_date, y, x, case when chl between 0.003 and 100 then chl end as chl
      from ({_gpr_sql('doy', _OLCI_DAY, 'obs_date, y, x')}) as g) as h group by 1, 2, 3
""", 6, ("value", "value_error", "value_std"))
def _(spark, sf):
    swath = view(spark, sf, "swath_pts").selectExpr(
        "granule_id", "case when granule_id % 2 = 0 then 'S3A' else 'S3B' end as platform", "date_add(date'2000-03-01', cast(granule_id * 9 as int)) as obs_date",
        "row", "col", "lat", "lon", "1 - mask_default as mask", *[f"{e} as {b}" for b, e in _BANDS_FROM_V.items()])
    limits = {b: LIMITS[b] for b in _OLCI_BANDS}
    return olci_month(swath, geography.TOY, geography.RADIUS, limits, CENTRAL, _gpr_model(spark, sf, "doy"), "doy", _OLCI_LAT, _OLCI_DOMAIN, _OLCI_VALID, geography.BITS)


_CLASSES_OF_MONTH = ("chl", *plankton.CLASSES[:3])
_SCENE = f"""(select obs_date, y, x, dayofyear(obs_date) as doy, {', '.join(f'case when inside then {b} end as {b}' for b in _BANDS_FROM_V)}
    from (select cast(date '2000-03-01' + cast(granule_id * 9 as integer) as date) as obs_date, y, x,
        {geography.sql_lonlat('y', 'x', geography.TOY)[1]} >= 65 as inside, {', '.join(f'{e} as {b}' for b, e in _BANDS_FROM_V.items())}
      from ({geography.NEAREST}) as k) as l)"""
_SCENE_CHL = f"""select obs_date, y, x, case when chl between 0.003 and 100 then chl end as chl
    from ({_gpr_sql('doy', _SCENE, 'obs_date, y, x')}) as g"""


@query("plan_multi_month", f"""
    with d as (select * from ({sql_plankton(_SCENE_CHL, 'obs_date, y, x, chl')}) as p),
      u as ({' union all '.join(f"select obs_date, y, x, '{c}' as product, cast({c} as double) as value from d" for c in _CLASSES_OF_MONTH)})
    select cast(date_trunc('month', obs_date) as date) as month, product, y, x, avg(case when value > 0 then value end) as value,
      count(case when value > 0 then 1 end) as value_count, var_samp(case when value > 0 then value end) as value_error,
      sqrt(var_samp(case when value > 0 then value end)) as value_std
    from u group by 1, 2, 3, 4
""", 6, ("value", "value_error", "value_std"))
def _(spark, sf):
    scene = view(spark, sf, "swath_pts").selectExpr(
        "date_add(date'2000-03-01', cast(granule_id * 9 as int)) as obs_date", "row", "col", "lat", "lon", *[f"{e} as {b}" for b, e in _BANDS_FROM_V.items()])
    return multi_month(scene, geography.TOY, list(_BANDS_FROM_V), _gpr_model(spark, sf, "doy"), "doy", _CLASSES_OF_MONTH, None, geography.RADIUS, bits=geography.BITS)
