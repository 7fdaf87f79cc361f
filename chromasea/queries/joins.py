"""Queries for joins, overlaps and set operations (J-01 to J-08, U-01, U-02, R-10 to R-14, O-01, O-03)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chromasea.operators import climatology, gpr, grid, grouping, overlap
from chromasea.queries.base import VECTOR, query, table, view
from chromasea.queries.expressions import BANDS5
from chromasea.queries.windows import SIDE, clim_sql
from chromasea.sources import catalogue
from chromasea.sources.models import model_from_frame

# Constants of the toy regression model, for all elements of a vector.
BETA = (0.1, *(round(0.3 - 0.01 * i, 2) for i in range(VECTOR)))
SIGMA_F, SIGMA_L, ALPHA_RQ = 1.5, 0.4, 0.8
SCALES = tuple(round(0.6 + 0.02 * i, 2) for i in range(VECTOR))


def array_of(*names: str) -> Column:
    return F.array(*[F.col(n) for n in names])


@query("j01_align", """
    select s.granule_id, s.obs_date, s.y, s.x, s.mask, d.chl from scene as s join daily as d
      on s.obs_date = d.obs_date and s.y = d.y and s.x = d.x
""", 8, ("chl",))
def _(spark, sf):
    scene = view(spark, sf, "scene").select("granule_id", "obs_date", "y", "x", "mask")
    return grid.align(scene, view(spark, sf, "daily"), ["obs_date", "y", "x"])


_CLIM = clim_sql("log10(chl)")
_DAY = "(case when strftime(d.obs_date, '%m%d') = '0229' then '0228' else strftime(d.obs_date, '%m%d') end)"


def _clim(spark, sf):
    return climatology.climatology(view(spark, sf, "daily"), "chl", SIDE, SIDE, log=True)


@query("j02_join_climatology", f"""
    select d.obs_date, d.y, d.x, d.chl, c.median, c.nofobs
    from daily as d left join ({_CLIM}) as c on c.mmdd = {_DAY} and c.y = d.y and c.x = d.x
""", 7, ("chl", "median"))
def _(spark, sf):
    joined = climatology.join_climatology(view(spark, sf, "daily"), _clim(spark, sf))
    return joined.select("obs_date", "y", "x", "chl", "median", "nofobs")


@query("a13_quality_index", f"""
    select d.obs_date, d.y, d.x, d.chl,
      (log10(case when chl > 0 then chl end) - c.median) / nullif(c.n_std, 0) as qi
    from daily as d left join ({_CLIM}) as c on c.mmdd = {_DAY} and c.y = d.y and c.x = d.x
""", 6, ("chl", "qi"))
def _(spark, sf):
    return climatology.quality_index(view(spark, sf, "daily"), _clim(spark, sf), "chl", log=True, out="qi")


@query("a13_quality_rrs", f"""
    select d.obs_date, d.y, d.x, d.chl, (d.chl - c.median) / nullif(c.n_std, 0) as qi_chl
    from daily as d left join ({clim_sql("chl")}) as c on c.mmdd = {_DAY} and c.y = d.y and c.x = d.x
""", 6, ("chl", "qi_chl"))
def _(spark, sf):
    """Reflectances are compared as they are, without the logarithm."""
    daily = view(spark, sf, "daily")
    return climatology.quality_index(daily, climatology.climatology(daily, "chl", SIDE, SIDE), "chl", log=False)


_KD = "(select obs_date, y, x, chl / 10e0 as kd490 from daily)"


@query("a13_quality_kd490", f"""
    select d.obs_date, d.y, d.x, d.kd490, (log10(d.kd490) - c.median) / nullif(c.n_std, 0) as qi_kd490
    from {_KD} as d left join ({clim_sql("log10(chl / 10e0)")}) as c on c.mmdd = {_DAY} and c.y = d.y and c.x = d.x
""", 6, ("kd490", "qi_kd490"))
def _(spark, sf):
    daily = view(spark, sf, "daily").select("obs_date", "y", "x", (F.col("chl") / 10.0).alias("kd490"))
    return climatology.quality_index(daily, climatology.climatology(daily, "kd490", SIDE, SIDE, log=True), "kd490", log=True)


_MEET = "a.y_min <= b.y_max and a.y_max >= b.y_min and a.x_min <= b.x_max and a.x_max >= b.x_min"
_ENDPOINT = """(b.y_min between a.y_min and a.y_max or b.y_max between a.y_min and a.y_max)
    and (b.x_min between a.x_min and a.x_max or b.x_max between a.x_min and a.x_max)"""
_IN = {f"{k}{ax}": f"(b.{ax}_{k} between a.{ax}_min and a.{ax}_max)" for k in ("min", "max") for ax in "yx"}
_SPAN = {ax: f"(b.{ax}_min < a.{ax}_min and b.{ax}_max > a.{ax}_max)" for ax in "yx"}
_NINE = " or ".join(
    [f"({_IN[k + 'y']} and {_IN[m + 'x']})" for k in ("min", "max") for m in ("min", "max")]
    + [f"({_IN[k + 'y']} and {_SPAN['x']})" for k in ("min", "max")]
    + [f"({_IN[k + 'x']} and {_SPAN['y']})" for k in ("min", "max")] + [f"({_SPAN['y']} and {_SPAN['x']})"])


def _pair_sql(condition: str, order: str) -> str:
    return f"""
    select a.obs_date, a.granule_id as a_id, b.granule_id as b_id from granules as a join granules as b
      on a.obs_date = b.obs_date and {order} and ({condition})
    """


@query("j03_overlap_intersect", _pair_sql(_MEET, "a.granule_id < b.granule_id"))
def _(spark, sf):
    return overlap.overlap_pairs(view(spark, sf, "granules"), "intersect", limits=False)


@query("j04_overlap_endpoint", _pair_sql(_ENDPOINT, "a.granule_id <> b.granule_id"))
def _(spark, sf):
    return overlap.overlap_pairs(view(spark, sf, "granules"), "endpoint", limits=False)


@query("j05_overlap_ninecase", _pair_sql(_NINE, "a.granule_id <> b.granule_id"))
def _(spark, sf):
    return overlap.overlap_pairs(view(spark, sf, "granules"), "ninecase", limits=False)


@query("j06_overlap_extent", f"""
    select a.obs_date, a.granule_id, min(b.y_min) as y_min, max(b.y_max) as y_max, min(b.x_min) as x_min,
      max(b.x_max) as x_max
    from granules as a join granules as b on a.obs_date = b.obs_date and {_MEET} group by 1, 2
""")
def _(spark, sf):
    return overlap.overlap_extent(view(spark, sf, "granules"))


@query("j07_semi_anti", """
    select obs_date, count(*) as n, cast(sum(case when granule_id in (select event_id from events where value > 30)
      then 1 else 0 end) as bigint) as n_semi from granules group by 1
""")
def _(spark, sf):
    g = view(spark, sf, "granules").select("obs_date", "granule_id")
    high = table(spark, sf, "events").where(F.col("value") > 30).select(F.col("event_id").alias("granule_id"))
    both = g.join(high, "granule_id", "left_semi").withColumn("hit", F.lit(1)).unionByName(
        g.join(high, "granule_id", "left_anti").withColumn("hit", F.lit(0)))
    return both.groupBy("obs_date").agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("n_semi"))


def toy_model(spark, sf):
    active = view(spark, sf, "gpr_active").select(array_of(*[f"f{i}" for i in range(1, VECTOR + 1)]).alias("vector"), "alpha")
    return model_from_frame(active, BETA, SIGMA_F, ALPHA_RQ, SCALES)


_DIST = " + ".join(f"power((q.f{i + 1} - a.f{i + 1}) / {s}, 2)" for i, s in enumerate(SCALES))
_GPR = f"""
    select q.vec_id, any_value({BETA[0]} + {' + '.join(f'{b} * q.f{i + 1}' for i, b in enumerate(BETA[1:]))})
      + sum(a.alpha * {SIGMA_F**2} * power(1 + ({_DIST}) / {2 * ALPHA_RQ}, {-ALPHA_RQ})) as log_chl
    from gpr_query as q cross join gpr_active as a group by 1
"""


@query("j08_gpr_sql", _GPR, 9, ("log_chl",))
def _(spark, sf):
    q = view(spark, sf, "gpr_query")
    vector = array_of(*[f"f{i}" for i in range(1, VECTOR + 1)])
    return gpr.gpr_predict_sql(q, toy_model(spark, sf), vector).select("vec_id", "log_chl")


@query("j08_gpr_arrow", _GPR, 9, ("log_chl",))
def _(spark, sf):
    q = view(spark, sf, "gpr_query")
    vector = array_of(*[f"f{i}" for i in range(1, VECTOR + 1)])
    return gpr.gpr_predict(q, toy_model(spark, sf), vector).select("vec_id", "log_chl")


@query("u01_union_scenes", """
    select granule_id, y, x, rrs443, null as rrs665 from obs where platform = 'S3A'
    union all select granule_id, y, x, rrs443, rrs665 from obs where platform = 'S3B'
""", 12, ("rrs443", "rrs665"))
def _(spark, sf):
    o = view(spark, sf, "obs")
    a = o.where(F.col("platform") == "S3A").select("granule_id", "y", "x", "rrs443")
    b = o.where(F.col("platform") == "S3B").select("granule_id", "y", "x", "rrs443", "rrs665")
    return catalogue.union_scenes(a, b)


@query("u02_not_timely", """
    select obs_date, rel_orbit from granules except all select obs_date, rel_orbit from granules where timeliness = 'NT'
""")
def _(spark, sf):
    g = view(spark, sf, "granules")
    keys = ["obs_date", "rel_orbit"]
    return catalogue.not_timely(g.select(*keys), g.where(F.col("timeliness") == "NT").select(*keys))


_COVER = """
    select obs_date, y, x, cast(sum(case when mask > 0 then mask else 0 end) as integer) as n
    from scene group by 1, 2, 3
"""


@query("r10_overlap_histogram", f"""
    with c as ({_COVER})
    select 'count' as kind, n, cast(count(*) as double) as value from c where n >= 1 group by n
    union all select 'valid', null, cast(count(*) as double) from c where n >= 1
    union all select 'percent_overlap', null,
      100e0 * sum(case when n >= 2 then 1 else 0 end) / count(*) from c where n >= 1
""", 9, ("value",))
def _(spark, sf):
    cover = view(spark, sf, "scene").groupBy("obs_date", "y", "x").agg(
        F.sum(F.when(F.col("mask") > 0, F.col("mask")).otherwise(0)).alias("sum_weights"))
    return overlap.overlap_histogram(cover)


# Combinations are looked for per week, so that enough cells have two granules.
_WEEK = "cast(date_trunc('week', obs_date) as date)"
_SETS = f"""
    select week, y, x, list_sort(list(granule_id)) as granules from (
      select distinct {_WEEK} as week, y, x, granule_id from scene where mask > 0) as d
    group by 1, 2, 3 having count(*) = 2
"""


def _weekly(spark, sf):
    s = view(spark, sf, "scene")
    return s.withColumns({
        "week": F.trunc("obs_date", "week"),
        "start_ts": F.timestamp_seconds(F.unix_seconds(F.col("obs_date").cast("timestamp"))
                                        + (F.col("granule_id") % 24) * 3600 + (F.col("granule_id") % 7) * 600)})


CELL = ("week", "y", "x")


@query("r11_granule_sets", f"""
    select array_to_string(granules, '-') as granules, count(*) as n_pixels from ({_SETS}) as s group by 1
""")
def _(spark, sf):
    sets = overlap.granule_sets(_weekly(spark, sf), 2, cell=CELL)
    return sets.withColumn("granules", F.array_join("granules", "-"))


_MEMBER = f"""
    select array_to_string(s.granules, '-') as granules, p.granule_id, {', '.join('p.' + b for b in BANDS5)}, p.oza,
      p.platform, epoch(p.obs_date) + (p.granule_id % 24) * 3600 + (p.granule_id % 7) * 600 as start_s,
      s.week, s.y, s.x
    from ({_SETS}) as s join (select *, {_WEEK} as week from scene) as p
      on p.week = s.week and p.y = s.y and p.x = s.x and list_contains(s.granules, p.granule_id)
"""
_MEANS = f"""
    select granules, granule_id, {', '.join(f'avg({b}) as {b}' for b in BANDS5)}, avg(oza) as oza,
      min(platform) as platform, min(start_s) as start_s from ({_MEMBER}) as m group by 1, 2
"""


def _spectra(spark, sf):
    return overlap.set_table(_weekly(spark, sf), 2, BANDS5, ["oza"], cell=CELL)


@query("r12_set_spectra", f"select granules, granule_id, {', '.join(BANDS5)}, oza, platform from ({_MEANS}) as g",
       11, (*BANDS5, "oza"))
def _(spark, sf):
    return overlap.set_spectra(_spectra(spark, sf)).withColumn("granules", F.array_join("granules", "-")).drop("start_ts")


@query("r12_set_summary", f"""
    select granules, {', '.join(f'avg({b}) as {b}' for b in BANDS5)}, max(oza) - min(oza) as oza_span,
      (max(start_s) - min(start_s)) / 3600e0 as hours, min(platform) <> max(platform) as mixed
    from ({_MEANS}) as g group by 1
""", 9, (*BANDS5, "oza_span", "hours"))
def _(spark, sf):
    summary = overlap.set_summary(_spectra(spark, sf), BANDS5, ["oza"])
    return summary.withColumn("granules", F.array_join("granules", "-")).drop("n_pixels")


@query("r12_set_pixel_spectra", f"""
    select granules, week, y, x, {', '.join(f'avg({b}) as {b}' for b in BANDS5)} from (
      select granules, week, y, x, granule_id, {', '.join(f'avg({b}) as {b}' for b in BANDS5)}
      from ({_MEMBER}) as m group by 1, 2, 3, 4, 5) as g group by 1, 2, 3, 4
""", 11, BANDS5)
def _(spark, sf):
    out = overlap.set_pixel_spectra(_weekly(spark, sf), 2, BANDS5, cell=CELL)
    return out.withColumn("granules", F.array_join("granules", "-"))


@query("r13_spectrum_envelope", """
    select label, band, avg(v) as mean, avg(v) - stddev_pop(v) as low, avg(v) + stddev_pop(v) as high, count(v) as n
    from (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) - 1 as band
      from embeddings) as e group by 1, 2 having count(v) >= 6
""", 8, ("mean", "low", "high"))
def _(spark, sf):
    out = overlap.spectrum_envelope(table(spark, sf, "embeddings"), "label", "embedding")
    return out.withColumn("band", F.col("band").cast("bigint"))


@query("r14_classify_sets", f"""
    select case when n < 100 then 'under_100' when n < 1000 then 'under_1000' else 'from_1000' end as size_class,
      case when hours < 1.5 then '0_to_1.5h' when hours < 3 then '1.5_to_3h' when hours < 12 then '3_to_12h'
        when hours < 24 then '12_to_24h' end as gap_class, mixed, count(*) as n_sets
    from (select granules, (max(start_s) - min(start_s)) / 3600e0 as hours, min(platform) <> max(platform) as mixed
        from ({_MEANS}) as g group by 1) as h
      join (select array_to_string(granules, '-') as granules, count(*) * 60 as n from ({_SETS}) as s group by 1) as c
      using (granules)
    group by 1, 2, 3
""")
def _(spark, sf):
    summary = overlap.set_summary(overlap.set_table(_weekly(spark, sf), 2, cell=CELL), [])
    classes = overlap.classify_sets(summary.withColumn("n_pixels", F.col("n_pixels") * 60))
    return classes.groupBy("size_class", "gap_class", "mixed").agg(F.count(F.lit(1)).alias("n_sets"))


@query("o01_order_spectra", f"""
    select granules, granule_id, platform, oza from ({_MEANS}) as g order by platform, oza
""", 9, ("oza",))
def _(spark, sf):
    s = overlap.set_spectra(_spectra(spark, sf)).withColumn("granules", F.array_join("granules", "-"))
    return overlap.order_spectra(s.select("granules", "granule_id", "platform", "oza"))


_MEETS = "e.y0 <= s.y_max and e.y1 >= s.y_min and e.x0 <= s.x_max and e.x1 >= s.x_min"
_FRESH = """{'i': cast(len(gs) + 1 as bigint), 'n': cast(1 as bigint), 'y0': y_min, 'y1': y_max, 'x0': x_min, 'x1': x_max}"""
_GROWN = """{'i': e.i, 'n': e.n + 1, 'y0': least(e.y0, y_min), 'y1': greatest(e.y1, y_max),
    'x0': least(e.x0, x_min), 'x1': greatest(e.x1, x_max)}"""
_GROUPS = f"""
    with recursive g as (
      select obs_date, y_min, y_max, x_min, x_max,
        row_number() over (partition by obs_date order by granule_id) as pos
      from granules where n_valid > 50),
    r as (
      select distinct obs_date, cast(0 as bigint) as pos,
        cast([] as struct(i bigint, n bigint, y0 integer, y1 integer, x0 integer, x1 integer)[]) as gs from g
      union all
      select obs_date, pos, case when k is null then list_append(gs, {_FRESH})
        else list_transform(gs, lambda e: case when e.i = k then {_GROWN} else e end) end as gs
      from (select s.*, list_min(list_transform(list_filter(gs, lambda e: e.n < 10 and {_MEETS}), lambda e: e.i)) as k
        from (select r.gs, g.* from r join g on g.obs_date = r.obs_date and g.pos = r.pos + 1) as s) as t)
    select obs_date, e.i as group_id, e.n as n, e.y0 as y_min, e.y1 as y_max, e.x0 as x_min, e.x1 as x_max
    from (select r.obs_date, unnest(r.gs) as e
      from r join (select obs_date, max(pos) as pos from g group by 1) as l on l.obs_date = r.obs_date and l.pos = r.pos) as u
"""


@query("o03_group_granules", _GROUPS)
def _(spark, sf):
    g = view(spark, sf, "granules").withColumn("granule_index", F.col("granule_id"))
    grouped = grouping.group_granules(
        g.select("obs_date", "granule_index", "n_valid", "y_min", "y_max", "x_min", "x_max"), cap=10, th=50)
    return grouping.group_limits(grouped)
