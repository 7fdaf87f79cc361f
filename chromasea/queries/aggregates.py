"""Queries for counters, composites and summaries (R-01 to R-08, R-15 to R-21, A-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chromasea.functions.reflectance import BAND_MAX, BAND_MIN
from chromasea.operators import composite, quality
from chromasea.operators.months import MonthlyState
from chromasea.queries.base import query, table, view
from chromasea.queries.expressions import BANDS5, FLAGS, MASKING
from chromasea.sources import catalogue

LIMITS = {b: (BAND_MIN[w], BAND_MAX) for b, w in zip(BANDS5, (442.5, 490.0, 510.0, 560.0, 665.0))}
# Narrower limits, so that the range filter bites on the fixture.
TIGHT = {"rrs443": (0.0005, 0.008), "rrs490": (0.001, 0.009), "rrs510": (0.0005, 0.007),
         "rrs560": (0.0008, 0.0055), "rrs665": (0.0, 0.0003)}
CENTRAL = ("rrs443", "rrs490", "rrs510")


@query("r01_granule_counters", """
    select granule_id, count(*) as n_total, cast(sum(cast(flags & 65548 <> 0 as int)) as bigint) as n_flagged,
      cast(sum(cast(flags & 2 <> 0 as int)) as bigint) as n_water1,
      cast(sum(cast(flags & 4 = 0 as int)) as bigint) as n_water2,
      cast(sum(1 - mask_default) as bigint) as n_valid,
      coalesce(100e0 * sum(1 - mask_default) / nullif(sum(cast(flags & 4 = 0 as int)), 0), 0) as p_valid
    from scene group by 1
""", 8, ("p_valid",))
def _(spark, sf):
    return quality.granule_counters(view(spark, sf, "scene"), FLAGS, MASKING)


@query("r02_band_qa", """
    with w as (select granule_id, count(rrs443) as n443, count(rrs665) as n665,
        cast(sum(case when mask_default = 0 and rrs443 < 0 then 1 else 0 end) as bigint) as g443,
        cast(sum(case when mask_default = 0 and rrs665 < 0 then 1 else 0 end) as bigint) as g665
      from scene group by 1)
    select granule_id, least(n443, n665) as n_valid_min, 'rrs443' as band, n443 as n_valid, g443 as n_negative from w
    union all select granule_id, least(n443, n665), 'rrs665', n665, g665 from w
""")
def _(spark, sf):
    return quality.band_qa(view(spark, sf, "scene"), ["rrs443", "rrs665"])


def _mean(b: str) -> str:
    lo, hi = TIGHT[b]
    v = f"(sum(case when mask > 0 and {b} between {lo} and {hi} then {b} * mask end)" \
        f" / nullif(sum(case when mask > 0 and {b} between {lo} and {hi} then mask end), 0))"
    return f"case when {v} between {lo} and {hi} then {v} end as {b}"


_MEANS = ", ".join(_mean(b) for b in TIGHT)
_MASKS = """count(case when mask >= 0 then 1 end) as n_granules,
      cast(coalesce(sum(case when mask > 0 then mask end), 0) as bigint) as sum_weights,
      cast(coalesce(bit_or(case when mask > 0 then case platform when 'S3A' then 1 else 2 end end), 0) as integer) as sensormask"""


@query("r03_daily_composite", f"select obs_date, y, x, {_MEANS} from scene group by 1, 2, 3", 13, tuple(TIGHT))
def _(spark, sf):
    return composite.daily_composite(view(spark, sf, "scene"), TIGHT)


@query("r03_monthly_cell_composite", f"select y, x, {_MEANS} from scene group by 1, 2", 12, tuple(TIGHT))
def _(spark, sf):
    return composite.daily_composite(view(spark, sf, "scene"), TIGHT, keys=("y", "x"))


@query("r04_daily_mask", f"select obs_date, y, x, {_MASKS} from scene group by 1, 2, 3")
def _(spark, sf):
    return composite.daily_mask(view(spark, sf, "scene"))


_BAD = " or ".join(f"{b} is null or {b} < 0" for b in CENTRAL)


@query("r05_central_bands", f"""
    select obs_date, y, x, {', '.join(f'case when not ({_BAD}) then {b} end as {b}' for b in CENTRAL)}, rrs560, rrs665,
      n_granules, case when {_BAD} then 0 else sum_weights end as sum_weights, sensormask
    from (select obs_date, y, x, {_MEANS}, {_MASKS} from scene group by 1, 2, 3) as c
""", 13, tuple(TIGHT))
def _(spark, sf):
    daily = composite.daily_composite(view(spark, sf, "scene"), TIGHT, with_mask=True)
    return composite.enforce_central_bands(daily, CENTRAL)


_JOINT = " and ".join(f"coalesce({b} between {TIGHT[b][0]} and {TIGHT[b][1]}, false)" for b in CENTRAL)


def _joint_mean(b: str, compat: bool) -> str:
    if b in CENTRAL:
        return f"sum(case when m > 0 then {b} * m end) / nullif(sum(case when m > 0 then m end), 0) as {b}"
    hit = f"m > 0 and {b} between {TIGHT[b][0]} and {TIGHT[b][1]}"
    own = f"nullif(sum(case when {hit} then m end), 0)"
    divisor = f"(case when {own} > 0 then sum(case when m > 0 then m end) end)" if compat else own
    return f"sum(case when {hit} then {b} * m end) / {divisor} as {b}"


def _joint_sql(compat: bool) -> str:
    return f"""
    select obs_date, y, x, {', '.join(_joint_mean(b, compat) for b in TIGHT)}, {_MASKS.replace(' mask ', ' m ').replace('then mask end', 'then m end')}
    from (select *, case when mask is null then null when {_JOINT} then mask else 0 end as m from scene) as s
    group by 1, 2, 3
    """


@query("r06_joint_composite", _joint_sql(False), 13, tuple(TIGHT))
def _(spark, sf):
    return composite.daily_composite_joint(view(spark, sf, "scene"), TIGHT, CENTRAL)


@query("r06_joint_composite_compat", _joint_sql(True), 13, tuple(TIGHT))
def _(spark, sf):
    return composite.daily_composite_joint(view(spark, sf, "scene"), TIGHT, CENTRAL, compat_joint_divisor=True)


_MONTH = "cast(date_trunc('month', obs_date) as date)"


@query("r07_monthly_composite", f"""
    select {_MONTH} as month, y, x, avg(case when chl > 0 then chl end) as value,
      count(case when chl > 0 then 1 end) as value_count, var_samp(case when chl > 0 then chl end) as value_error,
      sqrt(var_samp(case when chl > 0 then chl end)) as value_std
    from daily group by 1, 2, 3
""", 8, ("value", "value_error", "value_std"))
def _(spark, sf):
    return composite.monthly_composite(view(spark, sf, "daily"), "chl")


@query("r07_months_kept_up", f"""
    select {_MONTH} as month, y, x, avg(case when chl > 0 then chl end) as value,
      count(case when chl > 0 then 1 end) as value_count, var_samp(case when chl > 0 then chl end) as value_error,
      sqrt(var_samp(case when chl > 0 then chl end)) as value_std
    from daily group by 1, 2, 3
""", 6, ("value", "value_error", "value_std"))
def _(spark, sf):
    """Days arrive in two batches, the first of them with other values, which a third batch replaces."""
    daily = view(spark, sf, "daily")
    early = F.dayofmonth("obs_date") % 3 == 0
    months = MonthlyState(spark, "chl")
    months.update(daily.where(early).withColumn("chl", F.col("chl") * 3 + 1), "preliminary")
    months.update(daily.where(~early), "others")
    months.update(daily.where(early), "final")
    return months.read()


@query("r08_weighted_monthly", f"""
    select {_MONTH} as month, y, x, avg(v) as value, count(v) as value_count, var_samp(v) as value_error,
      sqrt(var_samp(v)) as value_std
    from (select d.obs_date, y, x, case when chl * weight > 0 then chl * weight end as v from daily as d
      join (select cast(o_orderdate as date) as obs_date, cast(count(*) % 4 as double) / 2 as weight
        from orders group by 1) as w on w.obs_date = d.obs_date) as s
    group by 1, 2, 3
""", 8, ("value", "value_error", "value_std"))
def _(spark, sf):
    weights = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("obs_date")).agg(
        ((F.count(F.lit(1)) % 4).cast("double") / 2).alias("weight"))
    return composite.monthly_composite(view(spark, sf, "daily"), "chl", weights=weights)


@query("r15_valid_by_date", """
    select cast(d as date) as obs_date, coalesce(a, 0) as n_rrs443, coalesce(b, 0) as n_rrs665
    from range(date '1995-01-01', date '2002-01-01', interval 1 day) as r(d)
    left join (select obs_date, count(rrs443) as a, count(rrs665) as b from obs group by 1) as c
      on c.obs_date = cast(d as date)
""")
def _(spark, sf):
    days = catalogue.calendar(spark, "1995-01-01", "2001-12-31")
    return composite.valid_by_date(view(spark, sf, "obs"), ["rrs443", "rrs665"], days)


@query("r16_valid_percent", """
    select 'rrs443' as variable, count(rrs443) as n_valid, 100e0 * count(rrs443) / count(*) as percent from obs
    union all select 'rrs665', count(rrs665), 100e0 * count(rrs665) / count(*) from obs
""", 9, ("percent",))
def _(spark, sf):
    return composite.valid_percent(view(spark, sf, "obs"), ["rrs443", "rrs665"])


@query("r17_sum_masks", """
    select y, x, cast(coalesce(sum(mask), 0) as bigint) as mask_sum from scene group by 1, 2
""")
def _(spark, sf):
    return composite.sum_masks(view(spark, sf, "scene"))


@query("r18_last_granule", """
    select obs_date, y, x, coalesce(max(case when oza > 20 then granule_id % 30 + 1 end), 0)
      as sensor_id from obs group by 1, 2, 3
""")
def _(spark, sf):
    o = view(spark, sf, "obs").withColumns({
        "granule_index": F.col("granule_id") % 30 + 1, "oza": F.when(F.col("oza") > 20, F.col("oza"))})
    return composite.last_granule(o, cell=("obs_date", "y", "x"))


@query("r19_orbit_bits", """
    select obs_date, y, x, orbit_block, cast(sum(bit) as bigint) as orbit_sum, cast(bit_or(bit) as bigint) as orbit_set
    from (select distinct obs_date, y, x, granule_id, cast(granule_id % 200 // 62 as integer) as orbit_block,
      cast(1 as bigint) << cast(granule_id % 200 % 62 as integer) as bit from obs) as b
    group by 1, 2, 3, 4
""")
def _(spark, sf):
    # two hundred passes, in four blocks of bits
    block = F.expr("cast(floor(granule_id % 200 / 62) as int)")
    bit = F.expr("shiftleft(1L, cast(granule_id % 200 % 62 as int))")
    o = view(spark, sf, "obs").select("obs_date", "y", "x", "granule_id", block.alias("orbit_block"), bit.alias("orbit_bit"))
    return composite.orbit_bits(o.distinct(), cell=("obs_date", "y", "x")).drop("orbit_total")


@query("r20_time_extent", """
    select platform, epoch_us(min(start_ts)) as time_min, epoch_us(max(start_ts)) as time_max from granules group by 1
""")
def _(spark, sf):
    extent = composite.time_extent(view(spark, sf, "granules"), keys=["platform"])
    return extent.select("platform", *[
        F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in ("time_min", "time_max")])


@query("r21_cell_series", "select obs_date, chl from daily where y = 7 and x = 11", 8, ("chl",))
def _(spark, sf):
    return composite.cell_series(view(spark, sf, "daily"), 7, 11, "chl")


@query("a08_valid_inputs", """
    select obs_date, y // 8 as tile_y, x // 8 as tile_x, cast(sum(case when rrs443 > 1e-8 and rrs490 > 1e-8
      and rrs510 > 1e-8 and rrs560 > 1e-8 and rrs443 < 1 / pi() and rrs490 < 1 / pi() and rrs510 < 1 / pi()
      and rrs560 < 1 / pi() then 1 else 0 end) as bigint) as n_valid
    from obs group by 1, 2, 3
""")
def _(spark, sf):
    return quality.valid_inputs(view(spark, sf, "obs"), ["rrs443", "rrs490", "rrs510", "rrs560"], "doy", 8, 8,
                                keys=["obs_date"])


@query("a08_valid_kd", """
    select obs_date, y // 8 as tile_y, x // 8 as tile_x,
      cast(sum(case when rrs443 >= 0 and rrs665 >= 0 then 1 else 0 end) as bigint) as n_valid
    from (select * replace (case when granule_id % 9 = 0 then 0 else rrs443 end as rrs443) from obs) as o group by 1, 2, 3
""")
def _(spark, sf):
    # Two bands of the fixture that have values below zero, and zeros, stand for 490 and 560 nm.
    o = view(spark, sf, "obs").withColumn("rrs443", F.when(F.col("granule_id") % 9 == 0, 0.0).otherwise(F.col("rrs443")))
    return quality.valid_inputs(o, ["rrs443", "rrs665"], "kd490", 8, 8, keys=["obs_date"])
