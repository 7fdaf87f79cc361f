"""Queries for indices, moving windows and neighbourhoods (W-01 to W-04, X-01 to X-03, R-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chromasea.functions.weights import spatial_weight
from chromasea.operators import climatology, neighbours
from chromasea.queries.base import query, view
from chromasea.sources import catalogue

SIDE = 20


@query("w01_index_granules", """
    with i as (select obs_date, granule_id, platform, rel_orbit,
        cast(row_number() over (partition by obs_date order by name) as integer) as granule_index from granules),
      p as (select obs_date, platform, rel_orbit,
        cast(row_number() over (partition by obs_date order by min(granule_index)) as integer) as orbit_rank
        from i group by 1, 2, 3)
    select i.obs_date, granule_id, granule_index, orbit_rank,
      cast((orbit_rank - 1) // 62 as integer) as orbit_block,
      cast(power(2, (orbit_rank - 1) % 62) as bigint) as orbit_bit
    from i join p on i.obs_date = p.obs_date and i.platform = p.platform and i.rel_orbit = p.rel_orbit
""")
def _(spark, sf):
    indexed = catalogue.index_granules(view(spark, sf, "granules"))
    return indexed.select("obs_date", "granule_id", "granule_index", "orbit_rank", "orbit_block", "orbit_bit")


_SHIFTED = """
    select obs_date - cast(k as integer) as target_date, cast(k as integer) as off,
      strftime(obs_date - cast(k as integer), '%m%d') as mmdd, y, x, chl
    from daily cross join range(-5, 6) as r(k) where strftime(obs_date - cast(k as integer), '%m%d') <> '0229'
"""


@query("w02_day_window", f"""
    select cast(target_date as date) as target_date, y, x, count(chl) as n, avg(chl) as chl, cast(sum(off) as bigint) as offsets
    from ({_SHIFTED}) as s group by 1, 2, 3
""", 8, ("chl",))
def _(spark, sf):
    return neighbours.day_window(view(spark, sf, "daily")).groupBy("target_date", "y", "x").agg(
        F.count("chl").alias("n"), F.avg("chl").alias("chl"), F.sum("offset").alias("offsets"))


@query("w03_temporal_weight", f"""
    select mmdd, y, x, sum(chl * (6 - abs(off)) / 6e0) as swx, sum((6 - abs(off)) / 6e0) as sw
    from ({_SHIFTED}) as s where chl is not null group by 1, 2, 3
""", 7, ("swx", "sw"))
def _(spark, sf):
    sums = neighbours.moving_sums(view(spark, sf, "daily"), "chl")
    return sums.groupBy("mmdd", "y", "x").agg(F.sum("w_sum").alias("swx"), F.sum("w").alias("sw"))


@query("w02_moving_sums", f"""
    select cast(target_date as date) as target_date, y, x, count(chl) as n, sum(chl) as sum, cast(sum(off) as bigint) as offsets,
      sum(chl * (6 - abs(off)) / 6e0) as w_sum
    from ({_SHIFTED}) as s where chl is not null group by 1, 2, 3
""", 7, ("sum", "w_sum"))
def _(spark, sf):
    return neighbours.moving_sums(view(spark, sf, "daily"), "chl").select("target_date", "y", "x", "n", "sum", "offsets", "w_sum")


@query("w04_best_timeliness", """
    select obs_date, rel_orbit, platform, timeliness, granule_id from (
      select *, row_number() over (partition by obs_date, rel_orbit, platform
        order by case timeliness when 'NT' then 1 when 'NR' then 2 else 3 end, granule_id) as rn from granules) as g where rn = 1
""")
def _(spark, sf):
    g = view(spark, sf, "granules").select("obs_date", "rel_orbit", "platform", "timeliness", "granule_id")
    return catalogue.best_timeliness(g, ["obs_date", "rel_orbit", "platform"], tie=["granule_id"])


_NEAR = f"""
    select obs_date, y - cast(a as integer) as y, x - cast(b as integer) as x, cast(a as integer) as dy,
      cast(b as integer) as dx, chl
    from daily cross join range(-1, 2) as r(a) cross join range(-1, 2) as s(b)
    where y - a between 0 and {SIDE - 1} and x - b between 0 and {SIDE - 1}
"""
_W = "(case abs(dy) + abs(dx) when 0 then 1e0 when 1 then 0.5e0 else 0.25e0 end)"


@query("x01_neighbours_3x3", _NEAR, 8, ("chl",))
def _(spark, sf):
    return neighbours.neighbours_3x3(view(spark, sf, "daily"), SIDE, SIDE)


@query("x02_spatial_weight", f"""
    select y, x, sum({_W}) as sw, sum({_W} * chl) as swx from ({_NEAR}) as n where chl is not null group by 1, 2
""", 6, ("sw", "swx"))
def _(spark, sf):
    n = neighbours.neighbours_3x3(view(spark, sf, "daily").where(F.col("chl").isNotNull()), SIDE, SIDE)
    w = spatial_weight(F.col("dy"), F.col("dx"))
    return n.groupBy("y", "x").agg(F.sum(w).alias("sw"), F.sum(w * F.col("chl")).alias("swx"))


@query("x03_smooth_3x3", f"""
    select obs_date, y, x, avg(chl) as avg, count(chl) as n, sum(chl * {_W}) / sum({_W}) as weighted_avg
    from ({_NEAR}) as n where chl is not null group by 1, 2, 3
""", 8, ("avg", "weighted_avg"))
def _(spark, sf):
    return neighbours.smooth_3x3(view(spark, sf, "daily"), "chl", SIDE, SIDE)


def clim_sql(value: str) -> str:
    """R-09 written out: every sample with its weight, then plain aggregates."""
    return f"""
    with s as (select strftime(t, '%m%d') as mmdd, ty as y, tx as x, w, v from (
        select obs_date - cast(k as integer) as t, y - cast(a as integer) as ty, x - cast(b as integer) as tx,
          {value} as v,
          (case abs(a) + abs(b) when 0 then 1e0 when 1 then 0.5e0 else 0.25e0 end) * (6 - abs(k)) / 6e0 as w
        from daily cross join range(-5, 6) as r(k) cross join range(-1, 2) as p(a) cross join range(-1, 2) as q(b)
        where chl > 0) as e
      where ty between 0 and {SIDE - 1} and tx between 0 and {SIDE - 1} and strftime(t, '%m%d') <> '0229'
        and year(t) between (select min(year(obs_date)) from daily where chl > 0) and (select max(year(obs_date)) from daily where chl > 0)),
    m as (select mmdd, y, x, sum(w * v) / sum(w) as mu from s group by 1, 2, 3)
    select s.mmdd, s.y, s.x, any_value(mu) as w_avg, avg(v) as n_avg, abs(avg(v) - any_value(mu)) as diff_n_w,
      case when min(v) = max(v) then 0e0 else stddev_pop(v) end as n_std,
      sqrt(sum(w * power(v - mu, 2)) / nullif((count(v) - 1) / cast(count(v) as double) * sum(w), 0)) as w_std,
      sum(w) as sum_w,
      100e0 * sum(w) / (24 * (select max(year(obs_date)) - min(year(obs_date)) + 1 from daily where chl > 0)) as porc_w,
      median(v) as median, min(v) as min, max(v) as max, count(v) as nofobs
    from s join m on s.mmdd = m.mmdd and s.y = m.y and s.x = m.x group by 1, 2, 3
    """


_STATS = ("w_avg", "n_avg", "diff_n_w", "n_std", "w_std", "sum_w", "porc_w", "median", "min", "max")


@query("r09_climatology", clim_sql("chl"), 7, _STATS)
def _(spark, sf):
    return climatology.climatology(view(spark, sf, "daily"), "chl", SIDE, SIDE)


@query("r09_climatology_log", clim_sql("log10(chl)"), 7, _STATS)
def _(spark, sf):
    return climatology.climatology(view(spark, sf, "daily"), "chl", SIDE, SIDE, log=True)
