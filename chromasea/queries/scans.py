"""Queries for sources, sinks and catalogues (S-01 to S-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chromasea.operators import quality, resample
from chromasea.queries.base import query, table, view
from chromasea.queries.expressions import FLAGS, MASKING
from chromasea.schema import complete_rows, require_columns
from chromasea.session import scratch_path
from chromasea.sources import catalogue, layout, manifest, pixels, reports


@query("s01_discover_granules", """
    select granule_id, name from granules
    where name like '%\\_NT\\_%' escape '\\' and contains(name, 'WFR') and not (name like '%004.SEN3')
""")
def _(spark, sf):
    return catalogue.discover_granules(view(spark, sf, "granules"), "NT", "WFR", 3).select("granule_id", "name")


@query("s01_discover_collection4", """
    select granule_id, name from granules
    where contains(name, '_NR_') and contains(name, 'WFR') and name like '%004.SEN3'
""")
def _(spark, sf):
    return catalogue.discover_granules(view(spark, sf, "granules"), "NR", "WFR", 4).select("granule_id", "name")


@query("s02_parse_granule_name", """
    select granule_id, substr(name, 1, 3) as platform, epoch(date_trunc('second', start_ts))::bigint as start_s,
      rel_orbit from granules
""")
def _(spark, sf):
    named = catalogue.parse_granule_name(view(spark, sf, "granules").select("granule_id", "name"))
    return named.select("granule_id", "platform", F.unix_seconds("start_ts").alias("start_s"), "rel_orbit")


@query("s03_parse_manifest", """
    select granule_id, 4 as n_vertices, lon0 as first_lon, lat0 as first_lat, lon0 + slant as last_lon,
      lat1 as last_lat, cast(granule_id % 385 as varchar) as orbit, 'descending' as direction
    from footprints
""", 6, ("first_lon", "first_lat", "last_lon", "last_lat"))
def _(spark, sf):
    f = view(spark, sf, "footprints")
    pairs = [("lat0", "lon0", False), ("lat0", "lon1", False), ("lat1", "lon1", True), ("lat1", "lon0", True)]
    text = F.concat_ws(" ", *[
        c for lat, lon, slanted in pairs
        for c in (F.col(lat).cast("string"), (F.col(lon) + F.col("slant") if slanted else F.col(lon)).cast("string"))
    ])
    tag = "sentinel-safe"
    lines = f.select("granule_id", F.explode(F.array(
        F.lit("<metadataSection>"),
        F.concat(F.lit("  <gml:posList>"), text, F.lit("</gml:posList>")),
        F.concat(F.lit(f"<{tag}:relativeOrbitNumber>"), F.col("granule_id") % 385,
                 F.lit(f"</{tag}:relativeOrbitNumber>")),
        F.lit(f"<{tag}:passDirection type='x'>descending</{tag}:passDirection>"),
    )).alias("line"))
    m = manifest.parse_manifest(lines)
    p = F.col("polygon")
    return m.select(
        "granule_id", F.size(p).alias("n_vertices"), p[0]["lon"].alias("first_lon"), p[0]["lat"].alias("first_lat"),
        p[3]["lon"].alias("last_lon"), p[3]["lat"].alias("last_lat"),
        F.col("params")["relativeOrbitNumber"].alias("orbit"), F.col("params")["passDirection"].alias("direction"),
    )


@query("s04_scan_box", """
    select granule_id, obs_date, y, x, rrs443, rrs560 from obs where y >= 4 and y < 12 and x >= 3 and x < 9
""", 12, ("rrs443", "rrs560"))
def _(spark, sf):
    path = scratch_path(spark, "pixels")
    pixels.write_pixels(view(spark, sf, "obs").select("granule_id", "obs_date", "y", "x", "rrs443", "rrs490", "rrs560"), path)
    return pixels.read_pixels(spark, path, ["granule_id", "obs_date", "y", "x", "rrs443", "rrs560"], (4, 12, 3, 9))


@query("s05_dated_layout", """
    select obs_date, y, x, chl, strftime(obs_date, '%Y') || '/' || strftime(obs_date, '%m') as folder
    from daily where obs_date between date '1996-06-10' and date '1999-03-20'
""", 8, ("chl",))
def _(spark, sf):
    path = scratch_path(spark, "dated")
    layout.write_dated(view(spark, sf, "daily"), path, "YYYY/mm")
    back = layout.read_dated(spark, path, "YYYY/mm", "1996-06-10", "1999-03-20")
    return back.withColumn("folder", layout.folder_of(F.col("obs_date"), "YYYY/mm"))


@query("s06_report", """
    select granule_id as source, cast(count(*) as bigint) as n_total,
      cast(sum(case when mask = 1 then 1 else 0 end) as bigint) as n_valid from scene group by 1
""")
def _(spark, sf):
    path = scratch_path(spark, "report")
    report = view(spark, sf, "scene").groupBy(F.col("granule_id").alias("source")).agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col("mask") == 1).alias("n_valid")
    )
    reports.write_report(report, path)
    return reports.read_report(spark, path, "source bigint, n_total bigint, n_valid bigint")


@query("s06_resample_report", """
    with i as (select *, cast(row_number() over (partition by obs_date order by name) as integer) as granule_index from granules),
      p as (select obs_date, platform, rel_orbit, row_number() over (partition by obs_date order by min(granule_index)) as place from i group by 1, 2, 3),
      c as (select granule_id, cast(max(x) + 1 as integer) as width, cast(max(y) + 1 as integer) as height, count(*) as n_total,
          cast(sum(cast(flags & 65548 <> 0 as int)) as bigint) as n_flagged, cast(sum(cast(flags & 2 <> 0 as int)) as bigint) as n_water1,
          cast(sum(cast(flags & 4 = 0 as int)) as bigint) as n_water2, cast(sum(1 - mask_default) as bigint) as n_valid,
          count(mask) as landed, cast(sum(case when mask = 1 then 1 else 0 end) as bigint) as clean from scene group by 1)
    select i.name as "Source", strftime(start_ts, '%Y%m%dT%H%M%S') as "StartDate", i.rel_orbit as "RelOrbit", granule_index as "GranuleIndex",
      cast(power(2, (place - 1) % 62) as bigint) as "OrbitIndex", width as "OrigWidth", height as "OrigHeight", n_total as "OrigNTotal", n_flagged as "OrigNFlagged",
      n_water1 as "OrigNWater1", n_water2 as "OrigNWater2", c.n_valid as "OrigNValid", coalesce(100e0 * c.n_valid / nullif(n_water2, 0), 0) as "OrigPValid",
      y_min as "YMin", y_max as "YMax", x_min as "XMin", x_max as "XMax", x_max - x_min as "Width", y_max - y_min as "Height",
      landed as "NTotal", clean as "NValid", coalesce(100e0 * clean / nullif(landed, 0), 0) as "PValid"
    from i join p on i.obs_date = p.obs_date and i.platform = p.platform and i.rel_orbit = p.rel_orbit join c on c.granule_id = i.granule_id
""", 8, ("OrigPValid", "PValid"))
def _(spark, sf):
    """The 22 columns, from counters, index and boxes, written and read back."""
    scene = view(spark, sf, "scene")
    counters = quality.granule_counters(scene, FLAGS, MASKING)
    sizes = scene.groupBy("granule_id").agg((F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"))
    landed = resample.resample_report(scene, counters.join(sizes, "granule_id"))
    indexed = catalogue.index_granules(view(spark, sf, "granules")).drop("n_valid").withColumn("start_date", F.date_format("start_ts", "yyyyMMdd'T'HHmmss"))
    path = scratch_path(spark, "resample-report")
    reports.write_report(reports.resample_report_rows(indexed.join(landed, "granule_id")), path)
    kinds = {"Source": "string", "StartDate": "string", "OrigPValid": "double", "PValid": "double"}
    longs = ("OrbitIndex", "OrigNTotal", "OrigNFlagged", "OrigNWater1", "OrigNWater2", "OrigNValid", "NTotal", "NValid")
    return reports.read_report(spark, path, ", ".join(f"{c} {kinds.get(c, 'bigint' if c in longs else 'int')}" for c in reports.RESAMPLE_REPORT))


@query("s07_complete_rows", """
    select granule_id, y, x, rrs443 as rrs442_5, rrs490 from obs where rrs443 is not null and rrs490 is not null
""", 12, ("rrs442_5", "rrs490"))
def _(spark, sf):
    checked = require_columns(view(spark, sf, "obs"), ["rrs442_5", "rrs490"], {"rrs442_5": "rrs443"})
    return complete_rows(checked, ["rrs442_5", "rrs490"]).select("granule_id", "y", "x", "rrs442_5", "rrs490")


_SOURCES = """
    select obs_date, granule_id,
      case when granule_id % 5 = 0 then 'my' when granule_id % 5 = 1 then 'other' else 'myint' end as source,
      y_min DIV 100 as band
    from granules
"""


@query("s08_pick_source", f"""
    select obs_date, band, source, granule_id from (
      select *, row_number() over (partition by obs_date, band
        order by case source when 'my' then 1 else 2 end, granule_id) as rn
      from ({_SOURCES.replace(' DIV ', ' // ')}) as s where source <> 'other') as r where rn = 1
""")
def _(spark, sf):
    g = view(spark, sf, "granules")
    src = g.select(
        "obs_date", "granule_id",
        F.when(F.col("granule_id") % 5 == 0, "my").when(F.col("granule_id") % 5 == 1, "other")
        .otherwise("myint").alias("source"),
        F.floor(F.col("y_min") / 100).cast("int").alias("band"),
    )
    return catalogue.pick_source(src, ["obs_date", "band"], tie=["granule_id"])


@query("s09_missing_dates", """
    select cast(d as date) as obs_date from range(date '2023-12-20', date '2024-02-16', interval 1 day) as r(d)
    where cast(d as date) not in (select cast(ts as date) from events)
""")
def _(spark, sf):
    return catalogue.missing_dates(table(spark, sf, "events").select(F.col("ts").cast("date").alias("obs_date")),
                                   "obs_date", "2023-12-20", "2024-02-15")


@query("s10_month_inputs", """
    select cast(date_trunc('month', obs_date) as date) as month, count(*) as n_all,
      cast(sum(case when timeliness = 'NT' then 1 else 0 end) as bigint) as n_timely,
      max(day(last_day(obs_date))) as days
    from granules group by 1
""")
def _(spark, sf):
    return catalogue.month_inputs(view(spark, sf, "granules"), "NT").withColumn("days", F.col("days").cast("bigint"))


_MONTHLY_LINES = """
    select cast(date_trunc('month', l_shipdate) as date) as month, count(*) as n_now,
      cast(sum(case when l_linestatus = 'O' or month(l_shipdate) % 2 = 0 then 1 else 0 end) as bigint) as n_stored
    from lineitem group by 1
"""


@query("s11_months_to_recompute", f"""
    select month, n_now, case when year(month) <> 1997 then n_stored end as n_stored
    from ({_MONTHLY_LINES}) as c
    where n_now is distinct from (case when year(month) <> 1997 then n_stored end)
""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("month", F.trunc(F.col("l_shipdate").cast("date"), "month"))
    now = li.groupBy("month").agg(F.count(F.lit(1)).alias("n_timely"))
    kept = (F.col("l_linestatus") == "O") | (F.month("l_shipdate") % 2 == 0)
    then = li.where(F.year("month") != 1997).groupBy("month").agg(F.count_if(kept).alias("n_timely"))
    return catalogue.months_to_recompute(now, then)


@query("s12_pending_dates", """
    select distinct obs_date from daily
    where obs_date not in (select cast(o_orderdate as date) from orders where o_orderstatus = 'F' and o_orderpriority like '1%')
""")
def _(spark, sf):
    done = table(spark, sf, "orders").where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").startswith("1"))
    wanted = view(spark, sf, "daily").select("obs_date").distinct()
    return catalogue.pending_dates(wanted, done.select(F.col("o_orderdate").cast("date").alias("obs_date")))
