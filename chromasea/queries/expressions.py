"""Queries for per-pixel expressions, flags, dates and strings (F-01 to F-39, O-02, U-03)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chromasea.functions import dates, flags, numeric, reflectance
from chromasea.operators import grid, quality
from chromasea.queries.base import query, table, view
from chromasea.schema import fill_to_null, null_to_fill
from chromasea.session import scratch_path
from chromasea.sources import catalogue
from chromasea.sources.models import SCHEMA, model_elements

# Toy catalogue of the fixture pixels.
FLAGS = {"WATER": 2, "LAND": 4, "CLOUD": 8, "HIGHGLINT": 65536}
MASKING = ("LAND", "CLOUD", "HIGHGLINT")
BANDS5 = ("rrs443", "rrs490", "rrs510", "rrs560", "rrs665")


@query("f01_to_rrs", """
    select granule_id, y, x, case when granule_id % 2 = 1 then rrs560 / pi() else rrs560 end as rrs
    from obs
""", 11, ("rrs",))
def _(spark, sf):
    collection = F.when(F.col("granule_id") % 2 == 1, 3).otherwise(4)
    return view(spark, sf, "obs").select(
        "granule_id", "y", "x", reflectance.to_rrs(F.col("rrs560"), collection).alias("rrs"))


@query("f02_fill_null", """
    select granule_id, y, x, coalesce(rrs443, -999e0) as filled, rrs443 as back from obs
""", 12, ("filled", "back"))
def _(spark, sf):
    filled = view(spark, sf, "obs").withColumn("filled", null_to_fill(F.col("rrs443")))
    return filled.select("granule_id", "y", "x", "filled", fill_to_null(F.col("filled")).alias("back"))


@query("f03_decode_log10", """
    select l_orderkey, l_linenumber, power(10e0, l_discount * 20 - 1.3) as kd from lineitem
""", 10, ("kd",))
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", reflectance.decode_log10(F.col("l_discount") * 20 - 1.3).alias("kd"))


@query("f04_clip_range", """
    select granule_id, y, x,
      case when rrs443 * 4 - 0.011 between -0.0046 and 1 then rrs443 * 4 - 0.011 end as rrs443,
      case when rrs665 * 30 - 0.0025 between -0.00083 and 1 then rrs665 * 30 - 0.0025 end as rrs665
    from obs
""", 12, ("rrs443", "rrs665"))
def _(spark, sf):
    o = view(spark, sf, "obs")
    return o.select(
        "granule_id", "y", "x", reflectance.clip_band(F.col("rrs443") * 4 - 0.011, 442.5).alias("rrs443"),
        reflectance.clip_band(F.col("rrs665") * 30 - 0.0025, 665.0).alias("rrs665"))


@query("f05_clip_product", """
    select obs_date, y, x, case when chl * 30 - 5 between 0.003 and 100 then chl * 30 - 5 end as chl,
      case when chl * 50 - 2 between 0 and 100 then chl * 50 - 2 end as kd490
    from daily
""", 8, ("chl", "kd490"))
def _(spark, sf):
    d = view(spark, sf, "daily")
    return d.select("obs_date", "y", "x", reflectance.clip_product(F.col("chl") * 30 - 5, "chl").alias("chl"),
                    reflectance.clip_product(F.col("chl") * 50 - 2, "kd490").alias("kd490"))


_BAND_VALUES = ", ".join(f"({b})" for b in reflectance.BANDS)


@query("f06_nearest_band", f"""
    select l_orderkey, l_linenumber,
      (select min(b) from (values {_BAND_VALUES}) as t(b) where abs(b - (400.25 + l_quantity * 6.5)) < 1) as band
    from lineitem
""", 4, ("band",))
def _(spark, sf):
    wl = F.lit(400.25) + F.col("l_quantity") * 6.5
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", reflectance.nearest_band_col(wl).alias("band"))


@query("f07_select_bands", """
    select granule_id, y, x, rrs443 as rrs442_5, rrs560 from obs
""", 12, ("rrs442_5", "rrs560"))
def _(spark, sf):
    names = {442.5: "rrs443", 490.0: "rrs490", 510.0: "rrs510", 560.0: "rrs560", 665.0: "rrs665"}
    chosen = [reflectance.nearest_band(w, tuple(names)) for w in (442.0, 559.5)]
    o = view(spark, sf, "obs")
    return o.select("granule_id", "y", "x", *[
        F.col(names[b]).alias("rrs" + f"{b:g}".replace(".", "_")) for b in chosen])


@query("f08_flag_code", """
    select granule_id, cast(bit_or(flags) as bigint) as seen, 65548 as code from obs group by 1
""")
def _(spark, sf):
    code = flags.flag_code(FLAGS, MASKING)
    return view(spark, sf, "obs").groupBy("granule_id").agg(F.bit_or("flags").alias("seen")).withColumn(
        "code", F.lit(code).cast("int"))


@query("f09_flag_mask", """
    select granule_id, y, x, flags & 65548 as masked, (flags & 12) <> 0 as land_or_cloud from obs
""")
def _(spark, sf):
    f = F.col("flags")
    return view(spark, sf, "obs").select(
        "granule_id", "y", "x", flags.flag_mask(f, flags.flag_code(FLAGS, MASKING)).alias("masked"),
        (flags.flag_mask(f, flags.flag_code(FLAGS, ["LAND", "CLOUD"])) != 0).alias("land_or_cloud"))


@query("f10_flag_decode", """
    select granule_id, y, x, concat_ws(' ', case when flags & 2 <> 0 then 'WATER' end,
        case when flags & 4 <> 0 then 'LAND' end, case when flags & 8 <> 0 then 'CLOUD' end,
        case when flags & 65536 <> 0 then 'HIGHGLINT' end) as names,
      cast(sign(flags & 2) as integer) * 1000 + cast(sign(flags & 4) as integer) * 100
        + cast(sign(flags & 8) as integer) * 10 + cast(sign(flags & 65536) as integer) as vector
    from obs
""")
def _(spark, sf):
    vector = flags.flag_vector(F.col("flags"), FLAGS)
    return view(spark, sf, "obs").select(
        "granule_id", "y", "x", F.concat_ws(" ", flags.flag_decode(F.col("flags"), FLAGS)).alias("names"),
        F.aggregate(vector, F.lit(0), lambda a, b: a * 10 + b).alias("vector"))


@query("f11_general_mask", "select granule_id, y, x, (flags * 77) & 1023 as general from obs")
def _(spark, sf):
    return view(spark, sf, "obs").select("granule_id", "y", "x", flags.general_mask(F.col("flags") * 77).alias("general"))


@query("f12_default_mask", """
    select granule_id, obs_date, y, x, mask_default from scene
""")
def _(spark, sf):
    mask = flags.default_mask(F.col("flags"), flags.flag_code(FLAGS, MASKING), [F.col(b) for b in BANDS5])
    return view(spark, sf, "obs").select("granule_id", "obs_date", "y", "x", mask.alias("mask_default"))


@query("f13_negative_mask", """
    select granule_id, y, x,
      case when mask_default = 1 or rrs443 < 0 or rrs665 - 0.0001 < 0 then 1 else 0 end as mask from scene
""")
def _(spark, sf):
    s = view(spark, sf, "scene")
    mask = flags.negative_mask(F.col("mask_default"), [F.col("rrs443"), F.col("rrs665") - 0.0001])
    return s.select("granule_id", "y", "x", mask.alias("mask"))


@query("f14_mask_non_positive", """
    select granule_id, obs_date, y, x, rrs443, rrs665 from obs
    where rrs443 > 0 and rrs490 > 0 and rrs510 > 0 and rrs560 > 0 and rrs665 > 0
""", 12, ("rrs443", "rrs665"))
def _(spark, sf):
    kept = view(spark, sf, "obs").where(flags.all_positive([F.col(b) for b in BANDS5]))
    return kept.select("granule_id", "obs_date", "y", "x", "rrs443", "rrs665")


_DOMAIN = "case when 60e0 + (y * 20 + x) * 0.07e0 >= 65 then 0 end"


@query("f15_apply_domain", f"""
    select obs_date, y, x, case when ({_DOMAIN}) is not null then chl end as chl from daily
""", 8, ("chl",))
def _(spark, sf):
    d = view(spark, sf, "daily")
    cells = d.select("y", "x").distinct().withColumn("lat", F.lit(60.0) + (F.col("y") * 20 + F.col("x")) * 0.07)
    domain = cells.withColumn("sensormask", F.when(F.col("lat") >= 65, F.lit(0)))
    return grid.apply_domain(d, domain, ["chl"])


@query("f16_screen_latitude", """
    select pt, granule_id from (select pt, pt // 2 as granule_id from swath_pts) as p
    where granule_id in (select pt // 2 from swath_pts group by 1 having max(lat - 10) >= 65)
""")
def _(spark, sf):
    s = view(spark, sf, "swath_pts").select(
        "pt", F.floor(F.col("pt") / 2).alias("granule_id"), (F.col("lat") - 10).alias("lat"))
    return quality.screen_latitude(s).select("pt", "granule_id")


@query("f17_screen_valid", "select granule_id, n_valid from granules where n_valid > 250")
def _(spark, sf):
    return quality.screen_valid(view(spark, sf, "granules"), 250).select("granule_id", "n_valid")


@query("f18_tile_key", """
    select y // 6 as tile_y, x // 7 as tile_x, least(y // 6 * 6 + 6, 20) as y1, least(x // 7 * 7 + 7, 20) as x1,
      count(*) as n
    from obs group by all
""")
def _(spark, sf):
    tile = reflectance.tile_key(F.col("y"), F.col("x"), 6, 7)
    limits = reflectance.tile_limits(F.col("y"), F.col("x"), 6, 7, 20, 20)
    return view(spark, sf, "obs").select(
        tile["tile_y"].alias("tile_y"), tile["tile_x"].alias("tile_x"), limits["y1"].alias("y1"),
        limits["x1"].alias("x1")).groupBy("tile_y", "tile_x", "y1", "x1").agg(F.count(F.lit(1)).alias("n"))


@query("f19_product_ratio", """
    select granule_id, y, x, rrs490 / nullif(case when oza > 40 then 0 else rrs560 end, 0) as ratio from obs
""", 10, ("ratio",))
def _(spark, sf):
    b = F.when(F.col("oza") > 40, 0.0).otherwise(F.col("rrs560"))
    return view(spark, sf, "obs").select("granule_id", "y", "x", numeric.product_ratio(F.col("rrs490"), b).alias("ratio"))


@query("f20_byte_roundtrip", """
    select obs_date, y, x, code, case when code <> 255 then power(10e0, code * 0.0151e0 - 2.1e0) end as decoded,
      chl / nullif(case when code <> 255 then power(10e0, code * 0.0151e0 - 2.1e0) end, 0) as ratio
    from (select *, case when chl > 0 then cast(least(greatest(ceil(
        (log10(case when chl > 0 then chl else 1 end) + 2.1e0) / 0.0151e0), 0), 254) as integer) else 255 end as code
      from daily) as d
""", 9, ("decoded", "ratio"))
def _(spark, sf):
    d = view(spark, sf, "daily").withColumn("code", numeric.byte_encode(F.col("chl"), 0.0151, -2.1))
    d = d.withColumn("decoded", numeric.byte_decode(F.col("code"), 0.0151, -2.1))
    return d.select("obs_date", "y", "x", "code", "decoded",
                    numeric.product_ratio(F.col("chl"), F.col("decoded")).alias("ratio"))


@query("f21_hour_window", """
    select event_type as region, count(*) as n from events
    where hour(ts) >= 10 and hour(ts + interval 45 minute) <= 14 group by 1
""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumns(
        {"first": F.col("ts"), "last": F.col("ts") + F.expr("interval 45 minutes")})
    hit = quality.hour_window(e, "first", "last", 10, 14)
    return hit.groupBy(F.col("event_type").alias("region")).agg(F.count(F.lit(1)).alias("n"))


@query("f22_overlay_attributes", """
    select granule_id,
      case when platform = 'S3B' and timeliness = 'NT' then 'multi' when timeliness = 'NR' then 'near' else 'base' end
        as title,
      case when timeliness = 'NR' then 'L3-NR' else 'L3' end as level, 'polar' as region,
      case when platform = 'S3B' and timeliness = 'NT' then 4 when timeliness = 'NR' then 3 else 3 end as n
    from granules
""")
def _(spark, sf):
    g = view(spark, sf, "granules").select(
        "granule_id", "timeliness", F.col("platform").alias("sensor"), F.lit("rrs").alias("product"),
        F.create_map(F.lit("title"), F.lit("base"), F.lit("region"), F.lit("polar"), F.lit("level"), F.lit("L3"))
        .alias("attributes"))
    rules = [
        {"timeliness": "NR", "set": {"title": "near", "level": "L3-NR"}},
        {"timeliness": "NT", "sensor": "S3B", "product": "rrs", "set": {"title": "multi", "note": "later rule"}},
        {"product": "other", "set": {"title": "never"}},
    ]
    a = F.col("attributes")
    return catalogue.overlay_attributes(g, rules).select(
        "granule_id", a["title"].alias("title"), a["level"].alias("level"), a["region"].alias("region"),
        F.size(a).alias("n"))


# Rules from a table, some hundreds of them, each with some of the conditions.
_RULES = """(select p_partkey as position,
      case when p_partkey % 3 = 0 then concat('p', p_partkey % 5) end as product,
      case when p_partkey % 2 = 0 then case when p_partkey % 8 < 4 then 'NT' else 'NR' end end as timeliness,
      case when p_partkey % 5 < 2 then concat('S3', case when p_partkey % 11 < 6 then 'A' else 'B' end) end as sensor,
      concat('k', p_partkey % 13) as k, concat('v', p_partkey) as v
    from {part} where p_partkey % 7 <> 6)"""
_SCENES = """(select granule_id, timeliness, platform as sensor, case when granule_id % 6 < 5 then concat('p', granule_id % 6) end as product from granules)"""


@query("f22_rules_table", f"""
    with c as (select distinct product, timeliness, sensor from {_SCENES} as s),
      w as (select c.*, r.k, arg_max(r.v, r.position) as v from c join {_RULES.replace('{part}', 'part')} as r
        on (r.product is null or r.product = c.product) and (r.timeliness is null or r.timeliness = c.timeliness)
          and (r.sensor is null or r.sensor = c.sensor) group by all)
    select s.granule_id, coalesce(max(v) filter (where k = 'k0'), 'base') as k0, max(v) filter (where k = 'k3') as k3, max(v) filter (where k = 'k12') as k12,
      cast(count(k) + cast(count(*) filter (where k = 'k0') = 0 as integer) + 1 as integer) as n
    from {_SCENES} as s left join w on w.product is not distinct from s.product and w.timeliness = s.timeliness and w.sensor = s.sensor
    group by 1
""")
def _(spark, sf):
    rules = spark.sql(f"select position, product, timeliness, sensor, map(k, v) as set from {_RULES}", part=table(spark, sf, "part"))
    scenes = spark.sql(f"select * from {_SCENES.replace('from granules', 'from {granules}')}", granules=view(spark, sf, "granules"))
    based = scenes.withColumn("attributes", F.create_map(F.lit("k0"), F.lit("base"), F.lit("own"), F.lit("x")))
    a = F.col("attributes")
    return catalogue.overlay_attributes(based, rules).select(
        "granule_id", *[F.try_element_at(a, F.lit(k)).alias(k) for k in ("k0", "k3", "k12")], F.size(a).alias("n"))


# Every flag of either collection has a bit of its own here.
_NAMES = sorted({n for names in flags.MASK_FLAGS.values() for n in names} | {"WATER", "INLAND_WATER"})
_BITS = {n: 1 << (2 * i if i < 31 else 63) for i, n in enumerate(_NAMES)}
_WORD = "cast((l_orderkey * 2654435761 + l_partkey * 40503 + l_linenumber) % 4611686018427387904 as bigint)"


@query("f12_collection_masks", f"""
    select l_orderkey, l_linenumber,
      {', '.join(f"case when w & {sum(_BITS[n] for n in names)} <> 0 or l_quantity > 45 then 1 else 0 end as mask_{c}" for c, names in flags.MASK_FLAGS.items())}
    from (select *, {_WORD} as w from lineitem) as l
""")
def _(spark, sf):
    """The default mask with the whole flag lists of both collections."""
    pixels = table(spark, sf, "lineitem").withColumn("w", F.expr(_WORD)).withColumn("band", F.when(F.col("l_quantity") <= 45, 0.01))
    return pixels.select("l_orderkey", "l_linenumber", *[
        flags.default_mask(F.col("w"), flags.flag_code(_BITS, names), [F.col("band")]).alias(f"mask_{c}") for c, names in flags.MASK_FLAGS.items()])


@query("f30_doy", """
    select o_orderkey, strftime(o_orderdate, '%Y%j') as doy, cast(o_orderdate as date) as back,
      dayofyear(o_orderdate) as n from orders
""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumn("doy", dates.doy_format(F.col("o_orderdate").cast("date")))
    return o.select("o_orderkey", "doy", dates.doy_parse(F.col("doy")).alias("back"),
                    F.dayofyear("o_orderdate").cast("bigint").alias("n"))


@query("f31_epoch1981", """
    select event_id, cast(floor(epoch(ts)) as bigint) - 347155200 as seconds,
      cast(floor(epoch(ts)) as bigint) as back from events
""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("seconds", dates.to_epoch1981(F.col("ts")))
    return e.select("event_id", "seconds", F.unix_seconds(dates.from_epoch1981(F.col("seconds"))).alias("back"))


@query("f32_month_name", """
    select o_orderkey, 'C' || strftime(date_trunc('month', o_orderdate), '%Y%j') || strftime(last_day(o_orderdate), '%j')
      || '-chl_monthly' as name from orders
""")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_name(F.col("o_orderdate").cast("date"), "C", "chl").alias("name"))


_DATE_TEXT = """
    select event_id, cast(ts as date) as ref,
      case when event_id % 4 = 0 then strftime(ts, '%Y-%m-%d') when event_id % 4 = 1 then cast(-(event_id % 30) as varchar)
           when event_id % 4 = 2 then 'bad' else cast(event_id % 7 as varchar) end as start_text,
      case when event_id % 3 = 0 then cast(event_id % 9 as varchar) else 'none' end as end_text
    from events
"""


@query("f33_resolve_dates", f"""
    with t as ({_DATE_TEXT}), d as (
      select *, coalesce(try_cast(case when contains(start_text, '-') and length(start_text) = 10 then start_text end as date),
          ref + try_cast(start_text as integer)) as first_day,
        ref + try_cast(end_text as integer) as last_given from t)
    select event_id, first_day, case when first_day is null then null
      else greatest(coalesce(last_given, first_day) - first_day + 1, 0) end as n_days from d
""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("ref", F.col("ts").cast("date"))
    k = F.col("event_id") % 4
    text = (
        F.when(k == 0, F.date_format("ts", "yyyy-MM-dd")).when(k == 1, (-(F.col("event_id") % 30)).cast("string"))
        .when(k == 2, "bad").otherwise((F.col("event_id") % 7).cast("string"))
    )
    e = e.withColumn("start_text", text).withColumn(
        "end_text", F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 9).cast("string")).otherwise("none"))
    first = dates.resolve_date(F.col("start_text"), F.col("ref"))
    days = dates.resolve_range(F.col("start_text"), F.col("end_text"), F.col("ref"))
    return e.select("event_id", first.alias("first_day"),
                    F.when(first.isNotNull(), F.size(days)).cast("bigint").alias("n_days"))


@query("f34_month_to_process", """
    select o_orderkey,
      case when day(o_orderdate) < 8 then cast(date_trunc('month', o_orderdate) - interval 1 month as date) end as nr,
      case when day(o_orderdate) >= 8 then cast(date_trunc('month', o_orderdate) - interval 1 month as date) end as nt
    from orders
""")
def _(spark, sf):
    ref = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.month_to_process(ref, "NR").alias("nr"), dates.month_to_process(ref, "NT").alias("nt"))


@query("f35_audit_timestamps", """
    select event_id, cast(ts + interval 5 hour as date) = cast(ts as date) as time_ok,
      cast(epoch(cast(cast(ts as date) as timestamp)) as bigint) - 347155200 as fixed
    from events
""")
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("name_date"),
        dates.to_epoch1981(F.col("ts") + F.expr("interval 5 hours")).alias("stored_epoch"))
    return catalogue.fix_timestamps(catalogue.audit_timestamps(e)).select(
        "event_id", "time_ok", F.col("stored_epoch").alias("fixed"))


@query("f36_strings", """
    select event_id, 'C' || strftime(ts, '%Y%j') || '_x.nc' as file,
      'RRS' || case when event_id % 2 = 0 then '412_5' else '490' end as band, starts_with(event_type, 'p') as p
    from events
""")
def _(spark, sf):
    wl = F.when(F.col("event_id") % 2 == 0, 412.5).otherwise(490.0)
    return table(spark, sf, "events").select(
        "event_id", dates.fill_template("C$DATE$_x.nc", F.col("ts").cast("date")).alias("file"),
        dates.band_suffix(wl).alias("band"), F.startswith("event_type", F.lit("p")).alias("p"))


@query("f37_math", """
    select l_orderkey, l_linenumber, 1 - 0.5 * z + 0.25 * z * z - 0.125 * z * z * z as poly,
      case when z between -1 and 0 then 2 + (z + 1) * 3 when z between 0 and 2 then 5 - z * 0.5 end as interp,
      greatest(z, l_tax) as top
    from (select *, log10(l_quantity * l_discount + 0.05) as z from lineitem) as t
""", 9, ("poly", "interp", "top"))
def _(spark, sf):
    z = F.col("z")
    return table(spark, sf, "lineitem").withColumn("z", F.log10(F.col("l_quantity") * F.col("l_discount") + 0.05)).select(
        "l_orderkey", "l_linenumber", numeric.poly(z, (1.0, -0.5, 0.25, -0.125)).alias("poly"),
        numeric.interp_linear(z, (-1.0, 0.0, 2.0), (2.0, 5.0, 4.0)).alias("interp"),
        F.greatest(z, "l_tax").alias("top"))


@query("f38_arrays", """
    select vec_id, list_sum(list_transform(embedding, lambda v: cast(v as double) * cast(v as double))) as norm2,
      cast(len(list_filter(embedding, lambda v: v <> 0)) as integer) as nonzero
    from embeddings
""", 6, ("norm2",))
def _(spark, sf):
    e = table(spark, sf, "embeddings").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    zero = numeric.subtract(F.col("v"), F.transform("v", lambda x: F.lit(0.0)))
    return e.select("vec_id", numeric.dot(F.col("v"), F.col("v")).alias("norm2"),
                    numeric.count_nonzero(zero).alias("nonzero"))


@query("f39_json", """
    select event_id, cast(json_extract(props, '$.k') as bigint) as k from events
""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("f39_model_file", """
    select label as vector, i as element, value, (label - 4.5e0) * 0.01e0 as alpha, 0.5e0 + i as scale, i * 0.25e0 as beta
    from (select label, unnest(range(1, 65)) as i, unnest(list_transform(range(1, 65), lambda k: m[k])) as value
      from (select label, [""" + ", ".join(f"avg(embedding[{i}])" for i in range(1, 65)) + """] as m from embeddings group by label) as a) as b
""", 6, ("value",))
def _(spark, sf):
    """A model file of 64 predictors written from the mean vectors, read back and laid out again."""
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = e.groupBy("label", "i").agg(F.avg("v").alias("v")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("m"))
    rows = F.sort_array(F.collect_list(F.struct("label", F.col("m.v").alias("v"), ((F.col("label") - 4.5) * 0.01).alias("a"))))
    kernel = F.map_concat(
        F.create_map(F.lit("AlphaRQ"), F.lit("0.7"), F.lit("SigmaF"), F.lit("1.3")),
        F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.struct(F.concat(F.lit("LengthScale"), i.cast("string")), (i + 0.5).cast("string")))),
    )
    file = means.agg(rows.alias("r")).select(
        kernel.alias("Kernel"), F.col("r.v").alias("ActiveSetVectors"), F.col("r.a").alias("Alpha"), F.lit(0.1).alias("Sigma"),
        F.transform(F.sequence(F.lit(0), F.lit(64)), lambda i: i * 0.25).alias("Beta"), F.col("r.label").alias("labels"),
    )
    path = scratch_path(spark, "model")
    file.coalesce(1).write.json(path)
    kind = table(spark, sf, "embeddings").schema["label"].dataType.simpleString()
    models = spark.read.schema(f"{SCHEMA}, labels array<{kind}>").json(path)
    elements = model_elements(models)
    return elements.select(F.get("labels", (F.col("vector") - 1).cast("int")).alias("vector"), "element", "value", "alpha", "scale", "beta")


@query("o02_two_nearest", """
    select l_orderkey, l_linenumber, l_quantity,
      list_aggregate(list_slice(list_filter(bands, lambda b: abs(b - wl) = list_min(list_transform(bands, lambda c: abs(c - wl)))), 1, 2), 'string_agg', ',') as bands
    from (select *, 395e0 + l_quantity * 6.25e0 as wl,
      [400e0, 412.5e0, 442.5e0, 490e0, 510e0, 560e0, 620e0, 665e0, 673.75e0, 681.25e0, 708.75e0] as bands from lineitem) as t
""")
def _(spark, sf):
    wl = F.lit(395.0) + F.col("l_quantity") * 6.25
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.array_join(F.transform(reflectance.two_nearest(wl), lambda b: b.cast("string")), ",").alias("bands"))


@query("u03_merge_bands", """
    select o_orderkey, array_to_string(list_sort(list_distinct(a || b)), ',') as bands from (
      select l_orderkey as o_orderkey,
        list_sort(list_distinct(coalesce(list(l_linenumber) filter (where l_returnflag = 'A'), []))) as a,
        list_sort(list_distinct(coalesce(list(l_linenumber + 2) filter (where l_returnflag <> 'A'), []))) as b
      from lineitem group by 1) as t
""")
def _(spark, sf):
    # line numbers run from 1 to 7, which bounds the collected sets
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_set(F.when(F.col("l_returnflag") == "A", F.col("l_linenumber"))).alias("a"),
        F.collect_set(F.when(F.col("l_returnflag") != "A", F.col("l_linenumber") + 2)).alias("b"))
    return li.select("o_orderkey", F.array_join(reflectance.merge_bands(F.col("a"), F.col("b")), ",").alias("bands"))
