"""Queries for projection, resampling, tie points and footprints (G-01 to G-15)."""

from __future__ import annotations

from math import cos, pi, radians, sin, sqrt, tan

from pyspark.sql import Column
from pyspark.sql import functions as F

from chromasea.functions import polygon as poly
from chromasea.functions import projection as proj
from chromasea.operators import grid, resample
from chromasea.queries.base import query, table, view

# Toy target area: the extent of the 300 m grid in 40 x 40 cells.
TOY = proj.Area("polarn", 40, 40, (-2751778, 2751778, 2751778, -2751778))
RADIUS = 60_000.0
BITS = (24, 9)  # the fixture folds its running number into rows of 512

# --- the projection written out in SQL, for the counterparts only ---
_E2 = 0.00669437999014
_E = sqrt(_E2)


def _sql_t(lat: str) -> str:
    s = f"({_E!r} * sin(radians({lat})))"
    return f"(tan({pi / 4!r} - radians({lat}) / 2) / power((1 - {s}) / (1 + {s}), {_E / 2!r}))"


def _scale(area: proj.Area) -> float:
    if area.projection != "polarn":
        return 2 * 6378137.0 / sqrt((1 + _E) ** (1 + _E) * (1 - _E) ** (1 - _E))
    p = radians(70.0)
    tc = tan(pi / 4 - p / 2) / ((1 - _E * sin(p)) / (1 + _E * sin(p))) ** (_E / 2)
    return 6378137.0 * cos(p) / sqrt(1 - _E2 * sin(p) ** 2) / tc


def sql_rowcol(lon: str, lat: str, area: proj.Area) -> tuple[str, str]:
    x0, y0, x1, y1 = area.extent
    rho = f"({_scale(area)!r} * {_sql_t(lat)})"
    row = f"(({float(y1)!r} + {rho} * cos(radians({lon} + 45))) / {(y1 - y0) / area.height!r} - 0.5)"
    col = f"(({rho} * sin(radians({lon} + 45)) - ({float(x0)!r})) / {(x1 - x0) / area.width!r} - 0.5)"
    return row, col


def sql_lonlat(row: str, col: str, area: proj.Area) -> tuple[str, str]:
    x0, y0, x1, y1 = area.extent
    x = f"({float(x0)!r} + ({col} + 0.5) * {(x1 - x0) / area.width!r})"
    y = f"({float(y1)!r} - ({row} + 0.5) * {(y1 - y0) / area.height!r})"
    chi = f"({pi / 2!r} - 2 * atan(sqrt({x} * {x} + {y} * {y}) / {_scale(area)!r}))"
    c2 = _E2 / 2 + 5 * _E2**2 / 24 + _E2**3 / 12 + 13 * _E2**4 / 360
    c4 = 7 * _E2**2 / 48 + 29 * _E2**3 / 240 + 811 * _E2**4 / 11520
    c6 = 7 * _E2**3 / 120 + 81 * _E2**4 / 1120
    c8 = 4279 * _E2**4 / 161280
    lat = (f"degrees({chi} + {c2!r} * sin(2 * {chi}) + {c4!r} * sin(4 * {chi}) + {c6!r} * sin(6 * {chi})"
           f" + {c8!r} * sin(8 * {chi}))")
    raw = f"(degrees(atan2({x}, -({y}))) - 45)"
    return f"(case when {raw} < -180 then {raw} + 360 else {raw} end)", lat


def sql_chord(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a, b, c, d = (f"radians({v})" for v in (lon1, lat1, lon2, lat2))
    return (f"6370997.0 * sqrt(power(cos({b}) * cos({a}) - cos({d}) * cos({c}), 2)"
            f" + power(cos({b}) * sin({a}) - cos({d}) * sin({c}), 2) + power(sin({b}) - sin({d}), 2))")


_ROW, _COL = sql_rowcol("lon", "lat", TOY)
_AREA_NAMES = sorted(proj.AREAS)
_AREA_SQL = " union all ".join(
    "select '{n}' as area, {w} as width, {h} as height, count(*) as n_inside from swath_pts "
    "where {r} between -0.5 and {h} - 0.5 and {c} between -0.5 and {w} - 0.5".format(
        n=n, w=proj.area(n).width, h=proj.area(n).height,
        r=sql_rowcol("lon", "lat", proj.area(n))[0], c=sql_rowcol("lon", "lat", proj.area(n))[1])
    for n in _AREA_NAMES
)


@query("g01_area_catalogue", _AREA_SQL)
def _(spark, sf):
    s = view(spark, sf, "swath_pts")
    inside = []
    for n in _AREA_NAMES:
        a = proj.area(n)
        row, col = proj.lonlat_to_rowcol(F.col("lon"), F.col("lat"), a)
        hit = row.between(-0.5, a.height - 0.5) & col.between(-0.5, a.width - 0.5)
        inside.append((n, a, F.count_if(hit).alias(n)))
    counts = s.agg(*[c for _, _, c in inside])
    rows = F.array(*[
        F.struct(F.lit(n).alias("area"), F.lit(a.width).alias("width"), F.lit(a.height).alias("height"),
                 F.col(n).alias("n_inside")) for n, a, _ in inside])
    return counts.select(F.inline(rows))


@query("g02_lonlat_to_rowcol", f"select pt, {_ROW} as row, {_COL} as col from swath_pts", 7, ("row", "col"))
def _(spark, sf):
    row, col = proj.lonlat_to_rowcol(F.col("lon"), F.col("lat"), TOY)
    return view(spark, sf, "swath_pts").select("pt", row.alias("row"), col.alias("col"))


_LON, _LAT = sql_lonlat("(pt % 397) / 10e0", "(pt % 383) / 10e0", proj.area("npsn_a"))


@query("g03_rowcol_to_lonlat", f"select pt, {_LON} as lon, {_LAT} as lat from swath_pts", 7, ("lon", "lat"))
def _(spark, sf):
    row, col = (F.col("pt") % 397) / 10.0, (F.col("pt") % 383) / 10.0
    lon, lat = proj.rowcol_to_lonlat(row, col, proj.area("npsn_a"))
    return view(spark, sf, "swath_pts").select("pt", lon.alias("lon"), lat.alias("lat"))


_GLON, _GLAT = sql_lonlat("y", "x", TOY)
_CELLS = f"""
    select y, x, {_GLAT} as lat, {_GLON} as lon
    from (select cast(a.i as integer) as y from range(40) as a(i)) as r
      cross join (select cast(b.i as integer) as x from range(40) as b(i)) as c
"""


@query("g04_grid", f"""
    select c.y, c.x, c.lat, c.lon, case when c.lat >= 65 then 0 end as sensormask, coalesce(n, 0) as n_points
    from ({_CELLS}) as c
    left join (select cast(round({_ROW}) as integer) as y, cast(round({_COL}) as integer) as x, count(*) as n
      from swath_pts group by 1, 2) as p on c.y = p.y and c.x = p.x
""", 7, ("lat", "lon"))
def _(spark, sf):
    row, col = proj.lonlat_to_rowcol(F.col("lon"), F.col("lat"), TOY)
    points = view(spark, sf, "swath_pts").groupBy(
        F.rint(row).cast("int").alias("y"), F.rint(col).cast("int").alias("x")
    ).agg(F.count(F.lit(1)).alias("n_points"))
    cells = grid.align(grid.make_grid(spark, TOY), points, ["y", "x"], "left")
    return cells.fillna(0, ["n_points"]).select("y", "x", "lat", "lon", "sensormask", "n_points")


_BOXES = f"""
    select granule_id, cast(greatest(floor(min({_ROW})), 0) as integer) as y_min,
      cast(least(ceil(max({_ROW})) + 1, 40) as integer) as y_max,
      cast(greatest(floor(min({_COL})), 0) as integer) as x_min,
      cast(least(ceil(max({_COL})) + 1, 40) as integer) as x_max
    from (select pt // 50 as granule_id, 77 + (lat - 77) * 0.1 as lat, (pt // 50) * 7 % 360 - 180 + lon * 0.02 as lon
      from swath_pts) as s group by 1
"""


def _small_granules(spark, sf):
    g = F.floor(F.col("pt") / 50)
    return view(spark, sf, "swath_pts").select(
        g.alias("granule_id"), (F.lit(77.0) + (F.col("lat") - 77) * 0.1).alias("lat"),
        (g * 7 % 360 - 180 + F.col("lon") * 0.02).alias("lon"))


@query("g05_granule_box", _BOXES)
def _(spark, sf):
    return grid.granule_box(_small_granules(spark, sf), TOY)


_CORNERS = [sql_lonlat(y, x, TOY) for y in ("y_min", "y_max") for x in ("x_min", "x_max")]


@query("g06_box_geo_limits", f"""
    select granule_id, least({', '.join(c[1] for c in _CORNERS)}) as lat_min,
      greatest({', '.join(c[1] for c in _CORNERS)}) as lat_max,
      least({', '.join(c[0] for c in _CORNERS)}) as lon_min,
      greatest({', '.join(c[0] for c in _CORNERS)}) as lon_max
    from ({_BOXES}) as b
""", 7, ("lat_min", "lat_max", "lon_min", "lon_max"))
def _(spark, sf):
    limits = grid.box_geo_limits(grid.granule_box(_small_granules(spark, sf), TOY), TOY)
    return limits.select("granule_id", "lat_min", "lat_max", "lon_min", "lon_max")


NEAREST = f"""
    select granule_id, y, x, distance, pt, v, mask_default from (
      select s.granule_id, c.y, c.x, s.pt, s.v, s.mask_default,
        {sql_chord('s.lon', 's.lat', 'c.lon', 'c.lat')} as distance,
        row_number() over (partition by s.granule_id, c.y, c.x
          order by {sql_chord('s.lon', 's.lat', 'c.lon', 'c.lat')}, s.pt) as rn
      from swath_pts as s join ({_CELLS}) as c on abs(s.lat - c.lat) < 1
      where {sql_chord('s.lon', 's.lat', 'c.lon', 'c.lat')} <= {RADIUS}) as n
    where rn = 1
"""


@query("g07_resample_nearest", f"select granule_id, y, x, distance, pt, v from ({NEAREST}) as q0", {"distance": 3})
def _(spark, sf):
    s = view(spark, sf, "swath_pts")
    return resample.resample_nearest(s, TOY, RADIUS, ["pt", "v"], bits=BITS)


_SWATH_BOX = f"""
    select granule_id, cast(greatest(floor(min({_ROW})), 0) as integer) as y_min,
      cast(least(ceil(max({_ROW})) + 1, 40) as integer) as y_max,
      cast(greatest(floor(min({_COL})), 0) as integer) as x_min,
      cast(least(ceil(max({_COL})) + 1, 40) as integer) as x_max
    from swath_pts group by 1
"""
_MASKED = f"""
    select b.granule_id, c.y, c.x, case when n.pt is null then null when n.mask_default = 0 then 1 else 0 end as mask
    from ({_SWATH_BOX}) as b
    join ({_CELLS}) as c on c.y >= b.y_min and c.y < b.y_max and c.x >= b.x_min and c.x < b.x_max
    left join ({NEAREST}) as n on n.granule_id = b.granule_id and n.y = c.y and n.x = c.x
    where b.granule_id in (select granule_id from ({NEAREST}) as k)
"""


def _mask(spark, sf):
    s = view(spark, sf, "swath_pts")
    return resample.resample_mask(s, grid.granule_box(s, TOY), TOY, RADIUS, bits=BITS)


@query("g08_resample_mask", _MASKED)
def _(spark, sf):
    return _mask(spark, sf)


@query("g09_resample_report", f"""
    select m.granule_id, cast(count(m.mask) as bigint) as resampled_n_total,
      cast(sum(m.mask) as bigint) as resampled_n_valid,
      100e0 * sum(m.mask) / count(m.mask) as resampled_p_valid, any_value(o.n_total) as n_total
    from ({_MASKED}) as m
    join (select granule_id, count(*) as n_total from swath_pts group by 1) as o on o.granule_id = m.granule_id
    group by 1
""", 8, ("resampled_p_valid",))
def _(spark, sf):
    counters = view(spark, sf, "swath_pts").groupBy("granule_id").agg(F.count(F.lit(1)).alias("n_total"))
    return resample.resample_report(_mask(spark, sf), counters)


@query("g10_overlay_tiles", """
    select y, x, arg_max(rrs443, tile) filter (where rrs443 is not null) as rrs443, arg_max(rrs560, tile) as rrs560
    from (select y, x, granule_id % 7 as tile, avg(rrs443) as rrs443, avg(rrs560) as rrs560
      from obs group by 1, 2, 3) as t
    group by 1, 2
""", 11, ("rrs443", "rrs560"))
def _(spark, sf):
    o = view(spark, sf, "obs").withColumn("tile", F.col("granule_id") % 7)
    tiles = o.groupBy("y", "x", "tile").agg(
        F.avg("rrs443").alias("rrs443"), F.avg("rrs560").alias("rrs560"))
    return resample.overlay_tiles(tiles, "tile", ["rrs443", "rrs560"])


@query("g11_expand_axes", """
    select granule_id, cast(i as integer) as row, cast(j as integer) as col, lat0 + i * 0.5 as lat,
      lon0 + j * 0.25 as lon
    from footprints cross join range(4) as a(i) cross join range(3) as b(j)
""", 7, ("lat", "lon"))
def _(spark, sf):
    axes = view(spark, sf, "footprints").select(
        "granule_id", F.array(*[F.col("lat0") + k * 0.5 for k in range(4)]).alias("lat"),
        F.array(*[F.col("lon0") + k * 0.25 for k in range(3)]).alias("lon"))
    return grid.expand_axes(axes)


def _sql_bilinear(block: str) -> str:
    fi, fj = f"(({block} * 8 + 0.5) / 8)", "((row + 0.5) / 4)"
    i0 = f"least(greatest(cast(floor({fi}) as integer), 0), 4)"
    j0 = f"least(greatest(cast(floor({fj}) as integer), 0), 3)"

    def at(dj: int, di: int) -> str:
        return f"grid[({j0} + {dj}) * 6 + {i0} + {di} + 1]"

    wi, wj = f"({fi} - {i0})", f"({fj} - {j0})"
    return (f"({at(0, 0)} + {wi} * ({at(0, 1)} - {at(0, 0)}) + {wj} * ({at(1, 0)} - {at(0, 0)})"
            f" + {wi} * {wj} * ({at(1, 1)} + {at(0, 0)} - {at(0, 1)} - {at(1, 0)}))")


@query("g12_interpolate_tie", f"""
    select granule_id, row, col, pixel, line,
      v0 + (col - 8 * (col // 8)) * (v1 - v0) / 8e0 as oza
    from (select p.*, {_sql_bilinear('(col // 8)')} as v0, {_sql_bilinear('(col // 8 + 1)')} as v1
      from tie_pixels as p left join (
        select g.granule_id, list(t.oza order by g.k) as grid
        from (select granule_id, k from (select distinct granule_id from tie) cross join range(30) as r(k)) as g
        left join tie as t on t.granule_id = g.granule_id and t.j * 6 + t.i = g.k group by 1) as g
      on g.granule_id = p.granule_id) as q0
""", 8, ("oza",))
def _(spark, sf):
    return resample.interpolate_tie(view(spark, sf, "tie_pixels"), view(spark, sf, "tie"), 4, 8, ["oza"], (5, 6))


def _footprint() -> Column:
    pairs = [("lat0", "lon0", 0), ("lat0", "lon1", 0), ("lat1", "lon1", 1), ("lat1", "lon0", 1)]
    return F.array(*[
        F.struct((F.col(lon) + F.col("slant") * k).alias("lon"), F.col(lat).alias("lat")) for lat, lon, k in pairs])


@query("g13_point_in_polygon", """
    select granule_id, case when granule_id % 11 = 0 then -1
      when site_lat > lat0 and site_lat < lat1
        and site_lon - slant * (site_lat - lat0) / (lat1 - lat0) > lon0
        and site_lon - slant * (site_lat - lat0) / (lat1 - lat0) < lon1 then 1 else 0 end as inside
    from footprints
""")
def _(spark, sf):
    f = view(spark, sf, "footprints").withColumn("polygon", F.when(F.col("granule_id") % 11 != 0, _footprint()))
    return f.select("granule_id", poly.point_in_polygon(F.col("site_lon"), F.col("site_lat"), F.col("polygon")).alias("inside"))


@query("g14_polygon_meets_box", """
    select granule_id, case when granule_id % 11 = 0 then -1
      when greatest(lat0, south, lat0 + (west - lon1) * (lat1 - lat0) / slant)
        <= least(lat1, north, lat0 + (east - lon0) * (lat1 - lat0) / slant) then 1 else 0 end as meets
    from (select *, site_lat - 0.6 as south, site_lat + 0.35 as north, site_lon - 9 as west, site_lon - 2 as east
      from footprints) as f
""")
def _(spark, sf):
    f = view(spark, sf, "footprints").withColumn("polygon", F.when(F.col("granule_id") % 11 != 0, _footprint()))
    lat, lon = F.col("site_lat"), F.col("site_lon")
    meets = poly.polygon_meets_box(F.col("polygon"), lat - 0.6, lat + 0.35, lon - 9, lon - 2)
    return f.select("granule_id", meets.alias("meets"))


@query("g15_count_ocean", f"""
    select count(*) as n_ocean from ({_CELLS}) as c
    where lat >= 65 and (y, x) not in (select cast(l_partkey % 40 as integer), cast(l_orderkey % 40 as integer)
      from lineitem where l_quantity > 47)
""")
def _(spark, sf):
    land = table(spark, sf, "lineitem").where(F.col("l_quantity") > 47).select(
        (F.col("l_partkey") % 40).cast("int").alias("y"), (F.col("l_orderkey") % 40).cast("int").alias("x"))
    return grid.count_ocean(grid.make_grid(spark, TOY), land)
