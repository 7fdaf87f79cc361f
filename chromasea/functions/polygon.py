"""Footprint tests on `array<struct<lon,lat>>` columns (G-13, G-14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _edges(polygon: Column) -> Column:
    """Edges as structs (a, b), closing the ring."""
    following = F.concat(F.slice(polygon, 2, F.size(polygon)), F.slice(polygon, 1, 1))
    return F.zip_with(polygon, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _inside(lon: Column, lat: Column, polygon: Column) -> Column:
    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        straddles = (a["lat"] > lat) != (b["lat"] > lat)
        reach = a["lon"] + (b["lon"] - a["lon"]) * F.try_divide(lat - a["lat"], b["lat"] - a["lat"])
        return straddles & (lon < reach)

    return F.size(F.filter(_edges(polygon), crosses)) % 2 == 1


def point_in_polygon(lon: Column, lat: Column, polygon: Column) -> Column:
    """G-13. 1 if the point lies within the footprint, 0 if not, -1 without footprint."""
    return (
        F.when(polygon.isNull() | (F.size(polygon) == 0), -1)
        .when(_inside(lon, lat, polygon), 1)
        .otherwise(0)
    )


def polygon_meets_box(polygon: Column, south: Column, north: Column, west: Column, east: Column) -> Column:
    """G-14. 1 if the footprint meets the latitude/longitude box, 0 if not, -1 without footprint.

    They meet if a vertex lies in the box, a corner of the box lies in the
    footprint, or an edge passes through the box (clipping the edge parameter
    by the four sides leaves an interval).
    """
    vertex_in = F.exists(polygon, lambda p: p["lat"].between(south, north) & p["lon"].between(west, east))
    corner_in = reduce(
        lambda a, b: a | b, [_inside(lo, la, polygon) for lo in (west, east) for la in (south, north)]
    )

    def passes(e: Column) -> Column:
        def span(start: Column, stop: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
            step = stop - start
            t0, t1 = F.try_divide(lo - start, step), F.try_divide(hi - start, step)
            level = start.between(lo, hi)
            return (
                F.when(step == 0, F.when(level, 0.0).otherwise(2.0)).otherwise(F.least(t0, t1)),
                F.when(step == 0, F.when(level, 1.0).otherwise(-1.0)).otherwise(F.greatest(t0, t1)),
            )

        enter_x, leave_x = span(e["a"]["lon"], e["b"]["lon"], west, east)
        enter_y, leave_y = span(e["a"]["lat"], e["b"]["lat"], south, north)
        return F.greatest(enter_x, enter_y, F.lit(0.0)) <= F.least(leave_x, leave_y, F.lit(1.0))

    return (
        F.when(polygon.isNull() | (F.size(polygon) == 0), -1)
        .when(vertex_in | corner_in | F.exists(_edges(polygon), passes), 1)
        .otherwise(0)
    )
