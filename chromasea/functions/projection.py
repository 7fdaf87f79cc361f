"""Polar stereographic projection as Column math (G-01 to G-03).

Formulas: J. P. Snyder, Map Projections - A Working Manual (1987), chapter 21.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import atan, cos, pi, radians, sin, sqrt, tan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.numeric import poly

# --- fixed values: ellipsoid, projections and named areas ---
SEMI_MAJOR = 6378137.0
ECC2 = 0.00669437999014
CENTRAL_MERIDIAN = -45.0
EARTH_RADIUS = 6370997.0
LAT_LIMIT = 65.0
PROJECTIONS = {"npsn": None, "polarn": 70.0, "polarn_orig": None}  # latitude of true scale
AREAS = {
    # name: projection, width, height, extent (x0, y0, x1, y1)
    "npsn": ("npsn", 7600, 11200, (-3850000, -5350000, 3750000, 5850000)),
    "npsn_a": ("npsn", 6625, 6625, (-3314693.24, -3314693.24, 3314693.24, 3314693.24)),
    "npsn_olci": ("npsn", 22098, 22098, (-3314693.24, -3314693.24, 3314693.24, 3314693.24)),
    "polar_stereographic": ("polarn", 18345, 18345, (-2751778, 2751778, 2751778, -2751778)),
    "polar_stereographic_orig": ("polarn_orig", 18915, 18915, (-2837300, -2837300, 2837200, 2837200)),
    "polar_stereographic_3km": ("polarn", 1892, 1892, (-2837300, -2837300, 2837200, 2837200)),
    "polar_stereographic_4km": ("polarn", 1375, 1375, (-2752500, 2747500, 2747500, -2752500)),
    "polar_stereographic_600m": ("polarn", 6000, 6000, (-2837300, -2837300, 2837200, 2837200)),
    "polar_stereographic_nerc": ("npsn", 609, 881, (-3800000, 5500000, 3800000, -5500000)),
}
# --- end of fixed values ---

_E = sqrt(ECC2)


def _t(lat: float) -> float:
    s = _E * sin(lat)
    return tan(pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


@dataclass(frozen=True)
class Area:
    """A target grid: projection, size in cells and extent in metres."""

    projection: str
    width: int
    height: int
    extent: tuple[float, float, float, float]

    @property
    def pixel_x(self) -> float:
        return (self.extent[2] - self.extent[0]) / self.width

    @property
    def pixel_y(self) -> float:
        """Negative where row 0 lies at the smallest Y."""
        return (self.extent[3] - self.extent[1]) / self.height

    @property
    def rho_scale(self) -> float:
        """Factor between the conformal half-angle t and the distance from the pole."""
        true_scale = PROJECTIONS[self.projection]
        if true_scale is None:
            return 2 * SEMI_MAJOR / sqrt((1 + _E) ** (1 + _E) * (1 - _E) ** (1 - _E))
        lat = radians(true_scale)
        return SEMI_MAJOR * cos(lat) / sqrt(1 - ECC2 * sin(lat) ** 2) / _t(lat)

    @property
    def max_scale(self) -> float:
        """Largest ratio of map to ground distance: it grows away from the pole, to the farthest corner."""
        x0, y0, x1, y1 = self.extent
        rho = max(abs(x0), abs(x1)) ** 2 + max(abs(y0), abs(y1)) ** 2
        t = sqrt(rho) / self.rho_scale
        chi = pi / 2 - 2 * atan(t)
        return sqrt(rho) / (SEMI_MAJOR * cos(chi) / sqrt(1 - ECC2 * sin(chi) ** 2))


def area(name: str) -> Area:
    """G-01. A named target grid."""
    return Area(*AREAS[name])


def lonlat_to_xy(lon: Column, lat: Column, target: Area) -> tuple[Column, Column]:
    """Forward projection to metres."""
    phi = F.radians(lat)
    s = F.lit(_E) * F.sin(phi)
    t = F.tan(F.lit(pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
    rho = t * F.lit(target.rho_scale)
    dlon = F.radians(lon - F.lit(CENTRAL_MERIDIAN))
    return rho * F.sin(dlon), -rho * F.cos(dlon)


def xy_to_lonlat(x: Column, y: Column, target: Area) -> tuple[Column, Column]:
    """Inverse projection to degrees, by the series for the conformal latitude."""
    t = F.sqrt(x * x + y * y) / F.lit(target.rho_scale)
    chi = F.lit(pi / 2) - 2 * F.atan(t)
    e2, e4, e6, e8 = ECC2, ECC2**2, ECC2**3, ECC2**4
    phi = (
        chi
        + F.lit(e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi)
        + F.lit(7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi)
        + F.lit(7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi)
        + F.lit(4279 * e8 / 161280) * F.sin(8 * chi)
    )
    lon = F.degrees(F.atan2(x, -y)) + F.lit(CENTRAL_MERIDIAN)
    wrapped = F.when(lon < -180, lon + 360).when(lon > 180, lon - 360).otherwise(lon)
    return wrapped, F.degrees(phi)


def lonlat_to_rowcol(lon: Column, lat: Column, target: Area) -> tuple[Column, Column]:
    """G-02. Fractional row and column; integers are cell centres."""
    x, y = lonlat_to_xy(lon, lat, target)
    row = (F.lit(float(target.extent[3])) - y) / F.lit(target.pixel_y) - 0.5
    col = (x - F.lit(float(target.extent[0]))) / F.lit(target.pixel_x) - 0.5
    return row, col


def rowcol_to_xy(row: Column, col: Column, target: Area) -> tuple[Column, Column]:
    """Projected metres of a cell centre."""
    x = F.lit(float(target.extent[0])) + (col + 0.5) * F.lit(target.pixel_x)
    y = F.lit(float(target.extent[3])) - (row + 0.5) * F.lit(target.pixel_y)
    return x, y


def rowcol_to_lonlat(row: Column, col: Column, target: Area) -> tuple[Column, Column]:
    """G-03. Longitude and latitude of a cell centre."""
    return xy_to_lonlat(*rowcol_to_xy(row, col, target), target)


def unit_vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """Position on the unit sphere, longitudes counted from the central meridian."""
    a, b = F.radians(lon - F.lit(CENTRAL_MERIDIAN)), F.radians(lat)
    return F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)


def with_cell_vector(df: DataFrame, row: str, col: str, target: Area, prefix: str = "_k") -> DataFrame:
    """Adds the unit vector of a cell centre as `{prefix}x`, `{prefix}y`, `{prefix}z`.

    The same inverse projection as `rowcol_to_lonlat`, but algebraic up to the
    small angle between conformal and geodetic latitude, and staged in named
    steps: it is evaluated once per candidate cell.
    """
    x, y = rowcol_to_xy(F.col(row), F.col(col), target)
    e2, e4, e6, e8 = ECC2, ECC2**2, ECC2**3, ECC2**4
    a = e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360
    b = 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520
    c = 7 * e6 / 120 + 81 * e8 / 1120
    d = 4279 * e8 / 161280
    g = F.col
    step = df.withColumns({"_cx": x, "_cy": y})
    step = step.withColumn("_rho", F.sqrt(g("_cx") * g("_cx") + g("_cy") * g("_cy")))
    step = step.withColumn("_t", g("_rho") / F.lit(target.rho_scale))
    step = step.withColumn("_den", 1 + g("_t") * g("_t"))
    step = step.withColumns({"_sin": (1 - g("_t") * g("_t")) / g("_den"), "_cos": 2 * g("_t") / g("_den")})
    step = step.withColumns({"_s2": 2 * g("_sin") * g("_cos"), "_c2": 1 - 2 * g("_sin") * g("_sin")})
    series = poly(g("_c2"), (a - c, 2 * b - 4 * d, 4 * c, 8 * d))
    step = step.withColumn("_delta", g("_s2") * series)
    step = step.withColumns({"_cd": F.cos("_delta"), "_sd": F.sin("_delta")})
    step = step.withColumn("_par", g("_cos") * g("_cd") - g("_sin") * g("_sd"))
    at_pole = g("_rho") == 0
    return step.withColumns({
        f"{prefix}x": F.when(at_pole, 0.0).otherwise(g("_par") * F.try_divide(-g("_cy"), g("_rho"))),
        f"{prefix}y": F.when(at_pole, 0.0).otherwise(g("_par") * F.try_divide(g("_cx"), g("_rho"))),
        f"{prefix}z": g("_sin") * g("_cd") + g("_cos") * g("_sd"),
    }).drop("_cx", "_cy", "_rho", "_t", "_den", "_sin", "_cos", "_s2", "_c2", "_delta", "_cd", "_sd", "_par")


def chord_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = EARTH_RADIUS) -> Column:
    """Straight-line distance in metres between two points on a sphere."""
    a, b, c, d = F.radians(lon1), F.radians(lat1), F.radians(lon2), F.radians(lat2)
    dx = F.cos(b) * F.cos(a) - F.cos(d) * F.cos(c)
    dy = F.cos(b) * F.sin(a) - F.cos(d) * F.sin(c)
    dz = F.sin(b) - F.sin(d)
    return F.lit(radius) * F.sqrt(dx * dx + dy * dy + dz * dz)
