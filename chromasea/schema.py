"""Canonical schemas and the checks at the boundary to outside data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: fill value and the names of the reflectance variables ---
FILL = -999.0
BANDS = (400.0, 412.5, 442.5, 490.0, 510.0, 560.0, 620.0, 665.0, 673.75, 681.25, 708.75)
# --- end of fixed values ---

_D, _I, _L, _S = T.DoubleType(), T.IntegerType(), T.LongType(), T.StringType()


def band_column(wavelength: float) -> str:
    """`rrs412_5` for 412.5: the lower-case form of the band naming rule."""
    return "rrs" + f"{wavelength:g}".replace(".", "_")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


POLYGON = T.ArrayType(_struct(("lon", _D), ("lat", _D)))
PIXEL = _struct(
    ("granule_id", _S), ("platform", _S), ("obs_date", T.DateType()), ("y", _I), ("x", _I),
    ("lat", _D), ("lon", _D), ("flags", _L), ("mask", _I),
    *((band_column(b), _D) for b in BANDS),
    ("kd490", _D), ("oza", _D), ("oaa", _D), ("sza", _D), ("saa", _D),
)
GRANULE = _struct(
    ("granule_id", _S), ("name", _S), ("platform", _S), ("start_ts", T.TimestampType()),
    ("stop_ts", T.TimestampType()), ("rel_orbit", _I), ("granule_index", _I), ("orbit_bit", _L),
    ("timeliness", _S), ("collection", _S), ("resolution", _S), ("y_min", _I), ("y_max", _I),
    ("x_min", _I), ("x_max", _I), ("n_total", _L), ("n_valid", _L), ("p_valid", _D), ("polygon", POLYGON),
)
MONTHLY = _struct(
    ("month", T.DateType()), ("y", _I), ("x", _I), ("value", _D), ("value_count", _L),
    ("value_error", _D), ("value_std", _D),
)
CLIM = _struct(
    ("mmdd", _S), ("y", _I), ("x", _I), ("w_avg", _D), ("n_avg", _D), ("diff_n_w", _D), ("n_std", _D),
    ("w_std", _D), ("sum_w", _D), ("porc_w", _D), ("median", _D), ("min", _D), ("max", _D), ("nofobs", _L),
)
GRID = _struct(("y", _I), ("x", _I), ("lat", _D), ("lon", _D), ("sensormask", _I))


def require_columns(df: DataFrame, names: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """S-07. Fail early if a variable is missing, after renaming known aliases.

    `aliases` maps a wanted name to the column that may stand in for it.
    """
    have = set(df.columns)
    for wanted, other in (aliases or {}).items():
        if wanted not in have and other in have:
            df = df.withColumnRenamed(other, wanted)
            have = have - {other} | {wanted}
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"missing variables: {', '.join(missing)}")
    return df


def complete_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """S-07. Keep catalogue rows whose required attributes are all present."""
    return df.dropna(subset=list(names))


def fill_to_null(col: Column, fill: float = FILL) -> Column:
    """F-02. The fill value becomes NULL."""
    return F.when(col != F.lit(fill), col)


def null_to_fill(col: Column, fill: float = FILL) -> Column:
    """F-02. NULL becomes the fill value."""
    return F.coalesce(col, F.lit(fill))
