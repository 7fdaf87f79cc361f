"""Granule-name parts as Columns (S-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chromasea.functions.dates import GRANULE_TIME_FORMAT

# --- fixed values: positions of the parts of a granule name, split at "_" ---
PLATFORM_AT, START_AT, ORBIT_AT = 0, 7, 12
# --- end of fixed values ---


def name_part(name: Column, position: int) -> Column:
    """A part of the name, NULL if there are fewer."""
    return F.get(F.split(name, "_"), F.lit(position))


def name_platform(name: Column) -> Column:
    return name_part(name, PLATFORM_AT)


def name_start(name: Column) -> Column:
    return F.try_to_timestamp(name_part(name, START_AT), F.lit(GRANULE_TIME_FORMAT))


def name_orbit(name: Column) -> Column:
    """Relative orbit; -1 if it cannot be read."""
    return F.coalesce(name_part(name, ORBIT_AT).try_cast("int"), F.lit(-1))
