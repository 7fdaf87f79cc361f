"""Chain C: archive to climatology to quality index."""

from __future__ import annotations

from pyspark.sql import DataFrame

from chromasea.operators.climatology import climatology, quality_index
from chromasea.session import materialise


def climatology_table(daily: DataFrame, col: str, ny: int, nx: int, years: tuple[int, int] | None = None,
                      log: bool = True, name: str = "climatology") -> DataFrame:
    """The climatology written once to shared storage, for many later look-ups."""
    return materialise(climatology(daily, col, ny, nx, log=log, years=years), name)


def archive_quality(daily: DataFrame, col: str, ny: int, nx: int, years: tuple[int, int] | None = None,
                    log: bool = True) -> DataFrame:
    """Quality index of every day of an archive against its own climatology."""
    return quality_index(daily, climatology_table(daily, col, ny, nx, years, log), col, log)
