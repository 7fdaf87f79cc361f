"""Date and name builders (F-30 to F-36)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: file-name patterns and the time origin ---
DOY_FORMAT = "yyyyDDD"
GRANULE_TIME_FORMAT = "yyyyMMdd'T'HHmmss"
EPOCH = "1981-01-01"
# --- end of fixed values ---
EPOCH_UNIX = 347155200  # seconds from 1970 to EPOCH, UTC


def doy_parse(col: Column) -> Column:
    """F-30. `2019175` to a date; malformed text gives NULL."""
    return F.try_to_timestamp(col, F.lit(DOY_FORMAT)).cast("date")


def doy_format(col: Column) -> Column:
    """F-30. Date to `YYYYjjj`."""
    return F.date_format(col, DOY_FORMAT)


def to_epoch1981(col: Column) -> Column:
    """F-31. Seconds since 1981-01-01 UTC."""
    return F.unix_seconds(col.cast("timestamp")) - F.lit(EPOCH_UNIX)


def from_epoch1981(col: Column) -> Column:
    """F-31. Back to a timestamp."""
    return F.timestamp_seconds(col + F.lit(EPOCH_UNIX))


def month_start(col: Column) -> Column:
    """F-32. First day of the month."""
    return F.trunc(col, "month")


def month_name(date: Column, prefix: str, param: str, suffix: str = "") -> Column:
    """F-32. `{prefix}{YYYYjjj}{jjj}-{param}_monthly{suffix}` over the bounds of the month."""
    first, last = month_start(date), F.last_day(date)
    return F.concat(
        F.lit(prefix), doy_format(first), F.date_format(last, "DDD"), F.lit(f"-{param}_monthly{suffix}")
    )


def resolve_date(text: Column, ref: Column) -> Column:
    """F-33. `YYYY-mm-dd`, or an integer day offset from `ref`; anything else is NULL."""
    absolute = F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    return F.coalesce(absolute, F.date_add(ref, text.try_cast("int")))


def resolve_range(start: Column, end: Column, ref: Column) -> Column:
    """F-33. Every day from start to end, both included; the end defaults to the start."""
    first = resolve_date(start, ref)
    last = F.coalesce(resolve_date(end, ref), first)
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def month_to_process(ref: Column, timeliness: str) -> Column:
    """F-34. First day of the month before `ref`; NR only before the 8th, NT only from the 8th."""
    due = F.dayofmonth(ref) < 8 if timeliness == "NR" else F.dayofmonth(ref) >= 8
    return F.when(due, F.add_months(month_start(ref), -1))


def fill_template(template: str, date: Column) -> Column:
    """F-36. Replace `$DATE$` in a name template by `YYYYjjj`."""
    return F.replace(F.lit(template), F.lit("$DATE$"), doy_format(date))


def band_suffix(wavelength: Column) -> Column:
    """F-36. `412.5` to `RRS412_5`, `490.0` to `RRS490`."""
    text = F.regexp_replace(wavelength.cast("string"), r"\.0$", "")
    return F.concat(F.lit("RRS"), F.replace(text, F.lit("."), F.lit("_")))
