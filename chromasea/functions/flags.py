"""Bit flags and pixel masks as Column expressions (F-08 to F-14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: flags that mask a pixel, per data collection ---
MASK_FLAGS = {
    3: ("LAND", "COASTLINE", "CLOUD", "CLOUD_AMBIGUOUS", "CLOUD_MARGIN", "INVALID", "COSMETIC", "SATURATED",
        "SUSPECT", "HISOLZEN", "HIGHGLINT", "SNOW_ICE", "AC_FAIL", "WHITECAPS", "RWNEG_O2", "RWNEG_O3",
        "RWNEG_O4", "RWNEG_O5", "RWNEG_O6", "RWNEG_O7", "RWNEG_O8"),
    4: ("LAND", "COASTLINE", "CLOUD", "CLOUD_AMBIGUOUS", "CLOUD_MARGIN", "INVALID", "COSMETIC", "SATURATED",
        "SUSPECT", "HISOLZEN", "UNCORR_GLINT", "SNOW_ICE", "AC_FAIL", "WHITECAPS", "ADJAC", "RWNEG_O2",
        "RWNEG_O3", "RWNEG_O4", "RWNEG_O5", "RWNEG_O6", "RWNEG_O7", "RWNEG_O8"),
}
NOT_WATER_FLAGS = ("INVALID", "LAND", "COASTLINE", "SNOW_ICE")
GENERAL_MASK = 1023
# --- end of fixed values ---


def _signed(code: int) -> int:
    """A 64-bit pattern as Spark's signed bigint: bit 63 is the sign."""
    code &= (1 << 64) - 1
    return code - (1 << 64) if code >= 1 << 63 else code


def flag_code(catalogue: Mapping[str, int], names: Sequence[str]) -> int:
    """F-08. OR of the named masks, as a signed bigint literal; unknown names are an error."""
    unknown = [n for n in names if n not in catalogue]
    if unknown:
        raise KeyError(f"unknown flags: {', '.join(unknown)}")
    return _signed(reduce(lambda code, name: code | catalogue[name], names, 0))


def unsigned_to_signed(col: Column) -> Column:
    """A decimal(20,0) holding a uint64 as the signed bigint with the same bits."""
    big = F.lit("9223372036854775808").cast("decimal(20,0)")
    whole = F.lit("18446744073709551616").cast("decimal(20,0)")
    wide = col.cast("decimal(20,0)")
    return F.when(wide >= big, (wide - whole).cast("bigint")).otherwise(wide.try_cast("bigint"))


def flag_mask(col: Column, code: int) -> Column:
    """F-09. Bits of `code` set in the flags; compare with 0, never with `> 0`."""
    return col.bitwiseAND(F.lit(code))


def flag_decode(col: Column, catalogue: Mapping[str, int]) -> Column:
    """F-10. Names of the set flags, in catalogue order."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(_signed(mask)).alias("mask")) for name, mask in catalogue.items()
    ])
    return F.transform(F.filter(entries, lambda e: col.bitwiseAND(e["mask"]) != 0), lambda e: e["name"])


def flag_vector(col: Column, catalogue: Mapping[str, int]) -> Column:
    """F-10. One 0/1 element per catalogue entry."""
    masks = F.array(*[F.lit(_signed(mask)) for mask in catalogue.values()])
    return F.transform(masks, lambda m: F.when(col.bitwiseAND(m) != 0, 1).otherwise(0))


def general_mask(col: Column) -> Column:
    """F-11. The ten general quality bits."""
    return col.bitwiseAND(F.lit(GENERAL_MASK))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def default_mask(flags: Column, code: int, bands: Sequence[Column]) -> Column:
    """F-12. 1 if a masking flag is set or a selected band is missing, else 0."""
    return F.when((flag_mask(flags, code) != 0) | _any([b.isNull() for b in bands]), 1).otherwise(0)


def negative_mask(base: Column, bands: Sequence[Column]) -> Column:
    """F-13. The default mask plus pixels with a negative reflectance."""
    return F.when((base == 1) | _any([F.coalesce(b < 0, F.lit(False)) for b in bands]), 1).otherwise(0)


def all_positive(bands: Sequence[Column]) -> Column:
    """F-14. True if every band is present and above zero."""
    return ~_any([F.coalesce(b <= 0, F.lit(True)) for b in bands])
