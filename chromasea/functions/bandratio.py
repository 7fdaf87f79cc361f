"""Band-ratio chlorophyll and diffuse attenuation (A-01 to A-03)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.numeric import interp_at, interp_linear, poly, segment_of

# --- fixed values: f/Q table and polynomial coefficients ---
FQ_CHL = (0.03, 0.1, 0.3, 1.0, 3.0, 10.0)
FQ = {
    443: (3.29125, 3.3857, 3.52968, 3.74683, 3.99138, 4.31326),
    490: (3.24564, 3.40843, 3.61341, 3.86893, 4.11003, 4.39395),
    510: (3.1765, 3.35968, 3.60166, 3.89409, 4.14114, 4.40546),
    560: (3.13802, 3.33689, 3.60695, 3.94203, 4.18865, 4.36813),
}
CHL_POLY = (0.4502748, -3.259491, 3.522731, -3.359422, 0.949586)
KD_POLY = (-0.8278866, -1.642189, 0.90261, -1.626853, 0.0885039)
KD_WATER = 0.0166
# --- end of fixed values ---


def fq_ratio(chl: Column, band: int) -> Column:
    """A-02. Bidirectional ratio of a band to 560 nm; 1 where chl is missing or outside the table."""
    ratio = interp_linear(chl, FQ_CHL, FQ[band]) / interp_linear(chl, FQ_CHL, FQ[560])
    return F.coalesce(ratio, F.lit(1.0))


def with_fq(df: DataFrame, chl: str, bands: Sequence[int]) -> DataFrame:
    """A-02 for several bands at once, as `_q{band}`: the table segment and the 560 nm value are shared."""
    x, k = F.col(chl), F.col("_segment")
    step = df.withColumn("_segment", segment_of(x, FQ_CHL))
    step = step.withColumn("_q560", F.coalesce(interp_at(x, k, FQ_CHL, FQ[560]), F.lit(1.0)))
    return step.withColumns({
        f"_q{b}": F.coalesce(interp_at(x, k, FQ_CHL, FQ[b]) / F.col("_q560"), F.lit(1.0)) for b in bands
    }).drop("_segment", "_q560")


def _positive(col: Column) -> Column:
    return F.when(col > 0, col)


def _log_ratio(r443: Column, r490: Column, r510: Column, r560: Column, chl: Column | None) -> Column:
    """Logarithm of the largest corrected ratio to 560 nm; NULL unless 510 and 560 are valid."""
    green = _positive(r560)

    def ratio(col: Column, band: int) -> Column:
        r = _positive(col) / green
        return r if chl is None else r / fq_ratio(chl, band)

    return F.log10(F.when(r510 > 0, F.greatest(ratio(r443, 443), ratio(r490, 490), ratio(r510, 510))))


def _log_490(r490: Column, r560: Column, q490: Column | None) -> Column:
    ratio = _positive(r490) / _positive(r560)
    return F.log10(ratio if q490 is None else ratio / q490)


def _chl(log_ratio: Column) -> Column:
    return F.pow(F.lit(10.0), poly(log_ratio, CHL_POLY))


def _kd(log_ratio: Column) -> Column:
    return F.lit(KD_WATER) + F.pow(F.lit(10.0), poly(log_ratio, KD_POLY))


def chl_oc4(r443: Column, r490: Column, r510: Column, r560: Column, chl: Column | None = None) -> Column:
    """A-01. Maximum-band-ratio chlorophyll, bidirectionally corrected if a first estimate is given.

    NULL unless 510 and 560 are valid; 443 and 490 only take part if they are.
    `chl` should be a named column: it is referred to many times, so an inlined
    first pass would be copied as often (`kd490_two_pass` stages both passes).
    """
    return _chl(_log_ratio(r443, r490, r510, r560, chl))


def kd490_ok2(r490: Column, r560: Column, chl: Column | None = None) -> Column:
    """A-03. Kd at 490 nm from the 490/560 ratio; NULL if either is not positive."""
    return _kd(_log_490(r490, r560, None if chl is None else fq_ratio(chl, 490)))


def kd490_two_pass(df: DataFrame, r443: str = "rrs443", r490: str = "rrs490", r510: str = "rrs510",
                   r560: str = "rrs560") -> DataFrame:
    """A-03. Adds chl_first, chl_second, q490 and kd490.

    Every value that is used more than once is a projection of its own, referred
    to by name: the polynomial and the f/Q segments never contain a copy of the
    expression behind their argument, which keeps the generated code small.
    """
    blue, cyan, green, base = (F.col(c) for c in (r443, r490, r510, r560))
    valid = (green > 0) & (base > 0)
    step = df.withColumns({"_n443": _positive(blue) / _positive(base), "_n490": _positive(cyan) / _positive(base),
                           "_n510": green / F.when(valid, base)})
    n443, n490, n510 = F.col("_n443"), F.col("_n490"), F.col("_n510")
    step = step.withColumn("_log", F.log10(F.when(n510.isNotNull(), F.greatest(n443, n490, n510))))
    step = with_fq(step.withColumn("chl_first", _chl(F.col("_log"))), "chl_first", (443, 490, 510))
    best = F.greatest(n443 / F.col("_q443"), n490 / F.col("_q490"), n510 / F.col("_q510"))
    step = step.withColumn("_log", F.log10(F.when(n510.isNotNull(), best))).withColumn("chl_second", _chl(F.col("_log")))
    step = with_fq(step.drop("_q443", "_q490", "_q510"), "chl_second", (490,)).withColumnRenamed("_q490", "q490")
    step = step.withColumn("_log", F.log10(n490 / F.col("q490"))).withColumn("kd490", _kd(F.col("_log")))
    return step.drop("_log", "_n443", "_n490", "_n510")
