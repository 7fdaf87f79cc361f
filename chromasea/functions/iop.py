"""Quasi-analytical inherent optical properties and spectral band shifting (A-10 to A-12).

Published basis: Lee, Carder and Arnone (2002) and its later versions for the
inversion; Melin and Sclep (2015) for the band shift.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.numeric import clamp, poly

# --- fixed values: water and phytoplankton coefficients, model constants ---
COEFFICIENTS = {
    # wavelength: aw, bbw, A, B
    400.0: (0.00663, 0.003445, 0.0263, 0.282),
    412.0: (0.004562, 0.003055, 0.0323, 0.286),
    412.5: (0.00452, 0.00303875, 0.03255, 0.28725),
    442.5: (0.00696, 0.00225875, 0.0396, 0.34125),
    443.0: (0.00707, 0.0022425, 0.0394, 0.3435),
    490.0: (0.015, 0.001495, 0.0274, 0.361),
    510.0: (0.0325, 0.001235, 0.018, 0.26),
    555.0: (0.0596, 0.00091, 0.007, 0.0315),
    560.0: (0.0619, 0.000845, 0.0062, 0.016),
    620.0: (0.2755, 0.000585, 0.0065, 0.064),
    665.0: (0.429, 0.00039, 0.01525, 0.134),
    670.0: (0.439, 0.00039, 0.0189, 0.149),
    673.75: (0.448, 0.00039, 0.02005, 0.1565),
    681.25: (0.4715, 0.00039, 0.0172, 0.150625),
}
INPUT_BANDS = (412.5, 442.5, 490.0, 560.0, 665.0)
# wavelengths that the inversion looks for among the inputs, and how near the last two must be
WANTED = (412.0, 443.0, 490.0, 555.0, 670.0)
GREEN_WITHIN, RED_WITHIN = 8.0, 10.0
G0, G1 = 0.089, 0.1245
SUBSURFACE = (0.52, 1.7)
RED_LIMITS = ((20.0, 1.5), (0.9, 1.7))  # factor, exponent: upper and lower
RED_REPAIR = (1.27, 1.47, 0.00018, -3.19)
A0_POLY = (-1.1459, -1.3658, -0.4693)
RED_SWITCH, RED_A0 = 0.0015, (0.39, 1.14)
ETA = (2.0, 1.2, -0.9)
ZETA, SLOPE = (0.74, 0.2, 0.8), (0.015, 0.002, 0.6)
ZETA_SPAN = 442.5 - 415.5
APH_SHARE = (0.15, 0.6)
APH_FALLBACK = (-0.8, 1.4)
BLEND_DISTANCE = 15.0
# --- end of fixed values ---

# Stands in for the bands of unusable rows, whose result is NULL: columns that
# cannot be NULL need no null checks in the generated code.
NEUTRAL = 0.004
_POSITION = {"aw": 0, "bbw": 1, "aph_a": 2, "aph_b": 3}
Bands = Mapping[float, str]
Tables = Mapping[str, Mapping[float, float]]
IOP_FIELDS = ("bbp443", "adg443", "aph443", "lambda0", "eta", "s", "a555", "bbp0", "a0", "bbp510")


def input_bands(columns: Bands | Sequence[str]) -> dict[float, str]:
    """Columns by wavelength, in order; a plain list of five names stands for INPUT_BANDS."""
    named = columns if isinstance(columns, Mapping) else dict(zip(INPUT_BANDS, columns, strict=True))
    return {float(w): named[w] for w in sorted(named)}


def wanted_bands(bands: Sequence[float]) -> tuple[float, ...]:
    """The inputs nearest to 412, 443, 490, 555 and 670 nm; a green or red band too far away is an error."""
    chosen = tuple(min(bands, key=lambda b: abs(b - w)) for w in WANTED)
    for name, band, wanted, within in (("green", chosen[3], WANTED[3], GREEN_WITHIN), ("red", chosen[4], WANTED[4], RED_WITHIN)):
        if abs(band - wanted) > within:
            raise ValueError(f"no {name} band within {within:g} nm of {wanted:g} nm")
    return chosen


def coefficient(name: str, wavelength: float, table: Mapping[float, float] | None = None) -> float:
    """A-12. Coefficient at a wavelength, resolved while the plan is built.

    Without `table` the wavelength must be one of the built-in ones; with a
    table (wavelength to value) it is interpolated and held at both ends.
    """
    if table is None:
        if wavelength not in COEFFICIENTS:
            raise KeyError(f"no built-in {name} at {wavelength} nm; pass a coefficient table")
        return COEFFICIENTS[wavelength][_POSITION[name]]
    knots = sorted(table.items())
    if wavelength <= knots[0][0]:
        return knots[0][1]
    for (w0, v0), (w1, v1) in zip(knots, knots[1:]):
        if wavelength <= w1:
            return v0 + (v1 - v0) * (wavelength - w0) / (w1 - w0)
    return knots[-1][1]


def _div(a: Column, b: Column) -> Column:
    """Quotient that cannot be NULL; the divisors of the model are never zero for usable rows."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _invert(df: DataFrame, bands: Bands, literal_share: bool, tables: Tables | None = None) -> DataFrame:
    """Adds `_ok` and the properties as flat columns `_bbp0`, `_eta`, ...

    A chain of short projections: each value that is used more than once is
    named once, so no shared sub-expression is expanded, and none of them can be
    NULL, so that the whole chain stays small enough to be compiled.
    """
    chosen = wanted_bands(list(bands))
    inputs = [F.col(bands[b]) for b in chosen]
    aw = [coefficient("aw", b, (tables or {}).get("aw")) for b in chosen]
    bbw = [coefficient("bbw", b, (tables or {}).get("bbw")) for b in chosen]
    usable = (inputs[0] > 0) & (inputs[1] > 0) & (inputs[2] > 0) & (inputs[3] > 0) & inputs[4].isNotNull()
    g = F.col
    step = df.withColumn("_ok", F.coalesce(usable, F.lit(False)))
    step = step.withColumns({
        f"_r{i}": F.coalesce(F.when(g("_ok"), c), F.lit(NEUTRAL)) for i, c in enumerate(inputs)
    })
    (hi_f, hi_e), (lo_f, lo_e) = RED_LIMITS
    k0, k1, k2, k3 = RED_REPAIR
    raw, green = g("_r4"), g("_r3")
    outside = (
        (raw <= 0) | (raw > F.lit(hi_f) * F.pow(green, F.lit(hi_e))) | (raw < F.lit(lo_f) * F.pow(green, F.lit(lo_e)))
    )
    repaired = F.lit(k0) * F.pow(green, F.lit(k1)) + F.lit(k2) * F.pow(_div(g("_r2"), green), F.lit(k3))
    step = step.withColumn("_r4", F.when(outside, repaired).otherwise(raw))
    step = step.withColumns({
        f"_b{i}": _div(g(f"_r{i}"), F.lit(SUBSURFACE[0]) + F.lit(SUBSURFACE[1]) * g(f"_r{i}")) for i in range(5)
    })
    step = step.withColumns({
        **{f"_u{i}": (F.sqrt(F.lit(G0 * G0) + F.lit(4 * G1) * g(f"_b{i}")) - F.lit(G0)) * F.lit(0.5 / G1)
           for i in (0, 1, 3, 4)},
        "_ratio": _div(g("_b1"), g("_b3")), "_blue": g("_b1") + g("_b2"), "_red": g("_r4") >= F.lit(RED_SWITCH),
    })
    ratio, red, blue = g("_ratio"), g("_red"), g("_blue")
    denominator = g("_b3") + 5 * _div(g("_b4") * g("_b4"), g("_b2"))
    step = step.withColumns({
        "_chi": F.coalesce(F.log10(_div(blue, denominator)), F.lit(0.0)),
        "_u": F.when(red, g("_u4")).otherwise(g("_u3")),
        "_lambda0": F.when(red, chosen[4]).otherwise(chosen[3]),
        "_eta": F.lit(ETA[0]) * (1 - F.lit(ETA[1]) * F.exp(F.lit(ETA[2]) * ratio)),
        "_zeta": F.lit(ZETA[0]) + _div(F.lit(ZETA[1]), F.lit(ZETA[2]) + ratio),
        "_s": F.lit(SLOPE[0]) + _div(F.lit(SLOPE[1]), F.lit(SLOPE[2]) + ratio),
    })
    step = step.withColumn("_a0", F.when(
        red, F.lit(aw[4]) + F.lit(RED_A0[0]) * F.pow(_div(g("_b4"), blue), F.lit(RED_A0[1]))
    ).otherwise(F.lit(aw[3]) + F.pow(F.lit(10.0), poly(g("_chi"), A0_POLY))))
    water = F.when(red, F.lit(bbw[4])).otherwise(F.lit(bbw[3]))
    step = step.withColumn("_bbp0", _div(g("_u") * g("_a0"), 1 - g("_u")) - water)

    def absorption(i: int) -> Column:
        return _div((1 - g(f"_u{i}")) * (F.lit(bbw[i]) + _particles(chosen[i])), g(f"_u{i}"))

    step = step.withColumns({
        "_a412": absorption(0), "_a443": absorption(1), "_a555": absorption(3),
    })
    a412, a443 = g("_a412"), g("_a443")
    excess = (a412 - F.lit(aw[0])) - g("_zeta") * (a443 - F.lit(aw[1]))
    step = step.withColumn("_adg443", _div(excess, F.exp(g("_s") * F.lit(ZETA_SPAN)) - g("_zeta")))
    step = step.withColumn("_aph443", a443 - g("_adg443") - F.lit(aw[1]))
    if literal_share:
        contrast = a443 - _div(F.lit(aw[1]), a412) - F.lit(aw[0])
    else:
        contrast = _div(a443 - F.lit(aw[1]), a412 - F.lit(aw[0]))
    share = clamp(F.lit(APH_FALLBACK[0]) + F.lit(APH_FALLBACK[1]) * contrast, *APH_SHARE)
    step = step.withColumn("_odd", ~_div(g("_aph443"), a443).between(*APH_SHARE))
    step = step.withColumn("_aph443", F.when(g("_odd"), a443 * share).otherwise(g("_aph443")))
    return step.withColumn(
        "_adg443", F.when(g("_odd"), a443 - g("_aph443") - F.lit(aw[1])).otherwise(g("_adg443"))
    )


def _particles(wavelength: float) -> Column:
    """Particle backscattering at a wavelength."""
    return F.col("_bbp0") * F.pow(F.col("_lambda0") * F.lit(1.0 / wavelength), F.col("_eta"))


def with_iop(df: DataFrame, r412: str | Bands, r442: str = "", r490: str = "", r560: str = "", r665: str = "", out: str = "iop",
             literal_share: bool = True, tables: Tables | None = None) -> DataFrame:
    """A-10. Adds a struct column with the ten properties and the repaired red band.

    Inputs are the five columns of INPUT_BANDS, or one mapping of any wavelengths to
    columns, of which the nearest to the wanted ones are taken. Wavelengths without
    built-in coefficients need `tables` (aw, bbw: wavelength to value).

    Rows that lack one of the five inputs, or have a non-positive one where the
    inversion needs it, get NULL. `literal_share` keeps the published code's
    reading of the fallback share, in which the bracket around each difference
    is missing; False puts the brackets in.
    """
    bands = input_bands(r412 if isinstance(r412, Mapping) else (r412, r442, r490, r560, r665))
    step = _invert(df, bands, literal_share, tables)
    derived = {"bbp443": _particles(wanted_bands(list(bands))[1]), "bbp510": _particles(min(bands, key=lambda b: abs(b - 510.0)))}
    result = F.struct(*[derived.get(f, F.col(f"_{f}")).alias(f) for f in IOP_FIELDS], F.col("_r4").alias("r665"))
    return step.select(*df.columns, F.when(F.col("_ok"), result).alias(out))


def _forward(df: DataFrame, wavelengths: Sequence[float], reference: float, tables: Tables | None = None) -> DataFrame:
    """Forward model: Rrs at each wavelength from the inverted properties, as `_f0`, `_f1`, ...

    `reference` is the band nearest to 443 nm among all bands taking part.
    """
    g = F.col

    def at(name: str, w: float) -> float:
        return coefficient(name, w, (tables or {}).get(name))

    a_ref, b_ref = at("aph_a", reference), at("aph_b", reference)
    step = df.withColumn("_aph_rel", g("_aph443") * F.lit(1.0 / a_ref))
    back, total = {}, {}
    for i, w in enumerate(wavelengths):
        power = (1 - at("aph_b", w)) / (1 - b_ref)
        aph = F.lit(at("aph_a", w)) * F.pow(g("_aph_rel"), F.lit(power))
        adg = g("_adg443") * F.exp(g("_s") * F.lit(443.0 - w))
        back[f"_bb{i}"] = _particles(w) + F.lit(at("bbw", w))
        total[f"_q{i}"] = _div(g(f"_bb{i}"), g(f"_bb{i}") + adg + aph + F.lit(at("aw", w)))
    n = range(len(wavelengths))
    step = step.withColumns(back).withColumns(total)
    step = step.withColumns({f"_q{i}": (F.lit(G0) + F.lit(G1) * g(f"_q{i}")) * g(f"_q{i}") for i in n})
    return step.withColumns({
        f"_f{i}": _div(F.lit(SUBSURFACE[0]) * g(f"_q{i}"), 1 - F.lit(SUBSURFACE[1]) * g(f"_q{i}")) for i in n
    })


def _sources(wavelength: float, bands: Sequence[float]) -> list[tuple[float, float]]:
    """Input bands that an output wavelength is taken from, with their shares."""
    gap = min(abs(b - wavelength) for b in bands)
    below = [b for b in bands if b <= wavelength]
    above = [b for b in bands if b > wavelength]
    if gap > BLEND_DISTANCE and below and above:
        lo, hi = below[-1], above[0]
        return [(lo, (hi - wavelength) / (hi - lo)), (hi, (wavelength - lo) / (hi - lo))]
    nearest = [b for b in bands if abs(b - wavelength) == gap][:2]
    return [(b, 1.0 / len(nearest)) for b in nearest]


def band_shift(df: DataFrame, out_nm: Sequence[float],
               columns: Bands | Sequence[str] = ("rrs412_5", "rrs442_5", "rrs490", "rrs560", "rrs665"),
               names: Sequence[str] | None = None, tables: Tables | None = None) -> DataFrame:
    """A-11. Adds the reflectance at each output wavelength.

    `columns` are the five OLCI bands, or a mapping of any input wavelengths to columns;
    coefficients are those of these wavelengths. Wavelengths without built-in
    coefficients need `tables` (aw, bbw, aph_a and aph_b: wavelength to value).

    The modelled ratio between output and nearest input band scales the measured
    input. Two equally near inputs are averaged; an output more than 15 nm away
    from all inputs and lying between two of them is blended linearly.
    """
    outs = [float(w) for w in out_nm]
    bands = input_bands(columns)
    every = sorted(set(bands) | set(outs))
    reference = min(every, key=lambda b: abs(b - 443.0))
    plan = {w: _sources(w, list(bands)) for w in outs}
    needed = sorted({b for terms in plan.values() for b, _ in terms} | set(outs))
    step = _forward(_invert(df, bands, True, tables), needed, reference, tables)
    # the inputs of the inversion as it used them (red repaired); other bands as they are
    measured = {b: F.col(c) for b, c in bands.items()} | {b: F.col(f"_r{i}") for i, b in enumerate(wanted_bands(list(bands)))}
    model = {w: F.col(f"_f{i}") for i, w in enumerate(needed)}
    result = []
    for name, w in zip(names or [f"rrs{w:g}".replace(".", "_") + "_shifted" for w in outs], outs):
        terms = [F.lit(k) * model[w] * _div(measured[b], model[b]) for b, k in plan[w]]
        result.append(F.when(F.col("_ok"), sum(terms[1:], terms[0])).alias(name))
    return step.select(*df.columns, *result)
