"""Chain B: daily reflectances to chlorophyll, quality index and plankton classes (A-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.functions.iop import band_shift
from chromasea.functions.plankton import plankton_classes
from chromasea.functions.reflectance import clip_product
from chromasea.operators.climatology import quality_index
from chromasea.operators.gpr import PREDICTORS, gpr_chl
from chromasea.schema import require_columns
from chromasea.sources.models import KernelModel

# --- fixed values: bands of the shift from 442.5 to 443 nm ---
SHIFT_INPUTS = ("rrs412_5", "rrs442_5", "rrs490", "rrs560", "rrs665")
# --- end of fixed values ---


def ensure_443(daily: DataFrame) -> DataFrame:
    """Band check: a table with 442.5 but without 443 nm gets the shifted band (A-11)."""
    if "rrs443" in daily.columns:
        return daily
    return band_shift(require_columns(daily, SHIFT_INPUTS), [443.0], SHIFT_INPUTS, names=["rrs443"])


def plankton_chain(daily: DataFrame, model: KernelModel, kind: str = "doy", clim: DataFrame | None = None) -> DataFrame:
    """A-14. Band check, A-06 or A-07, F-05, A-13 if a climatology is given, A-09."""
    ready = ensure_443(daily)
    if "doy" not in ready.columns:
        ready = ready.withColumn("doy", F.dayofyear("obs_date"))
    plain, bands = PREDICTORS[kind]
    out = gpr_chl(require_columns(ready, [*plain, *bands]), model, kind)
    out = out.withColumn("chl", clip_product(F.col("chl"), "chl"))
    if clim is not None:
        out = quality_index(out, clim, "chl", log=True)
    return plankton_classes(out)
