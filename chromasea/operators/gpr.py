"""Gaussian-process chlorophyll (J-08, A-06, A-07)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.numeric import dot
from chromasea.operators.quality import inputs_valid
from chromasea.sources.models import KernelModel

# --- fixed values: predictors of the two chlorophyll models ---
PREDICTORS = {
    "doy": (("doy",), ("rrs443", "rrs490", "rrs510", "rrs560")),
    "lon_doy": (("lon", "doy"), ("rrs443", "rrs490", "rrs560", "rrs665")),
}
# --- end of fixed values ---

_CHUNK = 2_000_000  # kernel values held at once by a task


def features(kind: str) -> Column:
    """Feature array of a model: plain predictors, then log10 reflectances; NULL for unfit input."""
    plain, bands = PREDICTORS[kind]
    ok = inputs_valid([F.col(b) for b in bands], kind)
    return F.when(ok, F.array(
        *[F.col(c).cast("double") for c in plain],
        *[F.log10(F.when(F.col(b) > 0, F.col(b))) for b in bands],
    ))


def gpr_predict_sql(df: DataFrame, model: KernelModel, vector: Column | str, out: str = "log_chl") -> DataFrame:
    """J-08. The predictor as one JVM expression over the model held as a constant.

    The active set is folded into the plan (its size is checked when the model
    is made), so rows are not multiplied by it: no join and no aggregation.
    """
    x = F.col(vector) if isinstance(vector, str) else vector
    active = F.from_json(F.lit(model.to_json()), "array<struct<v:array<double>,a:double>>")
    inverse = F.lit([1.0 / (s * s) for s in model.length_scales])

    def kernel(entry: Column) -> Column:
        squares = F.zip_with(x, entry["v"], lambda p, q: (p - q) * (p - q))
        base = 1 + dot(squares, inverse) / F.lit(2 * model.alpha_rq)
        return F.lit(model.sigma_f ** 2) * F.pow(base, F.lit(-model.alpha_rq))

    residual = F.aggregate(active, F.lit(0.0), lambda s, e: s + e["a"] * kernel(e))
    trend = F.lit(model.beta[0]) + dot(x, F.lit(list(model.beta[1:])))
    return df.withColumn(out, F.when(x.isNotNull(), trend + residual))


def predictor(model: KernelModel):
    """Arrow UDF over a feature array: numpy kernels in bounded chunks, NULL in, NULL out."""
    scales = np.asarray(model.length_scales)
    active = np.asarray(model.vectors) / scales
    alpha, beta = np.asarray(model.alpha), np.asarray(model.beta)
    step = max(1, _CHUNK // max(1, len(alpha)))

    @F.pandas_udf("double")
    def predict(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), np.nan)
        known = np.flatnonzero(vectors.notna().to_numpy())
        for start in range(0, known.size, step):
            at = known[start:start + step]
            rows = np.stack(vectors.iloc[at].to_numpy()).astype(float)
            scaled = rows / scales
            dist = np.zeros((at.size, alpha.size))
            for k in range(scales.size):
                dist += (scaled[:, k, None] - active[None, :, k]) ** 2
            kernel = model.sigma_f ** 2 * (1 + dist / (2 * model.alpha_rq)) ** -model.alpha_rq
            out[at] = beta[0] + rows @ beta[1:] + kernel @ alpha
        return pd.Series(out)

    return predict


def gpr_predict(df: DataFrame, model: KernelModel, vector: Column, out: str = "log_chl") -> DataFrame:
    """The predictor in Arrow batches, for active sets of hundreds of vectors."""
    staged = df.withColumn("_x", vector)
    value = predictor(model)(F.col("_x"))
    return staged.withColumn(out, value).withColumn(out, F.when(~F.isnan(out), F.col(out))).drop("_x")


def gpr_chl(df: DataFrame, model: KernelModel, kind: str, out: str = "chl") -> DataFrame:
    """A-06 (kind "doy"), A-07 (kind "lon_doy"). Chlorophyll where the inputs are fit, else NULL.

    The features, the validity test and the power stay in the JVM; only one array
    per row crosses to Python, and unfit rows carry NULL there.
    """
    predicted = gpr_predict(df, model, features(kind), "_log")
    return predicted.withColumn(out, F.pow(F.lit(10.0), F.col("_log"))).drop("_log")
