"""Kernel models: JSON files or vector tables (F-39)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chromasea.session import PLAN_TIME_ROWS, collect_bounded

# --- fixed values: keys of a model file ---
SCHEMA = "Kernel map<string,string>, ActiveSetVectors array<array<double>>, Alpha array<double>, Sigma double, Beta array<double>"
SCALE = "LengthScale"
# --- end of fixed values ---


@dataclass(frozen=True)
class KernelModel:
    """A fitted Gaussian-process regression. Its size is that of the fitted set, not of the data."""

    vectors: tuple[tuple[float, ...], ...]
    alpha: tuple[float, ...]
    beta: tuple[float, ...]
    sigma_f: float
    alpha_rq: float
    length_scales: tuple[float, ...]

    def __post_init__(self) -> None:
        n = len(self.length_scales)
        if len(self.beta) != n + 1 or len(self.alpha) != len(self.vectors) or any(len(v) != n for v in self.vectors):
            raise ValueError("sizes of vectors, alpha, beta and length scales do not agree")

    def to_json(self) -> str:
        """Vectors and weights as text that Spark folds into a constant."""
        return json.dumps([{"v": list(v), "a": a} for v, a in zip(self.vectors, self.alpha)])


def read_model(spark: SparkSession, path: str) -> KernelModel:
    """F-39. A model file; either one length scale for all features or one per feature, however many.

    The size of the active set is checked before it comes to the driver.
    """
    return model_of_row(spark.read.schema(SCHEMA).json(path, multiLine=True))


def model_of_row(models: DataFrame) -> KernelModel:
    """F-39. The model in the one row of a table of the schema of model files."""
    sizes = models.select(F.size("ActiveSetVectors").alias("n")).first()
    if sizes is None or sizes["n"] > PLAN_TIME_ROWS:
        raise ValueError("no model" if sizes is None else f"{sizes['n']} vectors: too large for a plan-time table")
    row = models.first()
    kernel, vectors = row["Kernel"], row["ActiveSetVectors"]
    n = len(vectors[0])
    if kernel.get("SigmaL") is not None:
        scales = [float(kernel["SigmaL"])] * n
    else:
        scales = [float(kernel[f"{SCALE}{i}"]) for i in range(1, n + 1)]
    return KernelModel(tuple(map(tuple, vectors)), tuple(row["Alpha"]), tuple(row["Beta"]),
                       float(kernel["SigmaF"]), float(kernel["AlphaRQ"]), tuple(scales))


def model_elements(models: DataFrame) -> DataFrame:
    """F-39. A model table laid out by element: vector and element (from 1), value, alpha, scale and beta.

    A row for each element of each vector, made where the file is read; other columns of the table go along.
    """
    own = [c for c in models.columns if c not in ("Kernel", "ActiveSetVectors", "Alpha", "Beta", "Sigma")]
    vectors = models.select("Kernel", "Alpha", "Beta", *own, F.posexplode("ActiveSetVectors").alias("_at", "_values"))
    elements = vectors.select("Kernel", "Beta", *own, F.get("Alpha", F.col("_at")).alias("alpha"), (F.col("_at") + 1).alias("vector"), F.posexplode("_values").alias("_i", "value"))
    scale = F.coalesce(F.try_element_at("Kernel", F.lit("SigmaL")), F.try_element_at("Kernel", F.concat(F.lit(SCALE), (F.col("_i") + 1).cast("string"))))
    return elements.select(
        *own, F.col("vector").cast("bigint").alias("vector"), (F.col("_i") + 1).cast("bigint").alias("element"), "value", "alpha",
        scale.cast("double").alias("scale"), F.get("Beta", F.col("_i") + 1).alias("beta"))


def model_from_frame(df: DataFrame, beta: Sequence[float], sigma_f: float, alpha_rq: float,
                     length_scales: Sequence[float], vector: str = "vector", alpha: str = "alpha") -> KernelModel:
    """A model whose active set is a table; its row count is checked before it is collected."""
    rows = collect_bounded(df.select(F.col(vector).alias("v"), F.col(alpha).alias("a")))
    rows.sort(key=lambda r: tuple(r["v"]))
    return KernelModel(tuple(tuple(r["v"]) for r in rows), tuple(r["a"] for r in rows), tuple(beta),
                       sigma_f, alpha_rq, tuple(length_scales))
