"""Delimited reports (S-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: columns of the resampling report, in order ---
RESAMPLE_REPORT = (
    "Source", "StartDate", "RelOrbit", "GranuleIndex", "OrbitIndex", "OrigWidth", "OrigHeight", "OrigNTotal",
    "OrigNFlagged", "OrigNWater1", "OrigNWater2", "OrigNValid", "OrigPValid", "YMin", "YMax", "XMin", "XMax",
    "Width", "Height", "NTotal", "NValid", "PValid",
)
REPORT_SEPARATOR = ";"
# --- end of fixed values ---


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """S-06. Header and separated rows; arrays are joined with commas."""
    flat = df.select(*[
        F.concat_ws(",", F.col(f.name)).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
        for f in df.schema.fields
    ])
    flat.write.mode(mode).csv(path, sep=REPORT_SEPARATOR, header=True)


def read_report(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S-06. A report by its column names."""
    reader = spark.read.option("sep", REPORT_SEPARATOR).option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def resample_report_rows(report: DataFrame) -> DataFrame:
    """S-06. The 22 named columns of the resampling report from a joined granule report."""
    fields = {
        "Source": "name", "StartDate": "start_date", "RelOrbit": "rel_orbit", "GranuleIndex": "granule_index",
        "OrbitIndex": "orbit_bit", "OrigWidth": "width", "OrigHeight": "height", "OrigNTotal": "n_total",
        "OrigNFlagged": "n_flagged", "OrigNWater1": "n_water1", "OrigNWater2": "n_water2", "OrigNValid": "n_valid",
        "OrigPValid": "p_valid", "YMin": "y_min", "YMax": "y_max", "XMin": "x_min", "XMax": "x_max",
        "NTotal": "resampled_n_total", "NValid": "resampled_n_valid", "PValid": "resampled_p_valid",
    }
    derived = {"Width": F.col("x_max") - F.col("x_min"), "Height": F.col("y_max") - F.col("y_min")}
    return report.select(*[derived.get(c, F.col(fields.get(c, "name"))).alias(c) for c in RESAMPLE_REPORT])
