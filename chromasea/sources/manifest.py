"""Product manifests: footprint and parameters (S-03)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: manifest lines ---
POS_LIST = r"^\s*<gml:posList>([^<]*)</gml:posList>"
PARAMETER_NAME = r"</sentinel-safe:([^>]*)>"
PARAMETER_VALUE = r"^[^>]*>(.*?)</sentinel-safe:"
# --- end of fixed values ---


def positions(text: Column) -> Column:
    """`lat lon lat lon ...` to an array of (lon, lat) structs."""
    parts = F.filter(F.split(F.trim(text), r"\s+"), lambda p: p != "")
    steps = F.sequence(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1)
    points = F.transform(steps, lambda i: F.struct(
        F.get(parts, 2 * i + 1).try_cast("double").alias("lon"), F.get(parts, 2 * i).try_cast("double").alias("lat")
    ))
    return F.when(F.size(parts) >= 2, points)


def parse_manifest(lines: DataFrame, key: str = "granule_id", line: str = "line") -> DataFrame:
    """S-03. Footprint and parameter map per manifest from its lines.

    Lines without a footprint or a parameter are dropped before the shuffle; a
    manifest has a few dozen of the others. A parameter named twice keeps its
    greatest value, a second footprint the longer text, so line order is irrelevant.
    """
    pos = F.regexp_extract(line, POS_LIST, 1)
    name = F.regexp_extract(line, PARAMETER_NAME, 1)
    value = F.regexp_extract(line, PARAMETER_VALUE, 1)
    useful = lines.select(
        key, F.when(pos != "", pos).alias("_pos"), F.when(name != "", name).alias("_name"), value.alias("_value")
    ).where(F.col("_pos").isNotNull() | F.col("_name").isNotNull())
    single = useful.groupBy(key, "_name").agg(
        F.max_by("_pos", F.length("_pos")).alias("_pos"), F.max("_value").alias("_value")
    )
    entry = F.when(F.col("_name").isNotNull(), F.struct("_name", "_value"))
    return single.groupBy(key).agg(
        F.max("_pos").alias("_pos"), F.map_from_entries(F.collect_list(entry)).alias("params")
    ).select(key, positions(F.col("_pos")).alias("polygon"), "params")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """S-03. All manifests below a path; the file path identifies the granule."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return parse_manifest(lines.select(F.col("_metadata.file_path").alias("granule_id"), F.col("value").alias("line")))
