"""Granule and scene catalogues: what exists, what is missing, what to process.

Covers S-01, S-02, S-07 to S-12, W-01, W-04, U-01, U-02 and F-22, F-35.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chromasea.functions.dates import from_epoch1981, to_epoch1981
from chromasea.functions.names import name_orbit, name_platform, name_start

# --- fixed values: marks in granule names ---
NAME_SUFFIX = ".SEN3"
COLLECTION_4 = "004"
MONTH_SOURCES = ("my", "myint")
TIMELINESS_ORDER = ("NT", "NR")
# --- end of fixed values ---

# Passes per block of orbit bits: their sum stays a positive bigint.
BLOCK = 62


def discover_granules(names: DataFrame, timeliness: str, resolution: str, collection: int,
                      name: str = "name") -> DataFrame:
    """S-01. Names of a timeliness and resolution; collection 004 only if collection 4 is wanted, and no other then."""
    stem = F.regexp_replace(F.col(name), r"\.SEN3$", "")
    is_4 = F.coalesce(F.element_at(F.split(stem, "_"), -1) == COLLECTION_4, F.lit(False))
    return names.where(
        F.col(name).contains(f"_{timeliness}_") & F.col(name).contains(resolution)
        & (is_4 if collection == 4 else ~is_4)
    )


def list_granules(spark: SparkSession, path: str) -> DataFrame:
    """S-01. Names of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", "modificationTime")


def parse_granule_name(df: DataFrame, col: str = "name") -> DataFrame:
    """S-02. Platform, start time and relative orbit (-1 if unreadable) from the name."""
    name = F.col(col)
    return df.withColumns({
        "platform": name_platform(name), "start_ts": name_start(name), "rel_orbit": name_orbit(name),
    })


def _best(df: DataFrame, keys: Sequence[str], rank: Column, tie: Sequence[str]) -> DataFrame:
    """One row per key: the smallest (rank, tie) by a grouped minimum, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in tie if c in rest] + [c for c in rest if c not in tie]
    packed = F.struct(rank.alias("_rank"), *ordered)
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def _rank(col: str, priority: Sequence[str]) -> Column:
    """Place in `priority`; what isn't in it comes last."""
    place = F.coalesce(F.array_position(F.lit(list(priority)), F.col(col)), F.lit(0)).cast("int")
    return F.when(place == 0, F.lit(len(priority) + 1)).otherwise(place)


def pick_source(df: DataFrame, key: str | Sequence[str], priority: Sequence[str] = MONTH_SOURCES,
                source: str = "source", tie: Sequence[str] = ()) -> DataFrame:
    """S-08. Per key the row of the first source in `priority` that exists; other sources are ignored."""
    keys = [key] if isinstance(key, str) else list(key)
    known = df.where(F.col(source).isin(list(priority)))
    return _best(known, keys, _rank(source, priority), tie)


def best_timeliness(df: DataFrame, keys: Sequence[str], priority: Sequence[str] = TIMELINESS_ORDER,
                    col: str = "timeliness", tie: Sequence[str] = ()) -> DataFrame:
    """W-04. Per key the row with the best timeliness: NT supersedes NR, and both any other, which is never lost."""
    return _best(df, list(keys), _rank(col, priority), tie)


def calendar(spark: SparkSession, start: str, end: str, name: str = "obs_date") -> DataFrame:
    """One row per day from start to end, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def missing_dates(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """S-09. Days of the range without a file."""
    have = df.select(F.col(date_col).cast("date").alias(date_col)).distinct()
    return calendar(df.sparkSession, start, end, date_col).join(have, date_col, "left_anti")


def month_inputs(df: DataFrame, timeliness: str, date: str = "obs_date") -> DataFrame:
    """S-10. Scenes per month, those of the wanted timeliness, and days in the month."""
    month = F.trunc(date, "month")
    return df.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col("timeliness") == timeliness).alias("n_timely"),
        F.max(F.dayofmonth(F.last_day(date))).alias("days"),
    )


def months_to_recompute(current: DataFrame, stored: DataFrame, key: str = "month", count: str = "n_timely") -> DataFrame:
    """S-11. Months whose stored number of timely sources is not the current one, or that have no output."""
    now = current.select(key, F.col(count).alias("n_now"))
    then = stored.select(key, F.col(count).alias("n_stored"))
    return now.join(then, key, "full_outer").where(~F.col("n_now").eqNullSafe(F.col("n_stored")))


def pending_dates(wanted: DataFrame, existing: DataFrame, overwrite: bool = False, key: str = "obs_date") -> DataFrame:
    """S-12. Dates to process: those without output, or all of them with `overwrite`."""
    return wanted if overwrite else wanted.join(existing.select(key).distinct(), key, "left_anti")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, where a null equals a null; the keys of the left stay."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    return left.join(other, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])).drop(*[f"_right_{k}" for k in keys])


def index_granules(granules: DataFrame, day: str = "obs_date", name: str = "name", prefix: int = 29) -> DataFrame:
    """W-01. Granule index 1, 2, 3... by name within a day, and the orbit bit.

    Each new pair of platform and relative orbit gets the next bit, in order of
    first appearance. Bits lie in blocks of 62 (`orbit_block` from 0, `orbit_bit` a
    power of two), so that a day may have any number of passes; the first 62 have
    block 0 and the bits of a single sum.

    The index is a count of earlier name prefixes plus a rank within the prefix:
    a prefix reaches down to the acquisition hour, so no window has to sort a
    whole day, however busy.
    """
    staged = granules.withColumn("_p", F.substring(name, 1, prefix))
    buckets = staged.groupBy(day, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(day).orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    offsets = buckets.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(W.partitionBy(day, "_p").orderBy(name))
    indexed = _join_null_safe(staged, offsets, [day, "_p"]).withColumn(
        "granule_index", (F.col("_before") + inside).cast("int")
    ).drop("_p", "_before")
    passes = indexed.groupBy(day, "platform", "rel_orbit").agg(F.min("granule_index").alias("_first"))
    rank = F.row_number().over(W.partitionBy(day).orderBy("_first"))
    bits = passes.withColumn("orbit_rank", rank.cast("int")).drop("_first")
    place = F.col("orbit_rank") - 1
    return _join_null_safe(indexed, bits, [day, "platform", "rel_orbit"]).withColumns({
        "orbit_block": F.floor(place / BLOCK).cast("int"),
        "orbit_bit": F.call_function("shiftleft", F.lit(1).cast("bigint"), place % BLOCK),
    })


def union_scenes(*dfs: DataFrame) -> DataFrame:
    """U-01. All scenes in one table; a variable missing in a scene is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def not_timely(all_: DataFrame, timely: DataFrame) -> DataFrame:
    """U-02. Scenes that are in the full list but not in the timely one, with multiplicity."""
    return all_.exceptAll(timely)


CONDITIONS = ("product", "timeliness", "sensor")
RULES = "position long, product string, timeliness string, sensor string, set map<string,string>"


def rules_table(spark: SparkSession, rules: Sequence[Mapping]) -> DataFrame:
    """Rules given as mappings with `set` and any of product, timeliness and sensor, in order, as a table for F-22."""
    rows = [(i, *(rule.get(c) for c in CONDITIONS), {k: str(v) for k, v in rule["set"].items()}) for i, rule in enumerate(rules)]
    return spark.createDataFrame(rows, RULES)


def overlay_attributes(df: DataFrame, rules: DataFrame | Sequence[Mapping], attributes: str = "attributes") -> DataFrame:
    """F-22. Override base attributes by rules on product, timeliness and sensor.

    A rule is a row (position, product, timeliness, sensor, set); a null condition holds for anything, and of rules that set
    one attribute the one with the last position wins. A scene without a product, say, meets only rules that don't ask for
    one. The plan doesn't grow with the rules: each combination that occurs looks them up by its 2^3 patterns with
    wildcards, overrides are folded per combination and attribute, and scenes join their combination.
    """
    table = rules if isinstance(rules, DataFrame) else rules_table(df.sparkSession, rules)
    combinations = df.select(*CONDITIONS).distinct()
    patterns = F.array(*[
        F.struct(*[(F.col(c) if kept else F.lit(None).cast("string")).alias(f"_{c}") for c, kept in zip(CONDITIONS, keep)])
        for keep in itertools.product((True, False), repeat=len(CONDITIONS))
    ])
    asked = combinations.select(*CONDITIONS, F.explode(F.array_distinct(patterns)).alias("_p")).select(*CONDITIONS, "_p.*")
    named = table.select("position", "set", *[F.col(c).alias(f"_rule_{c}") for c in CONDITIONS])
    met = asked.join(named, reduce(lambda a, b: a & b, [F.col(f"_{c}").eqNullSafe(F.col(f"_rule_{c}")) for c in CONDITIONS]))
    winners = met.select(*CONDITIONS, "position", F.explode("set").alias("_key", "_value")).groupBy(*CONDITIONS, "_key").agg(F.max_by("_value", "position").alias("_value"))
    folded = winners.groupBy(*[F.col(c).alias(f"_{c}") for c in CONDITIONS]).agg(F.map_from_entries(F.collect_list(F.struct("_key", "_value"))).alias("_set"))
    joined = df.join(folded, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CONDITIONS]), "left")
    base = F.map_filter(F.col(attributes), lambda k, _: ~F.map_contains_key("_set", k))
    return joined.withColumn(attributes, F.when(F.col("_set").isNull(), F.col(attributes)).otherwise(F.map_concat(base, "_set"))).select(*df.columns)


def audit_timestamps(df: DataFrame, name_date: str = "name_date", stored: str = "stored_epoch") -> DataFrame:
    """F-35. Compare the stored time (seconds since 1981) with the date in the name."""
    stored_date = from_epoch1981(F.col(stored)).cast("date")
    return df.withColumns({"stored_date": stored_date, "time_ok": stored_date.eqNullSafe(F.col(name_date))})


def fix_timestamps(df: DataFrame, name_date: str = "name_date", stored: str = "stored_epoch") -> DataFrame:
    """F-35. Copy with the stored time taken from the date in the name."""
    return df.withColumn(stored, to_epoch1981(F.col(name_date)))
