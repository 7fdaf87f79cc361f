"""Joins on an order instead of on equality: the last row not above a value, and step functions of intervals."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Ranges of the values, at most; a power of two.
MOST_RANGES = 1024


class Ranges:
    """Ranges of a column's values with about equally many rows each, from its approximate quantiles.

    A value that is many quantiles at once has a range of its own and as many salts as quantiles, so a
    hot value is spread like any other. The driver holds the borders alone, whatever the size of the data.
    """

    def __init__(self, borders: Sequence[float]):
        ordered = sorted(borders)
        self.borders = sorted(set(ordered))
        # A border begins a range; the first range has no border.
        self.salts = [1, *(ordered.count(b) for b in self.borders)]

    @classmethod
    def of(cls, df: DataFrame, at: str, n: int | None = None) -> Ranges:
        """About `n` ranges, as many as shuffle partitions by default."""
        n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n = max(2, min(n, MOST_RANGES))
        known = df.where(F.col(at).isNotNull() & ~F.isnan(F.col(at).cast("double"))).select(F.col(at).cast("double").alias("v"))
        return cls(known.approxQuantile("v", [i / n for i in range(1, n)], 1 / (2 * n)))

    def __len__(self) -> int:
        return len(self.borders) + 1

    def number(self, v: Column) -> Column:
        """The range of a value: how many borders are not above it, by bisection."""
        if not self.borders:
            return F.lit(0)
        size = 1
        while size <= len(self.borders):
            size *= 2
        borders = F.lit([float(b) for b in self.borders])
        steps = F.lit([size >> i for i in range(1, size.bit_length())])
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(borders, at + step - 1) <= v, F.lit(False)), at + step).otherwise(at))

    def number_of(self, v: float) -> int:
        return bisect_right(self.borders, v)

    def all_salts(self, number: Column) -> Column:
        """The salts of a range, for rows that every salt needs."""
        return F.sequence(F.lit(0), F.get(F.lit(self.salts), number) - 1)

    def one_salt(self, number: Column) -> Column:
        """A salt of the range, by turns."""
        return F.pmod(F.monotonically_increasing_id(), F.get(F.lit(self.salts), number)).cast("int")


def _carried(rows: DataFrame, ranges: Ranges, backward: bool) -> DataFrame:
    """For every range the last row of those before it (or, backward, the first of those behind it): one row a range."""
    edge = (F.min if backward else F.max)(F.struct("_v", "_p")).alias("_edge")
    numbers = rows.sparkSession.range(len(ranges)).select(F.col("id").cast("int").alias("_range"))
    found = numbers.join(rows.groupBy("_range").agg(edge), "_range", "left")
    order = W.orderBy(F.col("_range").desc() if backward else F.col("_range").asc())
    return found.select("_range", F.last("_edge", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("_edge"))


def with_next(table: DataFrame, x: str, columns: Sequence[str], ranges: Ranges | None = None, prefix: str = "next_") -> DataFrame:
    """Each row of the table with `columns` of the row behind it in the order of (x, columns); null for the last one.

    Rows are sorted within ranges of x; the first row of the next filled range closes each range. Rows
    without x are left out. Repeated rows follow each other.
    """
    ranges = ranges or Ranges.of(table, x)
    v = F.col(x).cast("double")
    rows = table.where(v.isNotNull() & ~F.isnan(v)).select(F.struct(*table.columns).alias("_row"), v.alias("_v"), F.struct(*columns).alias("_p"))
    rows = rows.withColumn("_range", ranges.number(F.col("_v")))
    closing = _carried(rows, ranges, True).select("_range", F.lit(float("inf")).alias("_v"), F.col("_edge._p").alias("_p"), F.lit(1).alias("_kind"))
    both = rows.withColumn("_kind", F.lit(0)).unionByName(closing, allowMissingColumns=True)
    following = F.lead("_p").over(W.partitionBy("_range").orderBy("_v", "_kind", "_p"))
    return both.withColumn("_next", following).where("_kind = 0").select("_row.*", *(F.col(f"_next.{c}").alias(f"{prefix}{c}") for c in columns))


def as_of(points: DataFrame, table: DataFrame, at: str, x: str, columns: Sequence[str], ranges: Ranges | None = None) -> DataFrame:
    """Each point with `columns` of the table's last row whose x is not above `at`; null where there is none.

    Of rows with the same x that with the largest columns is the last. Points without a value (null or not a
    number) get nulls; they are dealt by turns and stand before all rows. Points and table are dealt together by ranges of the values, once,
    and sorted within them; each range begins with the last row of the ranges before it, so that a
    running window finds it. A point costs nothing but its place in the sort, however many rows the table has.
    """
    ranges = ranges or Ranges.of(points.select(F.col(at).alias("v")).union(table.select(F.col(x).alias("v"))), "v")
    v, k = F.col(at).cast("double"), F.col(x).cast("double")
    known = v.isNotNull() & ~F.isnan(v)
    row = F.struct(*points.columns).alias("_row")
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(len(ranges))).cast("int")
    asked = points.select(row, F.when(known, v).otherwise(float("-inf")).alias("_v"), F.when(known, 2).otherwise(-1).alias("_kind"),
                          F.when(known, ranges.number(v)).otherwise(turn).alias("_range"))
    asked = asked.withColumn("_salt", ranges.one_salt(F.col("_range")))
    rows = table.where(k.isNotNull() & ~F.isnan(k)).select(k.alias("_v"), F.struct(*columns).alias("_p")).withColumn("_range", ranges.number(F.col("_v")))
    opening = _carried(rows, ranges, False).where("_edge IS NOT NULL").select(
        "_range", F.lit(float("-inf")).alias("_v"), F.col("_edge._p").alias("_p"), F.lit(0).alias("_kind"))
    given = rows.withColumn("_kind", F.lit(1)).unionByName(opening).withColumn("_salt", F.explode(ranges.all_salts(F.col("_range"))))
    both = asked.unionByName(given, allowMissingColumns=True)
    running = W.partitionBy("_range", "_salt").orderBy("_v", "_kind", "_p").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("_last", F.last("_p", ignorenulls=True).over(running)).where("_row IS NOT NULL")
    return found.select("_row.*", *(F.col(f"_last.{c}").alias(c) for c in columns))


def first_active(intervals: DataFrame, start: str, end: str, columns: Sequence[str]) -> DataFrame:
    """The step function of closed integer intervals of one length: from each place on, the least `columns` of those that hold it.

    Returns `at` and the columns (null where no interval holds the place). Intervals are dealt by blocks of places, a few lengths
    long; a frame over the ends finds the least one, since an interval holds `at` if its end lies within one length behind it.
    """
    length = intervals.select((F.col(end) - F.col(start)).alias("n")).agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    if length.least is None:
        return intervals.select(F.col(start).cast("long").alias("at"), *columns)
    if length.least != length.most:
        raise ValueError("intervals of different lengths")
    n = int(length.most)
    block = 16 * (n + 1)
    ends = intervals.select(F.col(end).cast("long").alias("_at"), F.struct(*columns).alias("_p"))
    held = ends.withColumn("_block", F.explode(F.array_distinct(F.array(F.floor((F.col("_at") - n - 1) / block), F.floor(F.col("_at") / block)))))
    places = intervals.select(F.explode(F.array(F.col(start).cast("long"), F.col(end).cast("long") + 1)).alias("_at")).distinct()
    asked = places.withColumn("_block", F.floor(F.col("_at") / block)).withColumn("_asked", F.lit(True))
    frame = W.partitionBy("_block").orderBy("_at").rangeBetween(0, n)
    found = held.unionByName(asked, allowMissingColumns=True).withColumn("_first", F.min("_p").over(frame)).where("_asked")
    return found.select(F.col("_at").alias("at"), *(F.col(f"_first.{c}").alias(c) for c in columns))
