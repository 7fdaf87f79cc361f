"""3x3 neighbourhoods and moving day windows (X-01, X-03, W-02)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import isqrt
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Side of the tiles of single scenes.
SCENE_SIDE = 32
RING = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]


def neighbours_3x3(df: DataFrame, ny: int, nx: int) -> DataFrame:
    """X-01. Send every value to the nine cells it is a neighbour of, clipped to the grid.

    Adds `dy`, `dx` (offset of the source from the target) and moves `y`, `x` to
    the target. A narrow transformation: the shuffle happens in the aggregation
    that follows.
    """
    offsets = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in RING])
    moved = df.withColumn("_o", F.explode(offsets)).withColumns({
        "dy": F.col("_o.dy"), "dx": F.col("_o.dx"),
        "y": F.col("y") - F.col("_o.dy"), "x": F.col("x") - F.col("_o.dx"),
    })
    inside = F.col("y").between(0, ny - 1) & F.col("x").between(0, nx - 1)
    return moved.where(inside).drop("_o")


def tile_side(ny: int, nx: int) -> int:
    """Side of the tiles of a grid: small enough for some hundred tiles, large enough that rims stay a small part."""
    return max(4, min(32, isqrt(ny * nx) // 16))


def deal_to_tiles(df: DataFrame, ny: int, nx: int, side: int | None = None) -> DataFrame:
    """Add the tile of every row (`_ty`, `_tx`); a row on the rim of its tile goes to the tiles next to it, too."""
    t = side or tile_side(ny, nx)

    def tile(c: str, d: int) -> Column:
        return F.floor((F.greatest(F.least(F.col(c) + d, F.lit(ny - 1 if c == "y" else nx - 1)), F.lit(0))) / t).cast("int")

    tiles = F.array_distinct(F.array(*[F.struct(tile("y", dy).alias("_ty"), tile("x", dx).alias("_tx")) for dy, dx in RING]))
    return df.withColumn("_t", F.explode(tiles)).withColumns({"_ty": F.col("_t._ty"), "_tx": F.col("_t._tx")}).drop("_t")


def neighbours_in_tiles(df: DataFrame, ny: int, nx: int, keys: Sequence[str] = ()) -> DataFrame:
    """X-01 for an aggregation by cell: rows are partitioned by tile before they are copied to their neighbours.

    The copies to the nine targets are made behind the exchange, and a tile keeps those on its own
    cells. Grouping by (`keys`, `_ty`, `_tx`, `y`, `x`, ...) needs no further exchange.
    """
    t = tile_side(ny, nx)
    near = neighbours_3x3(deal_to_tiles(df, ny, nx).repartition(*keys, "_ty", "_tx"), ny, nx)
    return near.where((F.floor(F.col("y") / t) == F.col("_ty")) & (F.floor(F.col("x") / t) == F.col("_tx")))


def smooth_3x3(df: DataFrame, col: str, ny: int, nx: int, keys: Sequence[str] = ("obs_date",)) -> DataFrame:
    """X-03. Plain and weighted mean of the present values in the neighbourhood.

    The weights are the product of (1/2, 1, 1/2) with itself, so sums are made along the columns of a row first and along the
    rows then: two passes of three copies behind one exchange by tile. Missing values count in neither
    sums nor weights, which are summed alike.
    """
    # Scenes are dealt by their keys as well, so tiles needn't be small for the sake of their number.
    t = SCENE_SIDE
    v = F.col(col).cast("double")
    sums = deal_to_tiles(df.where(v.isNotNull()), ny, nx, t).select(
        *keys, "_ty", "_tx", "y", "x", v.alias("_s"), v.alias("_sw"), F.lit(1).cast("bigint").alias("n"), F.lit(1.0).alias("_w")
    ).repartition(*keys, "_ty", "_tx")
    for axis, last, tile in (("x", nx - 1, "_tx"), ("y", ny - 1, "_ty")):
        moved = sums.withColumn("_d", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).withColumn(axis, F.col(axis) + F.col("_d"))
        kept = moved.where(F.col(axis).between(0, last) & (F.floor(F.col(axis) / t) == F.col(tile)))
        share = F.when(F.col("_d") == 0, 1.0).otherwise(0.5)
        sums = kept.groupBy(*keys, "_ty", "_tx", "y", "x").agg(
            F.sum("_s").alias("_s"), F.sum(F.col("_sw") * share).alias("_sw"), F.sum("n").alias("n"), F.sum(F.col("_w") * share).alias("_w"))
    return sums.select(*keys, "y", "x", (F.col("_s") / F.col("n")).alias("avg"), "n", (F.col("_sw") / F.col("_w")).alias("weighted_avg"))


def moving_sums(daily: DataFrame, col: str, half: int = 5, date: str = "obs_date", cell: Sequence[str] = ("y", "x")) -> DataFrame:
    """W-02, W-03 without copies: sums over the window of +-`half` days of every target day that has a value in it.

    Returns `cell`, target_date, mmdd, n, sum, offsets (sum of source day minus target day) and, with the triangle of W-03
    as weights, w_sum and w. A day of a cell brings the target days that the day before doesn't reach, as rows
    without a value; frames over the days then hold the sums. The triangle is a pile of `half` + 1 boxes, of
    one day up to the whole window, so its sums are those of the boxes. Days without a value count nowhere.
    The 29th of February is never a target.
    """
    day, v = F.col("_day"), F.col("_v")
    rows = daily.where(F.col(col).isNotNull()).select(*cell, F.unix_date(F.col(date)).alias("_day"), F.col(col).cast("double").alias("_v"))
    before = F.lag("_day").over(W.partitionBy(*cell).orderBy("_day"))
    begin = F.greatest(day - half, F.coalesce(before + half + 1, day - half))
    # A second row of a day brings no target days.
    fresh = F.when(begin <= day + half, F.sequence(begin, day + half)).otherwise(F.array().cast("array<int>"))
    targets = F.transform(fresh, lambda t: F.struct(t.alias("_day"), F.lit(None).cast("double").alias("_v"), F.lit(True).alias("_target")))
    own = F.array(F.struct(day.alias("_day"), v.alias("_v"), F.lit(False).alias("_target")))
    lines = rows.withColumn("_lines", F.concat(targets, own)).select(*cell, F.inline("_lines"))
    order = W.partitionBy(*cell).orderBy("_day")
    boxes = [order.rangeBetween(-k, k) for k in range(half + 1)]
    counts, sums = [F.count(v).over(b) for b in boxes], [F.coalesce(F.sum(v).over(b), F.lit(0.0)) for b in boxes]
    days = F.coalesce(F.sum(F.when(v.isNotNull(), day)).over(boxes[-1]), F.lit(0))
    summed = lines.withColumns({f"_n{k}": n for k, n in enumerate(counts)} | {f"_s{k}": s for k, s in enumerate(sums)} | {"_days": days}).where("_target")
    n, target = F.col(f"_n{half}"), F.date_from_unix_date(day)
    return summed.select(
        *cell, target.alias("target_date"), F.date_format(target, "MMdd").alias("mmdd"), n.alias("n"), F.col(f"_s{half}").alias("sum"),
        (F.col("_days") - n * day).alias("offsets"),
        (reduce(add, [F.col(f"_s{k}") for k in range(half + 1)]) / F.lit(half + 1)).alias("w_sum"),
        (reduce(add, [F.col(f"_n{k}") for k in range(half + 1)]) / F.lit(half + 1)).alias("w"),
    ).where("mmdd <> '0229'")


def day_window(daily: DataFrame, half: int = 5, date: str = "obs_date", cell: Sequence[str] | None = ("y", "x")) -> DataFrame:
    """W-02. Send every day to the target days whose window of +-`half` days holds it.

    Adds `target_date`, `offset` (source day minus target day) and `mmdd`. The
    29th of February is never a target. Rows are partitioned by `cell` before they
    are copied, so that aggregations by cell and target day stay in place; with
    None the partitioning is left as it is.
    """
    out = daily.repartition(*cell) if cell else daily
    out = out.withColumn("offset", F.explode(F.sequence(F.lit(-half), F.lit(half))))
    out = out.withColumn("target_date", F.date_sub(F.col(date), F.col("offset")))
    out = out.withColumn("mmdd", F.date_format("target_date", "MMdd"))
    return out.where(F.col("mmdd") != "0229")
