"""Nearest-neighbour resampling, tie points and overlays (G-07 to G-10, G-12)."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chromasea.functions.projection import EARTH_RADIUS, Area, lonlat_to_xy, unit_vector, with_cell_vector
from chromasea.session import materialise

# --- fixed values: search radii in metres ---
RADIUS_FULL_RESOLUTION = 500.0
RADIUS_MULTI_SENSOR = 6800.0
# --- end of fixed values ---


def map_radius(target: Area, radius_m: float) -> float:
    """Map distance that surely covers the search radius.

    The ground distance is stretched by at most the map scale at the farthest
    corner; two per cent cover the difference between sphere and ellipsoid.
    """
    return radius_m * target.max_scale * 1.02


def search_ring(target: Area, radius_m: float) -> int:
    """Cells to look at on each side of the cell that holds a pixel."""
    return ceil(map_radius(target, radius_m) / min(abs(target.pixel_x), abs(target.pixel_y)) + 0.5)


def resample_nearest(swath: DataFrame, target: Area, radius_m: float, cols: Sequence[str],
                     keys: Sequence[str] = ("granule_id",), bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """G-07. Each target cell takes the nearest swath pixel within the radius.

    A swath pixel offers itself to the cells of a ring around its own position,
    thinned by the distance in the map plane, and each cell keeps the smallest
    (chord distance, row, col): a grouped minimum with partial aggregation instead
    of a spatial join, so no index is shipped and no cell gathers its candidates.
    The radius itself is applied to the winner only, which is equivalent.

    The order is packed into one bigint, so that the aggregation hashes fixed-size
    values instead of sorting structs: `bits` for row and column (a swath beyond
    them is an error), the rest for the distance, which leaves steps far below a
    millimetre.
    """
    k, reach = search_ring(target, radius_m), map_radius(target, radius_m)
    offsets = F.sequence(F.lit(-k), F.lit(k))
    xm, ym = lonlat_to_xy(F.col("lon"), F.col("lat"), target)
    px, py, pz = unit_vector(F.col("lon"), F.col("lat"))
    located = swath.select(
        *keys, "row", "col", *cols, xm.alias("_xm"), ym.alias("_ym"), px.alias("_px"), py.alias("_py"), pz.alias("_pz")
    )
    row = (F.lit(float(target.extent[3])) - F.col("_ym")) / F.lit(target.pixel_y) - 0.5
    col = (F.col("_xm") - F.lit(float(target.extent[0]))) / F.lit(target.pixel_x) - 0.5
    located = located.withColumns({"_row": row, "_col": col}).where(
        F.col("_row").between(-k, target.height - 1 + k) & F.col("_col").between(-k, target.width - 1 + k)
    )
    rows = located.withColumn("_dy", F.explode(offsets)).withColumn("y", F.rint("_row").cast("int") + F.col("_dy"))
    rows = rows.where(
        F.col("y").between(0, target.height - 1)
        & (F.abs(F.col("_row") - F.col("y")) * F.lit(abs(target.pixel_y)) <= F.lit(reach))
    )
    cells = rows.withColumn("_dx", F.explode(offsets)).withColumn("x", F.rint("_col").cast("int") + F.col("_dx"))
    dy = (F.col("_row") - F.col("y")) * F.lit(target.pixel_y)
    dx = (F.col("_col") - F.col("x")) * F.lit(target.pixel_x)
    cells = cells.where(F.col("x").between(0, target.width - 1) & (dx * dx + dy * dy <= F.lit(reach * reach)))
    gaps = with_cell_vector(cells, "y", "x", target).withColumns({
        f"_d{a}": F.col(f"_p{a}") - F.col(f"_k{a}") for a in "xyz"
    })
    chord = F.lit(EARTH_RADIUS) * F.sqrt(sum((F.col(f"_d{a}") * F.col(f"_d{a}") for a in "xyz"), F.lit(0.0)))
    levels = (1 << (63 - sum(bits))) - 1
    step = F.least(F.floor(F.col("distance") * F.lit(levels / (2 * radius_m))), F.lit(levels))
    fits = F.col("row").between(0, (1 << bits[0]) - 1) & F.col("col").between(0, (1 << bits[1]) - 1)
    packed = (step * F.lit(1 << bits[0]) + F.col("row")) * F.lit(1 << bits[1]) + F.col("col")
    rank = F.when(fits, packed).otherwise(F.raise_error(F.lit("row or column exceeds its bits")).cast("bigint"))
    offered = gaps.withColumn("distance", chord).withColumn("_rank", rank)
    best = offered.groupBy(*keys, "y", "x").agg(
        F.min_by("distance", "_rank").alias("distance"), *[F.min_by(c, "_rank").alias(c) for c in cols]
    )
    return best.where(F.col("distance") <= radius_m).select(*keys, "y", "x", "distance", *cols)


def box_cells(boxes: DataFrame, keys: Sequence[str] = ("granule_id",)) -> DataFrame:
    """Cells of every box. Rows are spread over the cluster before the columns are expanded."""
    rows = boxes.where((F.col("y_max") > F.col("y_min")) & (F.col("x_max") > F.col("x_min"))).select(
        *keys, "x_min", "x_max", F.explode(F.sequence(F.col("y_min"), F.col("y_max") - 1)).alias("y")
    ).repartition(*keys, "y")
    return rows.select(*keys, "y", F.explode(F.sequence(F.col("x_min"), F.col("x_max") - 1)).alias("x"))


def resample_mask(swath: DataFrame, boxes: DataFrame, target: Area, radius_m: float, mask: str = "mask_default",
                  keys: Sequence[str] = ("granule_id",), bits: tuple[int, int] = (16, 16)) -> DataFrame:
    """G-08. Three-state mask over the granule's box: no neighbour NULL, masked 0, clean 1.

    Granules of which nothing lands in the grid are dropped.
    """
    hits = resample_nearest(swath, target, radius_m, [mask], keys, bits)
    state = hits.select(*keys, "y", "x", F.when(F.col(mask) == 0, 1).otherwise(0).alias("mask"))
    # a written table: the granules that landed and their cells come from one resampling
    state = materialise(state, "resampled")
    landed = state.select(*keys).distinct()
    cells = box_cells(boxes, keys).join(landed, list(keys), "left_semi")
    return cells.join(state, [*keys, "y", "x"], "left")


def resample_report(resampled: DataFrame, counters: DataFrame | None = None,
                    keys: Sequence[str] = ("granule_id",)) -> DataFrame:
    """G-09. Landed and valid cells per granule, joined to the counters of the original granule."""
    report = resampled.groupBy(*keys).agg(
        F.count_if(F.col("mask") >= 0).alias("resampled_n_total"),
        F.count_if(F.col("mask") == 1).alias("resampled_n_valid"),
    ).withColumn(
        "resampled_p_valid",
        F.coalesce(F.try_divide(F.lit(100.0) * F.col("resampled_n_valid"), F.col("resampled_n_total")), F.lit(0.0)),
    )
    return report if counters is None else report.join(counters, list(keys), "left")


def overlay_tiles(df: DataFrame, order_col: str, cols: Sequence[str], cell: Sequence[str] = ("y", "x")) -> DataFrame:
    """G-10. The last tile that has data wins, variable by variable."""
    return df.groupBy(*cell).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_col))).alias(c) for c in cols]
    )


def interpolate_tie(pixels: DataFrame, tie: DataFrame, ysub: int, xsub: int, cols: Sequence[str],
                    shape: tuple[int, int], keys: Sequence[str] = ("granule_id",)) -> DataFrame:
    """G-12. Angles at every pixel from a coarse tie grid of `shape` (rows, columns).

    Bilinear in the tie grid at the start of each block of `xsub` columns, and
    linear between two block starts. The tie points that a block needs (two rows,
    three columns) are packed into one row per block first, so pixels meet the
    tie grid in a single equi join on a unique key.
    """
    h, w = shape
    offsets = F.array(*[
        F.struct(F.lit(dj).alias("dj"), F.lit(di).alias("di")) for dj in (0, 1) for di in (0, 1, 2)
    ])
    spread = tie.withColumn("_o", F.explode(offsets)).withColumns({
        "_j0": F.col("j") - F.col("_o.dj"), "_i0": F.col("i") - F.col("_o.di")
    }).where(F.col("_j0").between(0, h - 2) & F.col("_i0").between(0, w - 2))

    def pick(c: str, dj: int, di: int) -> Column:
        here = (F.col("_o.dj") == dj) & (F.col("_o.di") == di)
        return F.max(F.when(here, F.col(c))).alias(f"_{c}_{dj}{di}")

    packed = spread.groupBy(*keys, "_j0", "_i0").agg(
        *[pick(c, dj, di) for c in cols for dj in (0, 1) for di in (0, 1, 2)]
    )
    fj = (F.col("row") + 0.5) / F.lit(float(ysub))
    block = F.floor(F.col("col") / xsub).cast("int")
    keyed = pixels.withColumns({
        "_fj": fj, "_block": block,
        "_j0": F.least(F.greatest(F.floor(fj).cast("int"), F.lit(0)), F.lit(h - 2)),
        "_i0": F.least(block, F.lit(w - 2)),
    })
    joined = keyed.join(packed, [*keys, "_j0", "_i0"], "left")
    wj = F.col("_fj") - F.col("_j0")

    def at_block(c: str, step: int) -> Column:
        """Bilinear value at the first column of the block `step` blocks on."""
        i0 = F.least(F.col("_block") + step, F.lit(w - 2))
        wi = (F.col("_block") + step) + F.lit(0.5 / xsub) - i0
        second = i0 > F.col("_i0")

        def corner(dj: int, di: int) -> Column:
            return F.when(second, F.col(f"_{c}_{dj}{min(di + 1, 2)}")).otherwise(F.col(f"_{c}_{dj}{di}"))

        top = corner(0, 0) + wi * (corner(0, 1) - corner(0, 0))
        bottom = corner(1, 0) + wi * (corner(1, 1) - corner(1, 0))
        return top + wj * (bottom - top)

    share = (F.col("col") - F.col("_block") * xsub) / F.lit(float(xsub))
    staged = joined.withColumns({f"_v{n}_{c}": at_block(c, n) for c in cols for n in (0, 1)})
    return staged.select(
        *pixels.columns,
        *[(F.col(f"_v0_{c}") + share * (F.col(f"_v1_{c}") - F.col(f"_v0_{c}"))).alias(c) for c in cols],
    )
