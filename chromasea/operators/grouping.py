"""Greedy grouping of overlapping granules (O-03)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Axes of the cuts that part a day into blocks, in turn.
CUTS = ("y", "x", "y")


class _OpenGroups:
    """Extents of the groups of one day that can still grow, oldest first."""

    def __init__(self) -> None:
        self.box = np.empty((64, 4), dtype=np.int64)
        self.ids, self.size = np.empty(64, dtype=np.int64), np.empty(64, dtype=np.int64)
        self.open = self.last = 0

    def _open_group(self, box: tuple[int, int, int, int], cap: int) -> int:
        if self.open == len(self.ids):
            self.box = np.concatenate([self.box, np.empty_like(self.box)])
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.size = np.concatenate([self.size, np.empty_like(self.size)])
        self.last += 1
        if cap > 1:
            self.box[self.open], self.ids[self.open], self.size[self.open] = box, self.last, 1
            self.open += 1
        return self.last

    def place(self, y0: int, y1: int, x0: int, x1: int, cap: int) -> int:
        b = self.box[:self.open]
        hits = np.flatnonzero((b[:, 0] <= y1) & (b[:, 1] >= y0) & (b[:, 2] <= x1) & (b[:, 3] >= x0))
        if not hits.size:
            return self._open_group((y0, y1, x0, x1), cap)
        at, n = hits[0], self.open
        group = int(self.ids[at])
        self.size[at] += 1
        if self.size[at] < cap:
            b[at] = (min(b[at, 0], y0), max(b[at, 1], y1), min(b[at, 2], x0), max(b[at, 3], x1))
        else:
            for values in (self.box, self.ids, self.size):
                values[at:n - 1] = values[at + 1:n]
            self.open -= 1
        return group


def separate_blocks(granules: DataFrame, day: str = "obs_date", order: str = "granule_index") -> tuple[DataFrame, list[str]]:
    """Granules with the columns that tell their block within the day, and the names of these columns.

    Cuts run through gaps along y, then along x in each part, then along y again, found by running maxima. All of them keep the
    partitioning by day of the first; only the order changes.
    """
    blocks, names = granules, []
    for n, axis in enumerate(CUTS):
        rows = W.partitionBy(day, *names).orderBy(f"{axis}_min", f"{axis}_max", order)
        reach = F.max(f"{axis}_max").over(rows.rowsBetween(W.unboundedPreceding, -1))
        fresh = blocks.withColumn("_fresh", F.when(F.col(f"{axis}_min") > reach, 1).otherwise(0))
        blocks = fresh.withColumn(f"_block{n}", F.sum("_fresh").over(rows.rowsBetween(W.unboundedPreceding, 0))).drop("_fresh")
        names.append(f"_block{n}")
    return blocks, names


def group_granules(granules: DataFrame, cap: int, th: int = -1, day: str = "obs_date",
                   order: str = "granule_index") -> DataFrame:
    """O-03. Groups of at most `cap` granules per day, each growing from its first granule.

    In listing order every granule joins the first group, not yet full, whose
    grown extent it meets (rule J-05), or opens a new one; this gives the groups
    of a repeated scan in a single pass.

    A group never spans a gap between the rows of its day, nor one between the columns of such a block, and so on: each cut leaves
    blocks that no group leaves, so a day falls into separated regions by cuts along y, x and y again. Blocks are
    independent: each is one sequential pass over the sorted catalogue (one row
    per granule), streamed in Arrow batches, and a task holds the extents of open
    groups only. Group numbers of the day follow from each group's first granule.
    A day without gaps either way is one block.
    """
    kept = granules if th < 0 else granules.where(F.col("n_valid") > th)
    blocks, block = separate_blocks(kept, day, order)
    schema = T.StructType([*blocks.schema.fields, T.StructField("_group", T.LongType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, groups = None, _OpenGroups()
        for pdf in batches:
            out = np.empty(len(pdf), dtype=np.int64)
            boxes = zip(pdf[day], zip(*(pdf[b] for b in block)), pdf["y_min"], pdf["y_max"], pdf["x_min"], pdf["x_max"])
            for i, (d, part, *box) in enumerate(boxes):
                if (d, part) != current:
                    current, groups = (d, part), _OpenGroups()
                out[i] = groups.place(*box, cap)
            yield pdf.assign(_group=out)

    placed = blocks.repartition(day, *block).sortWithinPartitions(day, *block, order).mapInPandas(assign, schema)
    # Groups are numbered behind the same pass: by windows over its rows, not by a second reading of it.
    first = F.min(order).over(W.partitionBy(day, *block, "_group"))
    number = F.dense_rank().over(W.partitionBy(day).orderBy("_first", *block, "_group")).cast("bigint")
    return placed.withColumn("_first", first).withColumn("group_id", number).select(*granules.columns, "group_id")


def group_limits(grouped: DataFrame, day: str = "obs_date") -> DataFrame:
    """Extent and size of every group."""
    return grouped.groupBy(day, "group_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("y_min").alias("y_min"), F.max("y_max").alias("y_max"),
        F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"),
    )
