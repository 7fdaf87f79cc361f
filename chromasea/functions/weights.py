"""Space and time weights of the climatology (W-03, X-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: weight by number of axes on which the neighbour is off centre ---
SPATIAL_WEIGHTS = (1.0, 0.5, 0.25)
# --- end of fixed values ---


def temporal_weight(offset: Column, half: int) -> Column:
    """W-03. Triangle of half-width `half` days: 1 at the target day."""
    return (F.lit(half + 1) - F.abs(offset)) / F.lit(float(half + 1))


def spatial_weight(dy: Column, dx: Column) -> Column:
    """X-02. Weight of a 3x3 neighbour."""
    centre, edge, corner = SPATIAL_WEIGHTS
    off = F.abs(dy) + F.abs(dx)
    return F.when(off == 0, centre).when(off == 1, edge).when(off == 2, corner)


def full_weight(half: int) -> float:
    """Sum of all weights of one year's complete window."""
    centre, edge, corner = SPATIAL_WEIGHTS
    triangle = sum((half + 1 - abs(d)) / (half + 1) for d in range(-half, half + 1))
    return (centre + 4 * edge + 4 * corner) * triangle
