"""K-means on integer vectors, assigned by the threshold algorithm over per-dimension centroid lists.

Each dimension has its centroids sorted by value. A vector walks every list outward from its own
value; a centroid seen for the first time gets its exact distance. The squared gaps of the last steps
add up to a bound for all centroids not yet seen, and the walk ends when that sum is strictly above
the best exact distance, so that ties are met too. A round is one pass of a task over its vectors; it
leaves sums per centroid, which Spark adds up exactly. The driver holds the centroids alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chromasea.llm.shared import materialise

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
LIMB = 40
CHUNK = 4096


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and components (doubles) of the vectors with exactly `dimensions` components, all finite and not null."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where((F.size("embedding") == dimensions) & sound).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("components"))


def fits(dimensions: int) -> int:
    """The largest component whose squared distances fit 64 bits; above, numpy works on Python's integers."""
    return math.isqrt((1 << 62) // dimensions) // 2


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly: as 64-bit integers if all are small, else as Python's."""
    if not len(values) or np.abs(values).max() < fits(values.shape[1]) // scale:
        return np.floor(values * scale).astype(np.int64)
    # Above 2^53 a double is an integer itself, and scaling it first could overflow.
    flat = [math.floor(v * scale) if abs(v) < 2.0**53 else int(v) * scale for v in values.ravel().tolist()]
    return np.array(flat, object).reshape(values.shape)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each vector; of equally near ones the smallest number."""
    exact = vectors.dtype == object or centroids.dtype == object or np.abs(centroids).max() > fits(centroids.shape[1])
    kind, far = (object, math.inf) if exact else (np.int64, np.iinfo(np.int64).max)
    vectors, centroids = vectors.astype(kind), centroids.astype(kind)
    n, d = vectors.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")
    lists = np.take_along_axis(centroids, order, axis=0)
    above = np.empty((n, d), np.int64)
    for j in range(d):
        above[:, j] = np.searchsorted(lists[:, j], vectors[:, j])
    below = above - 1
    distances = np.full((n, k), far, kind)
    seen = np.zeros((n, k), bool)
    walking, columns = np.arange(n), np.arange(d)
    for _ in range(k):
        v, hi, lo = vectors[walking], above[walking], below[walking]
        up = np.where(hi < k, lists[np.minimum(hi, k - 1), columns] - v, far)
        down = np.where(lo >= 0, v - lists[np.maximum(lo, 0), columns], far)
        upward = up < down
        met = order[np.where(upward, np.minimum(hi, k - 1), np.maximum(lo, 0)), columns]
        above[walking] = hi + upward
        below[walking] = lo - ~upward
        fresh = np.zeros((len(walking), k), bool)
        fresh[np.arange(len(walking))[:, None], met] = True
        fresh &= ~seen[walking]
        row, number = np.nonzero(fresh)
        seen[walking] |= fresh
        distances[walking[row], number] = ((v[row] - centroids[number]) ** 2).sum(axis=1)
        frontier = (np.where(upward, up, down) ** 2).sum(axis=1)
        walking = walking[~(frontier > distances[walking].min(axis=1)) & ~seen[walking].all(axis=1)]
        if not len(walking):
            break
    best = distances.argmin(axis=1)
    return best, distances[np.arange(n), best]


def _chunks(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for i in range(0, batch.num_rows, CHUNK):
        part = batch.slice(i, CHUNK)
        flat = part.column("components").flatten().to_numpy(zero_copy_only=False)
        yield part.column("vec_id"), integers(flat.reshape(part.num_rows, -1), scale)


def limbs_of(value: int, n: int) -> list[int]:
    """`value` as n digits of LIMB bits, the last one signed: sums of them fit 64 bits."""
    out = []
    for _ in range(n - 1):
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def cluster_sums(kept: DataFrame, centroids: np.ndarray, limbs: int, scale: int = SCALE) -> dict[int, tuple[int, list[int]]]:
    """Count and exact componentwise sum of the vectors nearest to each centroid.

    A task leaves a row for each centroid, dimension and limb; what comes to the driver is as large
    as the centroids.
    """
    k, d = centroids.shape

    def add(batches):
        count = [0] * k
        total = [[0] * d for _ in range(k)]
        for batch in batches:
            for _, vectors in _chunks(batch, scale):
                number, _ = nearest(vectors, centroids)
                for c in np.unique(number).tolist():
                    mine = vectors[number == c]
                    count[c] += len(mine)
                    total[c] = [a + int(b) for a, b in zip(total[c], mine.sum(axis=0))]
        rows = [(c, -1, 0, count[c]) for c in range(k) if count[c]]
        rows += [(c, j, i, x) for c in range(k) if count[c] for j in range(d) for i, x in enumerate(limbs_of(total[c][j], limbs))]
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("cluster", "dimension", "limb", "value"), map(list, zip(*rows)))))

    parts = kept.mapInArrow(add, "cluster long, dimension long, limb long, value long")
    found = parts.groupBy("cluster", "dimension", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found:
        count, total = out.get(r.cluster, (0, [0] * d))
        if r.dimension < 0:
            count = int(r.value)
        else:
            total[r.dimension] += int(r.value) << (LIMB * r.limb)
        out[r.cluster] = (count, total)
    return out


def _array(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) <= fits(len(row)) for row in rows for x in row)
    return np.array(rows, np.int64 if small else object)


def first_centroids(kept: DataFrame, k: int = CLUSTERS, seed: int = SEED, scale: int = SCALE) -> np.ndarray:
    """The k kept vectors whose ids have the smallest hashes; rows that share an id go by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "vec_id", "components").orderBy("key", "vec_id", "components").limit(k).collect()
    return _array([[int(x) for x in integers(np.array([r.components]), scale)[0]] for r in rows])


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of the kept vectors (vec_id, embedding).

    Vectors of another length, or with a null or non-finite component, are left out; fewer than k
    vectors make fewer centroids, none give no rows. Null ids are hashed as empty text, repeated
    rows stay rows of their own. A distance (or sum of them) that doesn't fit a long is null; it still
    counts exactly for the assignment. Other columns are left out.
    """
    spark = vectors.sparkSession
    kept = materialise(kept_vectors(vectors, dimensions), "vectors")
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(kept, k, seed, scale)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    largest = kept.agg(F.max(F.array_max(F.transform("components", F.abs))).alias("m")).first().m
    # Room for the sum of 2^60 rows of the largest component.
    limbs = (int(largest + 1).bit_length() + scale.bit_length() + 60) // LIMB + 1
    for _ in range(rounds):
        rows = [[int(x) for x in c] for c in centroids]
        for number, (count, total) in cluster_sums(kept, centroids, limbs, scale).items():
            rows[number] = [x // count for x in total]
        centroids = _array(rows)

    def assign(batches):
        for batch in batches:
            for ids, found in _chunks(batch, scale):
                number, distance = nearest(found, centroids)
                fitting = [x if x < 1 << 63 else None for x in map(int, distance)]
                yield pa.RecordBatch.from_pydict({"vec_id": ids, "cluster": pa.array(number, pa.int32()), "distance": pa.array(fitting, pa.int64())})

    assigned = materialise(kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    whole = F.count("*") == F.count("distance")
    totals = {
        r.cluster: r.total
        for r in assigned.groupBy("cluster").agg(F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("total")).collect()
    }

    def fitting(x):
        return None if x is None or int(x) >= 1 << 63 else int(x)

    everything = None if None in totals.values() else fitting(sum(totals.values()))
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    at = F.col("cluster") + 1
    return assigned.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*(F.lit(fitting(totals.get(c))).cast("long") for c in range(len(centroids)))), at).alias("cluster_inertia"),
        F.lit(everything).cast("long").alias("inertia"), F.element_at(F.array(*map(F.lit, digests)), at).alias("centroid_sha256"),
    )
