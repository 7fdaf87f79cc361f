import hashlib
import math

import numpy as np
import pytest
from llm_helpers import SF
from pyspark.sql import functions as F

from chromasea.llm import centroids as ce
from chromasea.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>"


def plain(rows, dimensions, k=8, rounds=10):
    """All distances, with Python's integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    means = [v for _, v in ordered[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, g in groups.items():
            means[n] = [sum(x) // len(g) for x in zip(*g)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, m in found if m == n) for n in range(k)}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), digests[n]) for i, d, n in found), key=str)


def run(df, **options):
    return sorted((tuple(r) for r in ce.cluster(df, **options).collect()), key=str)


@pytest.mark.parametrize("factor", [1, 10**13])
def test_threshold_walk_finds_the_first_nearest(factor):
    r = np.random.default_rng(factor % 7)
    for _ in range(60):
        k, d = int(r.integers(1, 9)), int(r.integers(1, 6))
        kind = np.int64 if factor == 1 else object
        v, c = r.integers(-3, 4, (50, d)).astype(kind) * factor, r.integers(-3, 4, (k, d)).astype(kind) * factor
        every = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        number, distance = ce.nearest(v, c)
        assert number.tolist() == every.argmin(axis=1).tolist() and distance.tolist() == every.min(axis=1).tolist()


def test_integers_are_exact():
    values = np.array([[0.5 / 1024, -0.5 / 1024, -1.0, 3.0e38, -(2.0**60) - 2**20, 1.7e308]])
    assert ce.integers(values).tolist()[0] == [0, -1, -1024, int(3.0e38) * 1024, int(-(2.0**60) - 2**20) * 1024, int(1.7e308) * 1024]
    assert ce.integers(values[:, :3]).dtype == np.int64


def test_limbs_add_up():
    for x in (0, 5, -1, -(10**30), 10**30):
        assert sum(part << (ce.LIMB * i) for i, part in enumerate(ce.limbs_of(x, 4))) == x


def test_awkward_vectors(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.integers(-2, 3, 3).astype(float).tolist()) for i in range(60)]
    rows += rows[:5] + [(None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (3, [2.0, 0.0, 1.5])]
    bad = [(900, None), (901, [1.0, 2.0]), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [1.0, float("inf"), 2.0]), (905, [])]
    df = spark.createDataFrame(rows + bad, VECTORS).withColumn("cluster", F.lit("clash")).withColumn("components", F.lit(1)).repartition(4)
    assert run(df, dimensions=3) == plain(rows, 3)


def test_far_vectors(spark):
    rows = [(i, [float(i % 3) * 1e30, -float(i)]) for i in range(12)]
    got = run(spark.createDataFrame(rows, VECTORS), dimensions=2, k=2)
    assert [(i, n, d if d < 2**63 else None) for i, n, d, *_ in plain(rows, 2, k=2)] == [x[:3] for x in got]


def test_few_and_no_vectors(spark):
    rows = [(1, [0.0, 1.0]), (2, [5.0, 5.0])]
    assert run(spark.createDataFrame(rows, VECTORS), dimensions=2) == plain(rows, 2)
    assert run(spark.createDataFrame([], VECTORS)) == []


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_threshold_centroids"](spark, SF).collect()), key=str) == plain(rows, 64)
