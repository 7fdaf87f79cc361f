"""Helpers shared by the tests of this folder."""

import random

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, name="documents"):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def words(n, seed, size=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(size)}" for _ in range(n)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(parts)
