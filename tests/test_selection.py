"""First rows under a cap against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from lifeloom.functions import selection


@pytest.mark.parametrize("seed,ranges", [(1, 7), (2, 500), (3, 2)])
def test_places_under_caps(spark, monkeypatch, seed, ranges):
    monkeypatch.setattr(selection, "RANGES", ranges)
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), rng.choice([None, 5, 5, 5, rng.randrange(100)]), f"k{i:04}") for i in range(1500)]
    rows += [("d", None, f"d{i}") for i in range(5)] + [("e", 1, "e0"), (None, 1, "n0")]
    caps = [("a", 17), ("b", None), ("c", 700), ("d", 3), ("x", 9), ("f", 0)]
    got = selection.first_under_cap(
        spark.createDataFrame(rows, "g STRING, v INT, k STRING").repartition(5), "g", "v", "k", spark.createDataFrame(caps, "g STRING, Cap INT")
    )
    want = set()
    for g, cap in caps:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {(*r, i + 1) for i, r in enumerate(own) if cap is None or i < cap}
    assert {tuple(r) for r in got.collect()} == want and got.columns == ["g", "v", "k", "Position"]


def test_rows_beyond_the_border_are_not_moved(spark):
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.col("id").alias("v"), F.col("id").cast("string").alias("k"))
    caps = spark.createDataFrame([("a", 50)], "g STRING, Cap INT")
    got = selection.first_under_cap(df, "g", "v", "k", caps)
    assert got.agg(F.min("v"), F.count("*")).first() == (19_950, 50)
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
