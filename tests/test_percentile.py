"""Exact percentiles against numpy."""

import numpy as np
import pytest

from lifeloom.functions import percentile
from lifeloom.functions.percentile import exact_percentile


@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_against_sorting(spark, monkeypatch, accuracy):
    monkeypatch.setattr(percentile, "ACCURACY", accuracy)
    rng = np.random.default_rng(7)
    columns = [
        rng.normal(size=3000), rng.integers(0, 4, 3000).astype(float), np.where(rng.random(2000) < 0.5, 1.5, rng.normal(size=2000)),
        np.arange(4.0), np.array([2.0]), np.array([1.0, 5.0]), rng.normal(size=19),
    ]
    for values in columns:
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x DOUBLE").repartition(3)
        for share in (0.0, 0.1, 0.3, 0.5, 0.9, 1.0):
            got = exact_percentile(df, "x", share).first().value
            assert got == pytest.approx(np.quantile(values, share), rel=1e-12, abs=1e-12), (len(values), share)


def test_no_values(spark):
    assert [r.value for r in exact_percentile(spark.createDataFrame([(None,)], "x DOUBLE"), "x", 0.5).collect()] == [None]
