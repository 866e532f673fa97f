"""Join-side choice by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sized(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it is proven to have at most ``max_rows`` rows.

    The count stops at ``max_rows + 1``.  A larger side is returned as it is and the join
    becomes a shuffle join, in which adaptive execution splits hot keys.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
