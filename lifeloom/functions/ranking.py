"""Ranking that stays distributed when one group holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lifeloom.session import settle


def first_k(df: DataFrame, group: list[str], order: list[Column], k: int, name: str = "Rank") -> DataFrame:
    """First ``k`` rows per group.

    The ``row_number <= k`` filter becomes a WindowGroupLimit on both sides of the
    exchange, so a hot group ships at most ``k`` rows per input partition.
    """
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)


def positions(df: DataFrame, group: list[str], order: list[Column], name: str = "Position") -> DataFrame:
    """Gap-free 1-based position of every row within its group, without a per-group task.

    Rows are range-partitioned by (group, order); each slice is numbered on its own
    and shifted by the row counts of the slices before it.  The checkpoint pins the
    slice of every row, because range bounds are sampled anew by each execution.
    """
    sliced = settle(
        df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_slice", F.spark_partition_id())
    )
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*group, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = W.partitionBy(*group, "_slice").orderBy(*order)
    # A null group is a group like any other.
    same = [F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in [*group, "_slice"]]
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(starts.withColumnsRenamed({c: f"_s{c}" for c in [*group, "_slice"]}), same)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_slice", "_inside", "_start", *[f"_s{c}" for c in [*group, "_slice"]])
    )
