"""Exact percentiles of columns with any number of different values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rank error of the estimate, as one in so many rows; the bracket is twice as wide on either side.
ACCURACY = 10_000


def exact_percentile(df: DataFrame, value: str, share: float, name: str = "value") -> DataFrame:
    """One row with the ``share`` percentile of ``value`` (continuous: between two rows it interpolates); NULL without values.

    1. An estimate with a known rank error gives two values between which the percentile lies.
    2. What is below the bracket is counted, together with the values just outside it, for the bracket may miss a rank when
       there are fewer rows than the accuracy.
    3. Only the bracket, about four rows in ACCURACY, is counted value by value and read off in order.

    So no task sees all values, whatever their number; a value on many rows is one line of the bracket.
    """
    values = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    margin = 2.0 / ACCURACY
    ends = F.percentile_approx("v", F.array(F.lit(max(share - margin, 0.0)), F.lit(min(share + margin, 1.0))), F.lit(ACCURACY))
    bracket = values.agg(F.count(F.lit(1)).alias("n"), ends.alias("ends"))
    bracket = bracket.select("n", F.col("ends")[0].alias("lo"), F.col("ends")[1].alias("hi"))
    met = values.crossJoin(F.broadcast(bracket))  # one row on the right
    outside = met.agg(
        F.count_if(F.col("v") < F.col("lo")).alias("below"),
        F.max(F.when(F.col("v") < F.col("lo"), F.col("v"))).alias("before"),
        F.min(F.when(F.col("v") > F.col("hi"), F.col("v"))).alias("after"),
        F.max("n").alias("n"),
    )
    inside = met.filter(F.col("v").between(F.col("lo"), F.col("hi"))).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    upto = inside.select("v", F.sum("c").over(W.orderBy("v").rowsBetween(W.unboundedPreceding, 0)).alias("upto"))
    # Sums of rows up to each value, after those below the bracket.
    lines = upto.crossJoin(F.broadcast(outside))
    place = (F.col("n") - 1) * F.lit(share)
    rank = F.floor(place)

    def at(r):
        here = F.min(F.when(F.col("below") + F.col("upto") > r, F.col("v")))
        first = F.first("below")
        return F.when(F.first(r) < first, F.first("before")).otherwise(F.coalesce(here, F.first("after")))

    found = lines.agg(at(rank).alias("a"), at(rank + 1).alias("b"), F.first(place - rank).alias("part"))
    between = F.when(F.col("part") > 0, F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).otherwise(F.col("a"))
    return found.select(between.alias(name))
