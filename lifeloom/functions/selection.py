"""The first rows of each group up to a cap, found by selection instead of sorting everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Ranges a group's values are cut into.
RANGES = 64
#: Most groups whose cuts and counts are broadcast.
GROUPS = 1000


def first_under_cap(df: DataFrame, group: str, value: str, tie: str, caps: DataFrame, name: str = "Position") -> DataFrame:
    """``df`` with ``name``, the place of a row in its group by ``value`` descending (NULL last), then ``tie``; places up to the
    group's ``Cap`` only (NULL = no cap).  Groups without a row in ``caps`` have no place.

    1. Quantiles cut the values of each group into ranges.
    2. Rows are counted per range; running sums tell which ranges lie inside the cap and which one holds its border.
    3. Only rows of those ranges are moved.  They are ordered range by range, each on its own, and a place is the rows in
       ranges before plus the place within.  Rows beyond the border are read, counted and left where they are.

    Rows of one value share a range; of the border range no more rows than the cap leaves are kept per input partition.
    """
    caps = caps.select(F.col(group).alias("_g"), F.col("Cap").cast("bigint").alias("_cap"))
    few = caps.limit(GROUPS + 1).count() <= GROUPS
    small = F.broadcast if few else (lambda side: side)
    fractions = F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])
    cuts = df.groupBy(F.col(group).alias("_g")).agg(F.array_distinct(F.percentile_approx(value, fractions)).alias("_cuts")).join(small(caps), "_g")
    # Values above the highest cut are range 0; rows without a value come last.
    place = F.when(F.col(value).isNull(), RANGES).otherwise(F.size(F.filter("_cuts", lambda c: c > F.col(value))))
    placed = df.join(small(cuts), F.col(group) == F.col("_g")).withColumn("_range", place).drop("_cuts", "_g")
    counts = placed.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.col("_cap").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    order = W.partitionBy("_g").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    ranges = counts.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    ranges = ranges.filter(F.col("_c").isNull() | (F.col("_before") < F.col("_c")))
    asked = placed.join(small(ranges.drop("_n", "_c")), (F.col(group) == F.col("_g")) & (F.col("_range") == F.col("_r")))
    inside = W.partitionBy(group, "_range").orderBy(F.col(value).desc(), F.col(tie))
    ranked = asked.withColumn(name, F.col("_before") + F.row_number().over(inside))
    return ranked.filter(_within(F.col(name), F.col("_cap"))).drop("_g", "_r", "_range", "_before", "_cap")


def _within(place: Column, cap: Column) -> Column:
    return cap.isNull() | (place <= cap)
