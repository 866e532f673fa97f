"""As-of lookups between two time-stamped tables.

Neither side is paired with the other: both are merged into one time line per
key, cut into slices so that a hot key spreads over many tasks, and the
nearest value is carried along.  Work is O(n log n) in the number of rows, also
for a key that holds a third of them.

Slices are calendar units, and where a key has very many rows in one unit, that
unit is cut again at quantiles of its times: slices follow the density of the data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


#: A (key, unit) is hot if it has more rows than FLOOR and more than one in SHARE of all rows; fewer than SHARE can be.
FLOOR = 100_000
SHARE = 10_000
#: Slices that a hot unit is cut into.
PIECES = 64


def sliced(line: DataFrame, keys: list[str], ts: str, unit: str, floor: int | None = None) -> DataFrame:
    """``line`` with ``_slice``: ascending in time per key, and of a size that one task can take.

    Rows are counted per key and unit in one narrow pass.  Only hot units are read once more, for quantiles of their times;
    their cuts, fewer than SHARE short lists, are broadcast.  Rows of one instant share a slice.
    """
    floor = FLOOR if floor is None else floor
    start = F.date_trunc(unit, F.col(ts))
    cell = [*keys, "_unit"]
    cells = line.select(*keys, start.alias("_unit"), F.col(ts).alias("_time"))
    counts = cells.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > floor)
    # Rows outside such cells count as little as possible: the bound on the number of hot cells holds for them alone.
    total = counts.agg(F.sum("_n").alias("_total"))
    hot = counts.join(F.broadcast(total), F.col("_n") * SHARE > F.col("_total")).select(*[F.col(c).alias(f"_h{c}") for c in cell])
    same = [F.col(c).eqNullSafe(F.col(f"_h{c}")) for c in cell]
    fractions = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    cuts = (
        cells.join(F.broadcast(hot), same).groupBy(*[f"_h{c}" for c in cell])
        .agg(F.array_distinct(F.percentile_approx("_time", fractions)).alias("_cuts"))
    )
    placed = line.withColumn("_unit", start).join(F.broadcast(cuts), same, "left").drop(*[f"_h{c}" for c in cell])
    piece = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col(ts))))
    return placed.withColumn("_slice", F.struct(F.col("_unit").alias("unit"), piece.alias("piece"))).drop("_unit", "_cuts")


def _carry(
    probes: DataFrame,
    facts: DataFrame,
    key: list[str],
    probe_ts: str,
    fact_ts: str,
    values: list[str],
    slice_unit: str,
    forward: bool,
) -> DataFrame:
    kept = probes.columns
    value = F.struct(F.col(fact_ts).alias("_at"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])
    left = probes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
        F.col(probe_ts).alias("_ts"),
        F.lit(1).alias("_probe"),
        F.struct(*kept).alias("_row"),
    )
    # A null key equals nothing: such facts match no probe, and such probes find no fact.
    known = [F.col(c).isNotNull() for c in (fact_ts, *key)]
    right = facts.filter(reduce(lambda a, b: a & b, known)).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)],
        F.col(fact_ts).alias("_ts"),
        F.lit(0).alias("_probe"),
        value.alias("_value"),
    )
    keys = [f"_k{i}" for i in range(len(key))]
    line = sliced(left.unionByName(right, allowMissingColumns=True), keys, "_ts", slice_unit)
    # Facts sort before probes going backward and the reverse reading order going
    # forward, so that equal times always match.
    if forward:
        order = [F.col("_ts").desc(), F.col("_probe"), F.col("_value").desc()]
        slices, best = F.col("_slice").desc(), F.min("_value")
    else:
        order = [F.col("_ts"), F.col("_probe"), F.col("_value")]
        slices, best = F.col("_slice"), F.max("_value")
    inside = W.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    outside = W.partitionBy(*keys).orderBy(slices).rowsBetween(W.unboundedPreceding, -1)

    near = line.withColumn("_near", F.last("_value", ignorenulls=True).over(inside)).filter("_probe = 1")
    far = (
        line.groupBy(*keys, "_slice")
        .agg(best.alias("_value"))
        .select(*keys, "_slice", F.last("_value", ignorenulls=True).over(outside).alias("_far"))
    )
    same = [near[k].eqNullSafe(far[k]) for k in keys] + [near["_slice"].eqNullSafe(far["_slice"])]
    hit = near.join(far, same, "left").select(
        "_row", F.when(F.col("_ts").isNotNull(), F.coalesce("_near", "_far")).alias("_hit")
    )
    return hit.select(
        "_row.*",
        F.col("_hit._at").alias(fact_ts if fact_ts not in kept else f"Matched{fact_ts}"),
        *[F.col(f"_hit._v{i}").alias(v if v not in kept else f"Matched{v}") for i, v in enumerate(values)],
    )


def latest_before(
    probes: DataFrame,
    facts: DataFrame,
    key: list[str],
    probe_ts: str,
    fact_ts: str,
    values: list[str] = (),
    slice_unit: str = "month",
) -> DataFrame:
    """Each probe with the last fact at or before its time (NULLs when there is none)."""
    return _carry(probes, facts, key, probe_ts, fact_ts, list(values), slice_unit, forward=False)


def earliest_after(
    probes: DataFrame,
    facts: DataFrame,
    key: list[str],
    probe_ts: str,
    fact_ts: str,
    values: list[str] = (),
    slice_unit: str = "month",
) -> DataFrame:
    """Each probe with the first fact at or after its time (NULLs when there is none)."""
    return _carry(probes, facts, key, probe_ts, fact_ts, list(values), slice_unit, forward=True)


def previous_value(
    df: DataFrame, key: list[str], ts: str, value: str, name: str, tiebreak: list[str] = (), slice_unit: str = "month"
) -> DataFrame:
    """``lag(value)`` per key in time order, computed slice by slice."""
    order = [F.col(ts), *[F.col(t) for t in tiebreak]]
    cut = sliced(df, key, ts, slice_unit)
    inside = W.partitionBy(*key, "_slice").orderBy(*order)
    boxed = F.struct(F.col(value).alias("v"))
    near = cut.withColumn("_near", F.lag(boxed).over(inside))
    across = W.partitionBy(*key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    closing = F.max_by(boxed, F.struct(*order))
    far = (
        cut.groupBy(*key, "_slice")
        .agg(closing.alias("_close"))
        .select(*key, "_slice", F.last("_close").over(across).alias("_far"))
    )
    parts = [*key, "_slice"]
    far = far.withColumnsRenamed({c: f"_f{c}" for c in parts})
    return (
        near.join(far, [F.col(c).eqNullSafe(F.col(f"_f{c}")) for c in parts], "left")
        .withColumn(name, F.coalesce("_near", "_far")["v"])
        .drop("_slice", "_near", "_far", *[f"_f{c}" for c in parts])
    )
