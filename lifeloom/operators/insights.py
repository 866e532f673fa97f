"""Per-individual insights, rule segments and activation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.columns import all_of
from lifeloom.functions.ranking import first_k
from lifeloom.functions.times import Moment, as_ts, days_between

NOT_SPEND = ["Cancelled", "Returned"]
# Spend and recency bounds of the churn segments.
HIGH_VALUE = 5000
HIGH_VALUE_QUIET_DAYS = 90
LOW_VALUE_QUIET_DAYS = 180


def lifetime_value(
    individuals: DataFrame, orders: DataFrame, as_of: Moment, high_value: float = HIGH_VALUE
) -> DataFrame:
    """Per individual: spend, orders, average order, tenure, recency and churn segment."""
    spent = orders.filter(~F.col("OrderStatus").isin(*NOT_SPEND))
    # The single distinct count is exchanged on (BuyerId, OrderId) before it is combined per
    # buyer, so one buyer's orders never meet in one task unreduced.
    per_buyer = spent.groupBy("BuyerId").agg(
        F.sum("OrderTotal").cast("decimal(18,2)").alias("LifetimeSpend"),
        F.count_distinct("OrderId").alias("LifetimeOrderCount"),
        F.min("OrderDate").alias("_first"),
        F.max("OrderDate").alias("LastOrderDate"),
    )
    known = per_buyer.join(
        individuals.select(F.col("UnifiedIndividualId").alias("BuyerId")), "BuyerId", "left_semi"
    )
    recency = days_between(F.col("LastOrderDate"), as_ts(as_of)).cast("bigint")
    segment = (
        F.when((F.col("LifetimeSpend") >= high_value) & (F.col("DaysSinceLastOrder") >= HIGH_VALUE_QUIET_DAYS), "HighValueAtRisk")
        .when(F.col("LifetimeSpend") >= high_value, "HighValueActive")
        .when(F.col("DaysSinceLastOrder") >= LOW_VALUE_QUIET_DAYS, "LowValueAtRisk")
        .otherwise("Standard")
    )
    # Decimal division: exact, so a half cent rounds up whatever its binary form.
    average = F.col("LifetimeSpend") / F.nullif(F.col("LifetimeOrderCount"), F.lit(0)).cast("decimal(18,0)")
    return (
        known.withColumn("DaysSinceLastOrder", recency)
        .select(
            F.col("BuyerId").alias("UnifiedIndividualId"),
            "LifetimeSpend",
            "LifetimeOrderCount",
            average.cast("decimal(18,2)").alias("AvgOrderValue"),
            days_between(F.col("_first"), F.col("LastOrderDate")).cast("bigint").alias("CustomerTenureDays"),
            "LastOrderDate",
            "DaysSinceLastOrder",
            segment.alias("ChurnRiskSegment"),
        )
    )


def category_spend(orders: DataFrame, lines: DataFrame) -> DataFrame:
    spent = orders.filter(~F.col("OrderStatus").isin(*NOT_SPEND)).select("OrderId", "BuyerId")
    return (
        spent.join(lines.select("OrderId", "Category", "LineTotal"), "OrderId")
        .groupBy("BuyerId", "Category")
        .agg(F.sum("LineTotal").cast("decimal(18,2)").alias("CategorySpend"))
    )


def category_affinity(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Top and second category by spend per individual."""
    ranked = first_k(
        category_spend(orders, lines), ["BuyerId"], [F.col("CategorySpend").desc(), F.col("Category")], 2, "_rank"
    )
    first, second = F.col("_rank") == 1, F.col("_rank") == 2
    return ranked.groupBy(F.col("BuyerId").alias("UnifiedIndividualId")).agg(
        F.max(F.when(first, F.col("Category"))).alias("TopCategory"),
        F.max(F.when(second, F.col("Category"))).alias("SecondCategory"),
        F.max(F.when(first, F.col("CategorySpend"))).alias("TopCategorySpend"),
    )


def merged_insights(value: DataFrame, affinity: DataFrame, as_of: Moment) -> DataFrame:
    """Both insights in one row per individual."""
    return (
        value.drop("CustomerTenureDays", "LastOrderDate")
        .join(affinity.drop("TopCategorySpend"), "UnifiedIndividualId", "left")
        .withColumn("LastRefreshedDate", as_ts(as_of))
    )


def activated(insights: DataFrame, bridge: DataFrame) -> DataFrame:
    """Insights by subscriber, through the identity bridge."""
    links = bridge.select("UnifiedIndividualId", "SubscriberKey").distinct()
    return links.join(insights, "UnifiedIndividualId")


_OPERATORS = {
    "equals": lambda c, v: c == v,
    "notEquals": lambda c, v: c != v,
    "greaterThan": lambda c, v: c > v,
    "greaterThanOrEqual": lambda c, v: c >= v,
    "lessThan": lambda c, v: c < v,
    "lessThanOrEqual": lambda c, v: c <= v,
}


def segment(df: DataFrame, rule: dict) -> DataFrame:
    """Rows that meet every ``{field, operator, value}`` condition of a rule document."""
    if rule.get("operator", "AND") != "AND":
        raise ValueError("segment rules combine conditions with AND")
    tests = []
    for condition in rule["conditions"]:
        name = condition["operator"]
        if name not in _OPERATORS:
            raise ValueError(f"unknown operator {name!r}")
        tests.append(_OPERATORS[name](F.col(condition["field"]), F.lit(condition["value"])))
    return df.filter(all_of(tests))


# The high-value-at-risk rule.
HIGH_VALUE_AT_RISK = {
    "operator": "AND",
    "conditions": [
        {"field": "ChurnRiskSegment", "operator": "equals", "value": "HighValueAtRisk"},
        {"field": "DaysSinceLastOrder", "operator": "greaterThanOrEqual", "value": 90},
        {"field": "DaysSinceLastOrder", "operator": "lessThan", "value": 270},
    ],
}


def high_value_at_risk(insights: DataFrame, bridge: DataFrame) -> DataFrame:
    chosen = segment(insights, HIGH_VALUE_AT_RISK)
    return activated(chosen, bridge).select("SubscriberKey", "UnifiedIndividualId", "LifetimeSpend", "DaysSinceLastOrder")
