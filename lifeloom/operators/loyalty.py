"""Loyalty tiers, enrolment, points, birthdays and tier offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.columns import bands, joined, mapped
from lifeloom.functions.times import Moment, as_ts, local_day, shift
from lifeloom.sources.tables import updated_from

# Lower spend bound of each tier above Bronze, highest first.
THRESHOLDS: list[tuple[float, str]] = [(5000, "Platinum"), (2000, "Gold"), (500, "Silver")]
# Points per currency unit.
POINT_RATES = {"Platinum": 2.0, "Gold": 1.5, "Silver": 1.25, "Bronze": 1.0}
# Birthday gift text and code of each tier.
TIER_OFFERS = {
    "Platinum": ("30% off + a surprise gift with your order", "BDAYPLAT30"),
    "Gold": ("25% off + free gift wrapping", "BDAYGOLD25"),
    "Silver": ("20% off + free shipping", "BDAYSILV20"),
    "Bronze": ("15% off your next order", "BDAYBRZ15"),
}

NOT_SPEND = ["Cancelled", "Returned"]


def trailing_spend(orders: DataFrame, as_of: Moment, months: int = 12) -> DataFrame:
    return (
        orders.filter(~F.col("OrderStatus").isin(*NOT_SPEND) & (F.col("OrderDate") >= shift(as_of, -months, "month")))
        .groupBy("SubscriberKey")
        .agg(F.sum("OrderTotal").cast("decimal(18,2)").alias("TTMSpend"))
    )


def tier_of(spend: Column, thresholds=THRESHOLDS) -> Column:
    return bands(spend, thresholds, "Bronze")


def to_next_tier(spend: Column, thresholds=THRESHOLDS) -> Column:
    """Spend still missing to the next tier; NULL at the top."""
    bounds = [bound for bound, _ in thresholds]
    expr = F.when(spend >= bounds[0], F.lit(None))
    for upper, lower in zip(bounds, bounds[1:]):
        expr = expr.when(spend >= lower, F.lit(upper) - spend)
    return expr.otherwise(F.lit(bounds[-1]) - spend)


def recalculate_tiers(
    loyalty: DataFrame, orders: DataFrame, as_of: Moment, thresholds=THRESHOLDS
) -> DataFrame:
    """Every member's tier from the last 12 months; members without orders fall to zero spend."""
    spend = loyalty.select("SubscriberKey").join(trailing_spend(orders, as_of), "SubscriberKey", "left")
    scored = spend.select("SubscriberKey", F.coalesce("TTMSpend", F.lit(0).cast("decimal(18,2)")).alias("_spend"))
    scored = scored.withColumn("_tier", tier_of(F.col("_spend"), thresholds))
    now = as_ts(as_of)
    moved = ~F.col("CurrentTier").eqNullSafe(F.col("_tier"))
    return updated_from(
        loyalty,
        scored,
        ["SubscriberKey"],
        F.lit(True),
        {
            "TrailingTwelveMonthSpend": F.col("_spend"),
            "CurrentTier": F.col("_tier"),
            "PointsToNextTier": to_next_tier(F.col("_spend"), thresholds),
            "TierEffectiveDate": F.when(moved, now).otherwise(F.col("TierEffectiveDate")),
            "TierExpirationDate": shift(as_of, 12, "month"),
            "LastRecalculatedDate": now,
        },
    )


def enroll(loyalty: DataFrame, orders: DataFrame, as_of: Moment, thresholds=THRESHOLDS) -> DataFrame:
    """Loyalty rows to add for buyers who are not members yet."""
    spend = trailing_spend(orders, as_of).join(loyalty.select("SubscriberKey"), "SubscriberKey", "left_anti")
    return spend.select(
        "SubscriberKey",
        joined("LOY-", F.col("SubscriberKey")).alias("LoyaltyMemberId"),
        tier_of(F.col("TTMSpend"), thresholds).alias("CurrentTier"),
        F.lit(0).cast("bigint").alias("PointsBalance"),
        F.col("TTMSpend").alias("TrailingTwelveMonthSpend"),
        as_ts(as_of).alias("EnrollmentDate"),
        as_ts(as_of).alias("LastRecalculatedDate"),
    )


def points_earned(loyalty: DataFrame) -> DataFrame:
    """Whole points for the trailing spend at the member's tier rate."""
    rate = mapped(F.col("CurrentTier"), {t: str(r) for t, r in POINT_RATES.items()}, F.lit("1.0")).cast("double")
    return loyalty.select(
        "SubscriberKey",
        "CurrentTier",
        F.floor(F.col("TrailingTwelveMonthSpend").cast("double") * rate).cast("bigint").alias("PointsEarned"),
    )


def with_tier_offer(entries: DataFrame) -> DataFrame:
    tier = F.coalesce(F.nullif("CurrentTier", F.lit("")), F.lit("Bronze"))
    text = mapped(tier, {t: o[0] for t, o in TIER_OFFERS.items()}, F.lit(TIER_OFFERS["Bronze"][0]))
    code = mapped(tier, {t: o[1] for t, o in TIER_OFFERS.items()}, F.lit(TIER_OFFERS["Bronze"][1]))
    return entries.withColumn("OfferText", text).withColumn("PromoCode", code)


def birthday_entries(
    subscribers: DataFrame, loyalty: DataFrame, birthday_log: DataFrame, as_of: Moment, zone: str = "UTC"
) -> DataFrame:
    """Reachable subscribers whose birthday is today in the unit's zone and who have no entry this year."""
    today = local_day(as_of, zone)
    this_year = F.year(today)
    due = subscribers.filter(
        (F.col("SubscriberStatus") == "Active")
        & F.col("EmailOptIn")
        & (F.month("DateOfBirth") == F.month(today))
        & (F.dayofmonth("DateOfBirth") == F.dayofmonth(today))
    )
    logged = birthday_log.filter(F.col("BirthdayYear") == this_year).select("SubscriberKey")
    tiers = loyalty.select("SubscriberKey", "CurrentTier")
    return (
        due.join(logged, "SubscriberKey", "left_anti")
        .join(tiers, "SubscriberKey", "left")
        .select(
            "SubscriberKey",
            "EmailAddress",
            "FirstName",
            F.coalesce("CurrentTier", F.lit("Bronze")).alias("CurrentTier"),
            this_year.alias("BirthdayYear"),
        )
    )


def birthday_log_rows(entries: DataFrame, as_of: Moment) -> DataFrame:
    return entries.select("SubscriberKey", "BirthdayYear", as_ts(as_of).alias("EnteredDate"))
