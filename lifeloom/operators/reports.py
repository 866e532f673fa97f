"""Campaign, deliverability, experiment and engagement reports.

The event views are reduced to one row of flags per (job, subscriber) before anything
is counted: no fan-out between opens, clicks and bounces, and no Expand over several
distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.asof import latest_before
from lifeloom.functions.columns import bands, by_prefix, pct
from lifeloom.functions.times import Moment, as_ts, shift

# Template-name prefixes of each journey.
JOURNEY_PREFIXES = [
    ("EMAIL_WELCOME", "Welcome"),
    ("EMAIL_CART", "Abandoned Cart"),
    ("EMAIL_PP", "Post-Purchase"),
    ("EMAIL_BIRTHDAY", "Birthday"),
    ("EMAIL_WINBACK", "Winback"),
    ("EMAIL_VIP", "VIP Retention"),
]
OTHER_JOURNEY = "Other / Ad Hoc Campaign"

# Lower bounds and labels of the engagement bands.
SCORE_BANDS = [
    (80, "80-100 (Highly Engaged)"),
    (60, "60-79 (Engaged)"),
    (40, "40-59 (Moderate)"),
    (20, "20-39 (Low)"),
]
LOWEST_BAND = "0-19 (At Risk)"

MAX_BOUNCE_PCT = 2.0
MAX_COMPLAINT_PCT = 0.1


def journey_label(name: Column) -> Column:
    return by_prefix(name, JOURNEY_PREFIXES, OTHER_JOURNEY)


def _flags(views: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """One row per key with a boolean per view: was there any event."""
    tagged = None
    for name, df in views.items():
        rows = df.select(*key, F.lit(name).alias("_view"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    present = [F.max(F.col("_view") == name).alias(name) for name in views]
    return tagged.groupBy(*key).agg(*present)


def _count(flag: str | Column) -> Column:
    condition = F.col(flag) if isinstance(flag, str) else flag
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


FACTS = ["Open", "Click", "Bounce", "Unsubscribe", "Complaint"]


def campaign_facts(
    sent: DataFrame,
    opens: DataFrame,
    clicks: DataFrame,
    bounces: DataFrame,
    unsubscribes: DataFrame,
    complaints: DataFrame,
    since: Column,
    until: Column | None = None,
) -> DataFrame:
    """Per (JobID, EmailName, SubscriberKey) sent in the period: a flag per kind of event.

    Events count whenever they happened; only the send date is filtered.
    """
    in_period = F.col("EventDate") >= since
    if until is not None:
        in_period = in_period & (F.col("EventDate") < until)
    sends = sent.filter(in_period).select("JobID", "EmailName", "SubscriberKey").distinct()
    views = dict(zip(FACTS, (opens, clicks, bounces, unsubscribes, complaints)))
    flags = _flags(views, ["JobID", "SubscriberKey"])
    return sends.join(flags, ["JobID", "SubscriberKey"], "left")


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("SentCount"), *[_count(f).alias(f"{f}Count") for f in FACTS]]


def _rates(names: list[str]) -> list[Column]:
    return [pct(F.col(f"{n}Count"), F.col("SentCount")).alias(f"{n}RatePct") for n in names]


def campaign_performance(*views: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    """Per job and template: distinct subscribers per kind of event, and rates."""
    facts = campaign_facts(*views, since=shift(as_of, -days, "day"))
    grouped = facts.groupBy("JobID", "EmailName").agg(*_counts())
    return grouped.select(
        "JobID",
        "EmailName",
        journey_label(F.col("EmailName")).alias("JourneyLabel"),
        "SentCount",
        *[f"{f}Count" for f in FACTS],
        *_rates(["Open", "Click", "Bounce", "Complaint"]),
    )


def click_rate_by_journey(*views: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    """Campaign facts rolled up to the journey (a subscriber counts once per journey)."""
    facts = campaign_facts(*views, since=shift(as_of, -days, "day")).withColumn(
        "JourneyLabel", journey_label(F.col("EmailName"))
    )
    per_person = facts.groupBy("JourneyLabel", "SubscriberKey").agg(
        F.max("Open").alias("Open"), F.max("Click").alias("Click")
    )
    return (
        per_person.groupBy("JourneyLabel")
        .agg(F.count(F.lit(1)).alias("SentCount"), _count("Open").alias("OpenCount"), _count("Click").alias("ClickCount"))
        .select("JourneyLabel", "SentCount", *_rates(["Open", "Click"]))
    )


def program_kpis(*views: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    """Program totals of the last period and the one before, and the change."""
    rows = None
    for label, start, end in (("current", -days, 0), ("prior", -2 * days, -days)):
        until = as_ts(as_of) + F.expr("INTERVAL '1' SECOND") if end == 0 else shift(as_of, end, "day")
        part = campaign_facts(*views, since=shift(as_of, start, "day"), until=until)
        total = part.agg(*_counts()).select(
            F.lit(label).alias("_period"), "SentCount", *_rates(["Open", "Click", "Bounce", "Complaint"])
        )
        rows = total if rows is None else rows.unionByName(total)
    metrics = ["SentCount", "OpenRatePct", "ClickRatePct", "BounceRatePct", "ComplaintRatePct"]
    one = rows.agg(
        *[
            F.max(F.when(F.col("_period") == p, F.col(m).cast("double"))).alias(f"{p}_{m}")
            for p in ("current", "prior")
            for m in metrics
        ]
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("Metric"), F.col(f"current_{m}").alias("CurrentValue"), F.col(f"prior_{m}").alias("PriorValue")
            )
            for m in metrics
        ]
    )
    return one.select(F.explode(pairs).alias("_m")).select(
        "_m.*", F.round(F.col("_m.CurrentValue") - F.col("_m.PriorValue"), 4).alias("Change")
    )


def deliverability(
    sent: DataFrame, bounces: DataFrame, complaints: DataFrame, as_of: Moment, bu: str, days: int = 1
) -> DataFrame:
    """Per send day: distinct counts, rates and the guardrail verdict."""
    recent = sent.filter(F.col("EventDate") >= shift(as_of, -days, "day")).select(
        F.to_date("EventDate").alias("SendDate"), "JobID", "SubscriberKey"
    )
    views = {
        "Bounce": bounces,
        "HardBounce": bounces.filter(F.col("BounceCategory") == "Hard"),
        "SoftBounce": bounces.filter(F.col("BounceCategory") == "Soft"),
        "Complaint": complaints,
    }
    per_person = (
        recent.distinct()
        .join(_flags(views, ["JobID", "SubscriberKey"]), ["JobID", "SubscriberKey"], "left")
        .groupBy("SendDate", "SubscriberKey")
        .agg(*[F.max(v).alias(v) for v in views])
    )
    daily = per_person.groupBy("SendDate").agg(
        F.count(F.lit(1)).alias("SentCount"), *[_count(v).alias(f"{v}Count") for v in views]
    )
    raw = {n: F.lit(100.0) * F.col(f"{n}Count") / F.nullif(F.col("SentCount"), F.lit(0)) for n in ("Bounce", "Complaint")}
    breach = (raw["Bounce"] > MAX_BOUNCE_PCT) | (raw["Complaint"] > MAX_COMPLAINT_PCT)
    return daily.select(
        "SendDate",
        F.lit(bu).alias("BusinessUnitMID"),
        "SentCount",
        *[f"{v}Count" for v in views],
        *_rates(["Bounce", "Complaint"]),
        F.when(breach, "BREACH").otherwise("OK").alias("GuardrailStatus"),
    )


# -- experiments ------------------------------------------------------------------
def _engaged_after(entries: DataFrame, events: DataFrame, flag: str) -> DataFrame:
    """Entries with a flag: some event of the same template at or after the entry time."""
    last = events.groupBy("SubscriberKey", F.col("EmailName").alias("_email")).agg(F.max("EventDate").alias("_last"))
    return (
        entries.join(last, ["SubscriberKey", "_email"], "left")
        .withColumn(flag, F.coalesce(F.col("_last") >= F.col("_start"), F.lit(False)))
        .drop("_last")
    )


def attributed_orders(entries: DataFrame, orders: DataFrame, group: list[str], days: int) -> DataFrame:
    """Orders placed within ``days`` of an entry, each once per group.

    All windows have one length, so an order is inside some window of a (subscriber,
    group) exactly if it is inside the one of the latest entry before it.
    """
    starts = entries.select(*group, "SubscriberKey", F.col("_start").alias("_entry"))
    groups = starts.select("SubscriberKey", *group).distinct()
    candidates = orders.select("OrderId", "SubscriberKey", "OrderDate", "OrderTotal").join(groups, "SubscriberKey")
    placed = latest_before(candidates, starts, ["SubscriberKey", *group], "OrderDate", "_entry")
    return placed.filter(F.col("OrderDate") <= F.col("_entry") + F.expr(f"INTERVAL '{days}' DAY"))


def _variant_report(
    entries: DataFrame, group: list[str], opens: DataFrame | None, clicks: DataFrame, orders: DataFrame, days: int
) -> DataFrame:
    flagged = _engaged_after(entries, clicks, "_clicked")
    if opens is not None:
        flagged = _engaged_after(flagged, opens, "_opened")
    else:
        flagged = flagged.withColumn("_opened", F.lit(False))
    people = flagged.groupBy(*group, "SubscriberKey").agg(
        F.max("_opened").alias("_opened"), F.max("_clicked").alias("_clicked")
    )
    engaged = people.groupBy(*group).agg(
        F.count(F.lit(1)).alias("Sent"), _count("_opened").alias("Opens"), _count("_clicked").alias("Clicks")
    )
    bought = (
        attributed_orders(entries, orders, group, days)
        .groupBy(*group, "SubscriberKey")
        .agg(F.sum("OrderTotal").alias("_revenue"))
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("Conversions"), F.sum("_revenue").alias("AttributedRevenue"))
    )
    return engaged.join(bought, group, "left").withColumn("Conversions", F.coalesce("Conversions", F.lit(0)))


def ab_test(
    assignments: DataFrame, opens: DataFrame, clicks: DataFrame, orders: DataFrame, test_name: str, days: int = 14
) -> DataFrame:
    """Per variant: sent, opens, clicks, conversions, rates and revenue within ``days``."""
    entries = assignments.filter(F.col("TestName") == test_name).select(
        "TestName", "Variant", "SubscriberKey", F.col("EmailNameSent").alias("_email"), F.col("EntryDate").alias("_start")
    )
    report = _variant_report(entries, ["TestName", "Variant"], opens, clicks, orders, days)
    return report.select(
        "TestName",
        "Variant",
        "Sent",
        "Opens",
        "Clicks",
        "Conversions",
        pct(F.col("Opens"), F.col("Sent")).alias("OpenRatePct"),
        pct(F.col("Clicks"), F.col("Sent")).alias("ClickRatePct"),
        pct(F.col("Conversions"), F.col("Sent")).alias("ConversionRatePct"),
        F.col("AttributedRevenue").cast("decimal(18,2)").alias("AttributedRevenue"),
    ).orderBy("Variant")


def content_selection(experiment: DataFrame, clicks: DataFrame, orders: DataFrame, days: int = 7) -> DataFrame:
    """Treatment against control: click rate, conversions and revenue within ``days``."""
    entries = experiment.select(
        "ContentVariant", "SubscriberKey", F.col("EmailName").alias("_email"), F.col("SendDate").alias("_start")
    )
    report = _variant_report(entries, ["ContentVariant"], None, clicks, orders, days)
    return report.select(
        "ContentVariant",
        "Sent",
        F.col("Clicks").alias("Clicked"),
        pct(F.col("Clicks"), F.col("Sent")).alias("ClickRatePct"),
        F.col("Conversions").alias("Converted"),
        F.col("AttributedRevenue").cast("decimal(18,2)").alias("AttributedRevenue"),
    ).orderBy("ContentVariant")


# -- engagement scores --------------------------------------------------------------
def at_latest_date(scores: DataFrame) -> DataFrame:
    newest = scores.agg(F.max("ScoreDate").alias("_newest"))
    return scores.join(F.broadcast(newest), F.col("ScoreDate") == F.col("_newest")).drop("_newest")


def engagement_distribution(scores: DataFrame) -> DataFrame:
    """Subscribers and average score per band at the latest score date, best band first."""
    current = at_latest_date(scores).withColumn(
        "ScoreBand", bands(F.col("EngagementScore"), SCORE_BANDS, LOWEST_BAND)
    )
    # Two steps instead of a distinct count: one row per subscriber and band, then sums.
    per_person = current.groupBy("ScoreBand", "SubscriberKey").agg(
        F.sum("EngagementScore").alias("_sum"), F.count("EngagementScore").alias("_n"), F.min("EngagementScore").alias("_min")
    )
    return (
        per_person.groupBy("ScoreBand")
        .agg(
            F.count(F.lit(1)).alias("SubscriberCount"),
            F.round(F.sum("_sum") / F.sum("_n"), 4).alias("AvgScoreInBand"),
            F.min("_min").alias("_lowest"),
        )
        .orderBy(F.col("_lowest").desc())
        .drop("_lowest")
    )


def latest_scores(subscribers: DataFrame, scores: DataFrame) -> DataFrame:
    """Subscribers with their score of the latest score date, lowest first."""
    return (
        subscribers.select("SubscriberKey")
        .join(at_latest_date(scores).select("SubscriberKey", "EngagementScore", "ScoreDate"), "SubscriberKey")
        .orderBy("EngagementScore", "SubscriberKey")
    )
