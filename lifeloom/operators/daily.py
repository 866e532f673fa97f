"""Campaign reach as daily bitmaps of numbered subscribers.

Every subscriber has a number.  A day of events becomes one bitmap per (job, template, kind, block of 32,768 numbers).
Bitmaps of several days or jobs merge by OR and meet by AND, so distinct counts of any period of whole days come from
the bitmaps alone, exactly, and a new day costs that day's events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom.functions.columns import pct
from lifeloom.functions.ranking import positions
from lifeloom.operators.reports import MAX_BOUNCE_PCT, MAX_COMPLAINT_PCT, journey_label
from lifeloom.session import settle
from lifeloom.sources.keyed import KeyedTable

KINDS = ["Open", "Click", "Bounce", "HardBounce", "SoftBounce", "Unsubscribe", "Complaint"]
KEY = ["Day", "JobID", "EmailName", "Kind", "Block"]


def event_kinds(sent, opens, clicks, bounces, unsubscribes, complaints) -> dict[str, DataFrame]:
    """The views by kind; a hard or soft bounce is a bounce as well."""
    return {
        "Sent": sent, "Open": opens, "Click": clicks, "Bounce": bounces,
        "HardBounce": bounces.filter(F.col("BounceCategory") == "Hard"), "SoftBounce": bounces.filter(F.col("BounceCategory") == "Soft"),
        "Unsubscribe": unsubscribes, "Complaint": complaints,
    }


class DailyReach:
    """Bitmaps by day below one folder, and the numbers of the subscribers beside them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.numbers = KeyedTable(spark, f"{self.path}/numbers", ["SubscriberKey"])

    def number(self, tag: str, keys: DataFrame) -> None:
        """Give subscribers that have none the next free numbers."""
        keys = keys.select("SubscriberKey").filter(F.col("SubscriberKey").isNotNull()).distinct()
        free = 0
        if self.numbers.exists():
            known = self.numbers.read()
            free = known.agg(F.coalesce(F.max("Number") + 1, F.lit(0))).first()[0]
            keys = keys.join(known, "SubscriberKey", "left_anti")
        placed = positions(keys.withColumn("_all", F.lit(0)), ["_all"], [F.col("SubscriberKey")], "_place")
        self.numbers.merge(tag, placed.select("SubscriberKey", (F.col("_place") - 1 + free).cast("bigint").alias("Number")))

    def fold(self, events: dict[str, DataFrame], first: str, last: str) -> None:
        """Write the bitmaps of the days ``first`` to ``last``, from the events of those days alone.

        A day that is folded again is replaced.  Subscribers must be numbered before the day is read again, so new ones are
        numbered here first.
        """
        day = F.to_date("EventDate")
        rows = None
        for kind, df in events.items():
            email = F.col("EmailName") if kind == "Sent" else F.lit(None).cast("string")
            part = df.filter(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
            part = part.select(day.alias("Day"), "JobID", email.alias("EmailName"), F.lit(kind).alias("Kind"), "SubscriberKey")
            rows = part if rows is None else rows.unionByName(part)
        rows = settle(rows.distinct())
        self.number(f"{first}-{last}", rows)
        numbered = rows.join(self.numbers.read(), "SubscriberKey")
        bits = numbered.groupBy("Day", "JobID", "EmailName", "Kind", F.bitmap_bucket_number("Number").alias("Block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("Number")).alias("Bits")
        )
        writer = bits.repartition("Day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("Day").parquet(f"{self.path}/days")

    def read(self) -> DataFrame:
        schema = "JobID BIGINT, EmailName STRING, Kind STRING, Block BIGINT, Bits BINARY, Day DATE"
        return self.spark.read.schema(schema).parquet(f"{self.path}/days")

    def reach(self, since: Column, until: Column | None = None) -> DataFrame:
        """(Day, JobID, EmailName, Kind, Block, Bits): who was sent a job on a day of [since, until), and who of them ever opened,
        clicked, bounced … for that job."""
        days = self.read()
        period = F.col("Day") >= since
        if until is not None:
            period = period & (F.col("Day") < until)
        sent = days.filter((F.col("Kind") == "Sent") & period)
        back = days.filter(F.col("Kind") != "Sent").groupBy("JobID", "Kind", "Block").agg(F.bitmap_or_agg("Bits").alias("Back"))
        met = sent.drop("Kind").join(back, ["JobID", "Block"])
        # Two bitmaps meet as the two rows of a group.
        pairs = met.select("Day", "JobID", "EmailName", "Kind", "Block", F.explode(F.array("Bits", "Back")).alias("Bits"))
        return sent.select(*KEY, "Bits").unionByName(pairs.groupBy(*KEY).agg(F.bitmap_and_agg("Bits").alias("Bits")))


def counts(reach: DataFrame, by: list[Column | str]) -> DataFrame:
    """Distinct subscribers per kind and group: ``SentCount``, ``OpenCount``, …"""
    merged = reach.groupBy(*by, "Kind", "Block").agg(F.bitmap_count(F.bitmap_or_agg("Bits")).alias("_n"))
    keys = merged.columns[: len(by)]
    kinds = [F.sum(F.when(F.col("Kind") == k, F.col("_n")).otherwise(0)).cast("bigint").alias(f"{k}Count") for k in ["Sent", *KINDS]]
    return merged.groupBy(*keys).agg(*kinds)


def _rates(*names: str) -> list[Column]:
    return [pct(F.col(f"{n}Count"), F.col("SentCount")).alias(f"{n}RatePct") for n in names]


def campaign_performance(reach: DataFrame) -> DataFrame:
    shown = [f"{k}Count" for k in ("Sent", "Open", "Click", "Bounce", "Unsubscribe", "Complaint")]
    rows = counts(reach, ["JobID", "EmailName"])
    return rows.select("JobID", "EmailName", journey_label(F.col("EmailName")).alias("JourneyLabel"), *shown, *_rates("Open", "Click", "Bounce", "Complaint"))


def click_rate_by_journey(reach: DataFrame) -> DataFrame:
    rows = counts(reach, [journey_label(F.col("EmailName")).alias("JourneyLabel")])
    return rows.select("JourneyLabel", "SentCount", *_rates("Open", "Click"))


def deliverability(reach: DataFrame, bu: str) -> DataFrame:
    rows = counts(reach, [F.col("Day").alias("SendDate")])
    raw = {n: F.lit(100.0) * F.col(f"{n}Count") / F.nullif(F.col("SentCount"), F.lit(0)) for n in ("Bounce", "Complaint")}
    breach = (raw["Bounce"] > MAX_BOUNCE_PCT) | (raw["Complaint"] > MAX_COMPLAINT_PCT)
    shown = [f"{k}Count" for k in ("Sent", "Bounce", "HardBounce", "SoftBounce", "Complaint")]
    return rows.select(
        "SendDate", F.lit(bu).alias("BusinessUnitMID"), *shown, *_rates("Bounce", "Complaint"),
        F.when(breach, "BREACH").otherwise("OK").alias("GuardrailStatus"),
    )


def program_kpis(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Totals over jobs and templates of two periods, and the change."""
    metrics = ["SentCount", "OpenRatePct", "ClickRatePct", "BounceRatePct", "ComplaintRatePct"]
    rows = None
    for label, reach in (("current", current), ("prior", prior)):
        jobs = counts(reach, ["JobID", "EmailName"])
        total = jobs.agg(*[F.sum(f"{k}Count").alias(f"{k}Count") for k in ("Sent", "Open", "Click", "Bounce", "Complaint")])
        part = total.select(F.lit(label).alias("_period"), "SentCount", *_rates("Open", "Click", "Bounce", "Complaint"))
        part = part.unpivot("_period", [F.col(m).cast("double").alias(m) for m in metrics], "Metric", "_value")
        rows = part if rows is None else rows.unionByName(part)
    of = lambda p: F.max(F.when(F.col("_period") == p, F.col("_value")))
    wide = rows.groupBy("Metric").agg(of("current").alias("CurrentValue"), of("prior").alias("PriorValue"))
    return wide.withColumn("Change", F.round(F.col("CurrentValue") - F.col("PriorValue"), 4))
