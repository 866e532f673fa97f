"""Contact hygiene: suppression, engagement dates, orphans, archive, retention, erasure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.columns import col, is_true, joined, mapped, norm_email, norm_phone
from lifeloom.functions.times import Moment, as_ts, shift, stamp
from lifeloom.sources.registry import RELATIONSHIPS, Retention, TableDef
from lifeloom.sources.tables import updated_from, updated_where, upserted, with_parent

# Subscriber status that each suppression reason leads to (others keep theirs).
STATUS_BY_REASON = {
    "HardBounce": "Bounced",
    "SpamComplaint": "Unsubscribed",
    "Unsubscribe": "Unsubscribed",
    "LegalOptOut": "Unsubscribed",
}
# One address on the list twice: the most binding reason decides.
REASON_PRIORITY = {"LegalOptOut": "4", "SpamComplaint": "3", "Unsubscribe": "2", "HardBounce": "1"}


def one_reason_per_email(suppression: DataFrame) -> DataFrame:
    rank = mapped(F.col("SuppressionReason"), REASON_PRIORITY, F.lit("0"))
    return (
        suppression.select(norm_email("EmailAddress").alias("_email"), "SuppressionReason", rank.alias("_rank"))
        .groupBy("_email")
        .agg(F.max_by("SuppressionReason", F.struct("_rank", "SuppressionReason")).alias("_reason"))
    )


def apply_suppression(subscribers: DataFrame, suppression: DataFrame, as_of: Moment) -> DataFrame:
    """New subscribers version with listed addresses opted out."""
    keyed = subscribers.withColumn("_email", norm_email("EmailAddress"))
    due = (F.col("SubscriberStatus") != "Unsubscribed") | F.col("EmailOptIn")
    out = updated_from(
        keyed,
        one_reason_per_email(suppression),
        ["_email"],
        due,
        {
            "SubscriberStatus": mapped(F.col("_reason"), STATUS_BY_REASON, F.col("SubscriberStatus")),
            "EmailOptIn": F.lit(False),
            "LastModifiedDate": as_ts(as_of),
        },
    )
    return out.drop("_email")


def latest_engagement(opens: DataFrame, clicks: DataFrame) -> DataFrame:
    return (
        opens.select("SubscriberKey", "EventDate")
        .unionByName(clicks.select("SubscriberKey", "EventDate"))
        .groupBy("SubscriberKey")
        .agg(F.max("EventDate").alias("_last_email"))
    )


def refresh_engagement(
    subscribers: DataFrame, opens: DataFrame, clicks: DataFrame, sms_log: DataFrame, as_of: Moment
) -> DataFrame:
    """Move LastEngagementDate forward to the newest open, click or inbound message."""
    sms = (
        sms_log.filter(F.col("EventType").isin("Inbound", "KeywordResponse"))
        .groupBy(norm_phone("MobileNumber").alias("_phone"))
        .agg(F.max("EventDate").alias("_last_sms"))
    )
    both = (
        # Subscribers without a number get a key of their own instead of meeting in one partition.
        subscribers.withColumn("_phone", F.coalesce(norm_phone("MobileNumber"), joined("#", F.col("SubscriberKey"))))
        .join(latest_engagement(opens, clicks), "SubscriberKey", "left")
        .join(sms, "_phone", "left")
    )
    newest = F.greatest("_last_email", "_last_sms", "LastEngagementDate")
    seen = F.col("_last_email").isNotNull() | F.col("_last_sms").isNotNull()
    return updated_where(both, seen, {"LastEngagementDate": newest, "LastModifiedDate": as_ts(as_of)}).select(
        *subscribers.columns
    )


def cascade_orphans(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Children without a parent removed, parents before children, along the table graph."""
    kept = dict(tables)
    for link in RELATIONSHIPS:
        if link.cascades and link.parent in kept and link.child in kept:
            kept[link.child] = with_parent(kept[link.child], kept[link.parent], link.column)
    return kept


def archive_orders(orders: DataFrame, as_of: Moment, days: int = 1095) -> DataFrame:
    """Archive snapshot of orders older than the retention period."""
    kept = [
        "OrderId", "SubscriberKey", "OrderDate", "OrderStatus", "OrderTotal", "Currency", "ShippingCarrier",
        "TrackingNumber", "EstimatedDeliveryDate", "ActualDeliveryDate",
    ]
    columns = [F.col(c) if c in orders.columns else F.lit(None).cast("string").alias(c) for c in kept]
    return orders.filter(F.col("OrderDate") < shift(as_of, -days, "day")).select(
        *columns, as_ts(as_of).alias("ArchivedDate")
    )


def sweep(df: DataFrame, rule: Retention, as_of: Moment) -> DataFrame:
    """Rows that remain after one table's retention rule; an unknown age is kept."""
    if rule.kind == "None" or rule.action == "None" or rule.days is None or rule.column is None:
        return df
    expired = F.col(rule.column) < shift(as_of, -rule.days, "day")
    return df.filter(~F.coalesce(expired, F.lit(False)))


def retention_sweep(
    tables: dict[str, DataFrame], definitions: dict[str, TableDef], as_of: Moment
) -> dict[str, DataFrame]:
    """Every table after its own rule, then orphans; archived rows are returned as ``<name>_archive``."""
    out = {}
    for name, df in tables.items():
        rule = definitions[name].retention if name in definitions else Retention()
        out[name] = sweep(df, rule, as_of)
        if rule.action == "ArchiveThenDelete" and name == "orders":
            out["orders_archive"] = archive_orders(df, as_of, rule.days)
    return cascade_orphans(out)


def suppress_bounces_and_complaints(
    suppression: DataFrame, subscribers: DataFrame, bounces: DataFrame, complaints: DataFrame, as_of: Moment, bu: str
) -> DataFrame:
    """Suppression rows to add: hard bounces and complaints, at once; a complaint outranks a bounce."""
    facts = bounces.filter(F.col("BounceCategory") == "Hard").select(
        "SubscriberKey", F.lit("HardBounce").alias("SuppressionReason")
    )
    facts = facts.unionByName(complaints.select("SubscriberKey", F.lit("SpamComplaint").alias("SuppressionReason")))
    per_key = facts.groupBy("SubscriberKey").agg(F.max("SuppressionReason").alias("SuppressionReason"))
    per_email = (
        per_key.join(subscribers.select("SubscriberKey", "EmailAddress"), "SubscriberKey")
        .groupBy(norm_email("EmailAddress").alias("EmailAddress"))
        .agg(F.max("SuppressionReason").alias("SuppressionReason"))
    )
    listed = suppression.select(norm_email("EmailAddress").alias("EmailAddress"))
    return per_email.join(listed, "EmailAddress", "left_anti").select(
        "EmailAddress",
        "SuppressionReason",
        as_ts(as_of).alias("SuppressedDate"),
        F.lit(bu).alias("SourceBU"),
        F.lit("DeliverabilityEvents").alias("SourceJourneyOrCampaign"),
    )


def sms_stop(preferences: DataFrame, subscribers: DataFrame, inbound: DataFrame, as_of: Moment) -> DataFrame:
    """Preferences with SMS switched off for numbers whose latest keyword is STOP."""
    latest = inbound.groupBy(norm_phone("MobileNumber").alias("_phone")).agg(
        F.max_by(F.upper(F.trim("Keyword")), F.struct("EventDate", "Keyword")).alias("_keyword")
    )
    stopped = (
        subscribers.select("SubscriberKey", norm_phone("MobileNumber").alias("_phone"))
        .join(latest.filter(F.col("_keyword") == "STOP"), "_phone", "left_semi")
        .select("SubscriberKey")
        .distinct()
    )
    return updated_from(
        preferences,
        stopped,
        ["SubscriberKey"],
        F.lit(True),
        {"SMSOptIn": F.lit(False), "LastUpdated": as_ts(as_of), "UpdateSource": F.lit("SMSKeyword")},
    )


ERASED_CHILDREN = ["preferences", "addresses", "loyalty", "carts", "cart_lines"]


def erased_email(key: str | Column = "SubscriberKey") -> Column:
    return joined("erased-", col(key), "@erased.invalid")


def erase(
    tables: dict[str, DataFrame], requests: DataFrame, as_of: Moment, bridge: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Erase a batch of subjects across the table graph.

    ``requests`` carries SubscriberKey.  With ``bridge`` the request also covers every
    subscriber linked to the same individual.  The subscriber row stays, anonymised;
    the original address is suppressed as a hash, its replacement in clear.
    """
    keys = requests.select("SubscriberKey").distinct()
    if bridge is not None:
        people = bridge.join(keys, "SubscriberKey", "left_semi").select("UnifiedIndividualId").distinct()
        linked = bridge.join(people, "UnifiedIndividualId", "left_semi").select("SubscriberKey")
        keys = keys.unionByName(linked).distinct()
    subscribers = tables["subscribers"]
    subjects = subscribers.join(keys, "SubscriberKey", "left_semi")
    out = dict(tables)
    scrub = {
        "EmailAddress": erased_email(),
        "FirstName": F.lit(""),
        "LastName": F.lit(""),
        "MobileNumber": F.lit(""),
        "DateOfBirth": F.lit(None),
        "SubscriberStatus": F.lit("Unsubscribed"),
        "EmailOptIn": F.lit(False),
        "SMSOptIn": F.lit(False),
        "LastModifiedDate": as_ts(as_of),
    }
    scrub = {c: v for c, v in scrub.items() if c in subscribers.columns}
    out["subscribers"] = updated_from(subscribers, keys, ["SubscriberKey"], F.lit(True), scrub)
    for child in ERASED_CHILDREN:
        if child in tables:
            out[child] = tables[child].join(keys, "SubscriberKey", "left_anti")
    receipt = subjects.select(
        joined("DSAR-", F.col("SubscriberKey"), "-", stamp(as_of)).alias("ConsentLogId"),
        "SubscriberKey",
        F.lit("Email").alias("ChannelType"),
        F.lit("OptOut").alias("ConsentAction"),
        F.lit("DSAR").alias("ConsentSource"),
        F.lit(None).cast("string").alias("IPAddress"),
        as_ts(as_of).alias("Timestamp"),
    )
    if "consent_log" in tables:
        log = updated_from(
            tables["consent_log"], keys, ["SubscriberKey"], F.lit(True), {"IPAddress": F.lit(None).cast("string")}
        )
        out["consent_log"] = upserted(log, receipt, ["ConsentLogId"])
    hashed = joined("sha256:", F.sha2(norm_email("EmailAddress"), 256))
    rows = [
        subjects.select(
            address.alias("EmailAddress"),
            F.lit("LegalOptOut").alias("SuppressionReason"),
            as_ts(as_of).alias("SuppressedDate"),
            F.lit("DSARErasure").alias("SourceJourneyOrCampaign"),
        )
        for address in (hashed, erased_email())
    ]
    if "suppression" in tables:
        out["suppression"] = upserted(
            tables["suppression"], rows[0].unionByName(rows[1]).dropDuplicates(["EmailAddress"]), ["EmailAddress"]
        )
    return out


# -- who may be contacted -----------------------------------------------------
def exit_criteria(subscribers: DataFrame) -> DataFrame:
    """Subscribers that must leave every journey."""
    gone = F.col("SubscriberStatus").isin("Unsubscribed", "Sunset") | ~is_true("EmailOptIn")
    return subscribers.filter(gone).select("SubscriberKey")


def still_in_journey(in_flight: DataFrame, subscribers: DataFrame) -> DataFrame:
    return in_flight.join(exit_criteria(subscribers), "SubscriberKey", "left_anti")


def drop_suppressed(candidates: DataFrame, suppression: DataFrame) -> DataFrame:
    """Journey candidates whose address is not on the suppression list."""
    listed = suppression.select(norm_email("EmailAddress").alias("_email"))
    return candidates.withColumn("_email", norm_email("EmailAddress")).join(listed, "_email", "left_anti").drop("_email")


def send_eligible(
    subscribers: DataFrame, preferences: DataFrame, suppression: DataFrame, classification: str
) -> DataFrame:
    """Subscribers a promotional or transactional message may go to.

    Both need an address that is not legally suppressed and no hard opt-out; promotional
    sends also need e-mail and promotional opt-in and a frequency that allows them.
    """
    legal = suppression.filter(F.col("SuppressionReason") == "LegalOptOut")
    base = drop_suppressed(subscribers, legal if classification == "Transactional" else suppression)
    if classification == "Transactional":
        return base.filter(~F.col("SubscriberStatus").isin("Unsubscribed", "Bounced")).select(
            "SubscriberKey", "EmailAddress"
        )
    prefs = preferences.select("SubscriberKey", "PromotionalOptIn", "TransactionalOnly", "FrequencyPreference")
    wanted = (
        (F.col("SubscriberStatus") == "Active")
        & F.col("EmailOptIn")
        & F.coalesce("PromotionalOptIn", F.lit(True))
        & ~F.coalesce("TransactionalOnly", F.lit(False))
        & (F.coalesce("FrequencyPreference", F.lit("Standard")) != "EssentialOnly")
    )
    return base.join(prefs, "SubscriberKey", "left").filter(wanted).select("SubscriberKey", "EmailAddress")
