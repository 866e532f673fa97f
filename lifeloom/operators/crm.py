"""CRM mirrors, identity-bridge fallback and CRM-driven promotional suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.asof import previous_value
from lifeloom.functions.columns import is_true, norm_email
from lifeloom.functions.times import Moment, as_ts
from lifeloom.sources.tables import updated_from, upserted


def refresh_mirror(mirror: DataFrame, changes: DataFrame) -> DataFrame:
    """Mirror after an incremental pull: the latest change per Id wins (``SystemModstamp``)."""
    return upserted(mirror, changes, ["Id"], latest="SystemModstamp")


def bridge_matches(contacts: DataFrame, subscribers: DataFrame, bridge: DataFrame, as_of: Moment, bu: str) -> DataFrame:
    """Bridge rows to add: contacts and subscribers with one address and no link in this unit yet."""
    people = contacts.filter(F.col("Email").isNotNull()).select(
        F.col("Id").alias("UnifiedIndividualId"), norm_email("Email").alias("_email")
    )
    ours = subscribers.select("SubscriberKey", norm_email("EmailAddress").alias("_email"))
    linked = bridge.filter(F.col("BusinessUnitMID") == bu).select("SubscriberKey")
    return (
        ours.join(linked, "SubscriberKey", "left_anti")
        .join(people, "_email")
        # Several subscribers of one contact: the smallest key is linked.
        .groupBy("UnifiedIndividualId")
        .agg(F.min("SubscriberKey").alias("SubscriberKey"))
        .select(
            "UnifiedIndividualId",
            F.lit(bu).alias("BusinessUnitMID"),
            "SubscriberKey",
            F.lit(1).cast("decimal(18,2)").alias("MatchConfidenceScore"),
            as_ts(as_of).alias("LastResolvedDate"),
        )
    )


def refresh_bridge(bridge: DataFrame, contacts: DataFrame, subscribers: DataFrame, as_of: Moment, bu: str) -> DataFrame:
    """Bridge with LastResolvedDate moved where the addresses still agree."""
    people = contacts.select(F.col("Id").alias("UnifiedIndividualId"), norm_email("Email").alias("_crm_email"))
    ours = subscribers.select("SubscriberKey", norm_email("EmailAddress").alias("_email"))
    agreeing = (
        bridge.filter(F.col("BusinessUnitMID") == bu)
        .select("UnifiedIndividualId", "SubscriberKey")
        .join(people, "UnifiedIndividualId")
        .join(ours, "SubscriberKey")
        .filter(F.col("_email") == F.col("_crm_email"))
        .select("UnifiedIndividualId", "SubscriberKey")
        .distinct()
    )
    return updated_from(
        bridge,
        agreeing,
        ["UnifiedIndividualId", "SubscriberKey"],
        F.col("BusinessUnitMID") == bu,
        {"LastResolvedDate": as_ts(as_of)},
    )


def crm_flags(bridge: DataFrame, contacts: DataFrame, cases: DataFrame) -> DataFrame:
    """Per subscriber: any linked contact blocked, any linked contact known and clear."""
    open_cases = (
        cases.filter(F.col("Escalated") & (F.col("Status") != "Closed")).select(F.col("ContactId").alias("Id")).distinct()
    )
    state = (
        contacts.select("Id", "DoNotMarket")
        .join(open_cases.withColumn("_open", F.lit(True)), "Id", "left")
        .select(
            F.col("Id").alias("UnifiedIndividualId"),
            (is_true("DoNotMarket") | is_true("_open")).alias("_blocked"),
            (F.col("DoNotMarket").eqNullSafe(F.lit(False)) & F.col("_open").isNull()).alias("_clear"),
        )
    )
    return (
        bridge.select("UnifiedIndividualId", "SubscriberKey")
        .join(state, "UnifiedIndividualId")
        .groupBy("SubscriberKey")
        .agg(F.max("_blocked").alias("_blocked"), F.max("_clear").alias("_clear"))
    )


def promotional_suppression(
    preferences: DataFrame, bridge: DataFrame, contacts: DataFrame, cases: DataFrame, as_of: Moment
) -> DataFrame:
    """PromotionalOptIn off while a linked contact is blocked; back on only where this job set it."""
    source = "CRMSuppressionSync"
    off = F.col("PromotionalOptIn") & F.col("_blocked")
    on = ~F.col("PromotionalOptIn") & (F.col("UpdateSource") == source) & F.col("_clear") & ~F.col("_blocked")
    off, on = F.coalesce(off, F.lit(False)), F.coalesce(on, F.lit(False))
    return updated_from(
        preferences,
        crm_flags(bridge, contacts, cases),
        ["SubscriberKey"],
        off | on,
        {"PromotionalOptIn": on, "LastUpdated": as_ts(as_of), "UpdateSource": F.lit(source)},
    )


def escalations(case_history: DataFrame) -> DataFrame:
    """Changes of Escalated from false (or unknown) to true in the case history."""
    with_previous = previous_value(case_history, ["Id"], "SystemModstamp", "Escalated", "_before", ["ChangeId"])
    return with_previous.filter(F.col("Escalated") & ~is_true("_before")).select("Id", "ContactId", "SystemModstamp")
