"""Batches of web submissions: tokens, signups, preferences, profiles, unsubscribes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.columns import EMAIL_PATTERN, blank, joined, norm_email
from lifeloom.functions.times import Moment, as_ts, shift, stamp
from lifeloom.operators.quality import profile_reason
from lifeloom.sources.registry import ENUMS
from lifeloom.sources.tables import latest_rows, updated_from, upserted

TOKEN_DAYS = 30
TOKEN_MIN_LENGTH = 10
WELCOME_CODE = "WELCOME15"


def mint_tokens(recipients: DataFrame, send_id: str, as_of: Moment, purpose: str = "PreferenceCenter") -> DataFrame:
    """One access token per recipient and send; the same send mints the same token again."""
    token = F.sha2(joined(F.col("SubscriberKey"), "|", send_id, "|", purpose), 256)
    return recipients.select(
        token.alias("Token"),
        "SubscriberKey",
        F.lit(purpose).alias("Purpose"),
        as_ts(as_of).alias("CreatedDate"),
        shift(as_of, TOKEN_DAYS, "day").alias("ExpirationDate"),
        F.lit(False).alias("Used"),
    )


def resolve_tokens(requests: DataFrame, tokens: DataFrame, as_of: Moment) -> DataFrame:
    """Requests with a token that is long enough, known and not expired, plus its subscriber."""
    live = tokens.filter(F.col("ExpirationDate") >= as_ts(as_of)).select("Token", "SubscriberKey")
    return requests.filter(F.length("Token") >= TOKEN_MIN_LENGTH).join(live, "Token")


def consent_rows(df: DataFrame, prefix: str, action: Column, source: str, as_of: Moment, ip: bool = False) -> DataFrame:
    return df.select(
        joined(prefix, F.col("SubscriberKey"), "-", stamp(as_of)).alias("ConsentLogId"),
        "SubscriberKey",
        F.lit("Email").alias("ChannelType"),
        action.alias("ConsentAction"),
        F.lit(source).alias("ConsentSource"),
        (F.col("IPAddress") if ip else F.lit(None).cast("string")).alias("IPAddress"),
        as_ts(as_of).alias("Timestamp"),
    )


def apply_signups(subscribers: DataFrame, forms: DataFrame, as_of: Moment, bu: str) -> dict[str, DataFrame]:
    """New subscribers, consent rows and welcome events of a signup batch.

    ``forms``: SubmissionId, EmailAddress, FirstName.  Invalid or known addresses are
    left out; one address twice in the batch counts once, the first submission wins.
    """
    valid = forms.filter(F.col("EmailAddress").rlike(EMAIL_PATTERN)).withColumn("_email", norm_email("EmailAddress"))
    rest = F.struct("SubmissionId", "EmailAddress", "FirstName")
    first = valid.groupBy("_email").agg(F.min_by(rest, "SubmissionId").alias("_f")).select("_email", "_f.*")
    known = subscribers.select(norm_email("EmailAddress").alias("_email"))
    fresh = first.join(known, "_email", "left_anti")
    new = fresh.select(
        joined("SUB-", F.substring(F.sha2("_email", 256), 1, 16)).alias("SubscriberKey"),
        "EmailAddress",
        F.coalesce("FirstName", F.lit("")).alias("FirstName"),
        F.lit(bu).alias("BusinessUnitMID"),
        F.lit(True).alias("EmailOptIn"),
        F.lit(False).alias("SMSOptIn"),
        F.lit("Active").alias("SubscriberStatus"),
        F.lit("SmartCapture").alias("SourceSystem"),
        as_ts(as_of).alias("CreatedDate"),
        as_ts(as_of).alias("LastModifiedDate"),
    )
    data = F.struct(
        "SubscriberKey",
        "EmailAddress",
        "FirstName",
        F.lit("SmartCapture").alias("SignupSource"),
        as_ts(as_of).alias("SignupDate"),
        F.lit(WELCOME_CODE).alias("PromoCodeIssued"),
    )
    events = new.select(
        F.col("SubscriberKey").alias("ContactKey"),
        F.lit("APIEvent-Welcome-Signup").alias("EventDefinitionKey"),
        F.to_json(data).alias("Data"),
    )
    consent = consent_rows(new, "SIGNUP-", F.lit("OptIn"), "SmartCapture", as_of).withColumn(
        "ConsentLogId", joined("SIGNUP-", F.col("SubscriberKey"))
    )
    return {"subscribers": new, "consent_log": consent, "events": events}


def apply_preferences(preferences: DataFrame, forms: DataFrame, as_of: Moment) -> dict[str, DataFrame]:
    """Preferences after a batch of preference-centre forms, and the consent rows.

    ``forms`` carries SubscriberKey, SubmittedDate and preference columns; an unknown
    frequency rejects the form; the last valid form of a subscriber wins.
    """
    valid = forms.filter(F.col("FrequencyPreference").isin(*ENUMS[("preferences", "FrequencyPreference")]))
    last = latest_rows(valid, ["SubscriberKey"], "SubmittedDate")
    rows = last.select(
        *[c for c in last.columns if c in preferences.columns and c not in ("LastUpdated", "UpdateSource")],
        as_ts(as_of).alias("LastUpdated"),
        F.lit("PreferenceCenter").alias("UpdateSource"),
    )
    action = F.when(F.col("PromotionalOptIn"), "OptIn").otherwise("OptOut")
    return {
        "preferences": upserted(preferences, rows, ["SubscriberKey"]),
        "consent_log": consent_rows(last, "PREFCTR-", action, "PreferenceCenter", as_of, ip="IPAddress" in last.columns),
    }


def apply_profiles(subscribers: DataFrame, forms: DataFrame, as_of: Moment) -> DataFrame:
    """Subscribers after a batch of profile forms; the last valid form wins."""
    valid = forms.withColumn("_reason", profile_reason(as_of)).filter(F.col("_reason").isNull()).drop("_reason")
    last = latest_rows(valid, ["SubscriberKey"], "SubmittedDate")
    fields = ["FirstName", "LastName", "DateOfBirth", "MobileNumber"]
    source = last.select("SubscriberKey", *[F.col(f).alias(f"_n_{f}") for f in fields])
    changes = {f: F.col(f"_n_{f}") for f in fields if f in subscribers.columns}
    if "LastModifiedDate" in subscribers.columns:
        changes["LastModifiedDate"] = as_ts(as_of)
    return updated_from(subscribers, source, ["SubscriberKey"], F.lit(True), changes)


def apply_unsubscribes(
    subscribers: DataFrame, preferences: DataFrame, suppression: DataFrame, forms: DataFrame, as_of: Moment, bu: str
) -> dict[str, DataFrame]:
    """Full unsubscribes and frequency reductions (``Action`` = unsubscribe | reduce; others are ignored)."""
    out = forms.filter(F.col("Action") == "unsubscribe").select("SubscriberKey").distinct()
    less = forms.filter(F.col("Action") == "reduce").select("SubscriberKey").distinct()
    leaving = subscribers.join(out, "SubscriberKey", "left_semi")
    changes = {"SubscriberStatus": F.lit("Unsubscribed"), "EmailOptIn": F.lit(False), "LastModifiedDate": as_ts(as_of)}
    changes = {c: v for c, v in changes.items() if c in subscribers.columns}
    listed = suppression.select(norm_email("EmailAddress").alias("_email"))
    added = (
        leaving.filter(~blank("EmailAddress"))
        .select(norm_email("EmailAddress").alias("_email"))
        .distinct()
        .join(listed, "_email", "left_anti")
        .select(
            F.col("_email").alias("EmailAddress"),
            F.lit("Unsubscribe").alias("SuppressionReason"),
            as_ts(as_of).alias("SuppressedDate"),
            F.lit(bu).alias("SourceBU"),
            F.lit("SubscriptionManagement").alias("SourceJourneyOrCampaign"),
        )
    )
    reduced = less.select(
        "SubscriberKey",
        F.lit("Reduced").alias("FrequencyPreference"),
        as_ts(as_of).alias("LastUpdated"),
        F.lit("SubscriptionMgmt").alias("UpdateSource"),
    )
    return {
        "subscribers": updated_from(subscribers, out, ["SubscriberKey"], F.lit(True), changes),
        "suppression": added,
        "consent_log": consent_rows(leaving, "UNSUB-", F.lit("OptOut"), "SubscriptionMgmt", as_of),
        "preferences": upserted(preferences, reduced, ["SubscriberKey"]),
    }
