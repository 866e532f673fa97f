"""Inactivity tiers, sunset, warm-up audience and frequency cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lifeloom.functions.columns import bands, joined
from lifeloom.functions.percentile import exact_percentile
from lifeloom.functions.ranking import first_k
from lifeloom.functions.selection import first_under_cap
from lifeloom.functions.times import Moment, as_ts, days_between, shift, stamp
from lifeloom.operators.hygiene import latest_engagement
from lifeloom.sources.tables import updated_from

# Days without an open or click that start each tier.
INACTIVITY = [(270, "Sunset"), (180, "Tier2_180Day"), (90, "Tier1_90Day")]


def inactive_entries(
    subscribers: DataFrame,
    sent: DataFrame,
    opens: DataFrame,
    clicks: DataFrame,
    winback_log: DataFrame,
    as_of: Moment,
    never_engaged_from: str | None = None,
) -> DataFrame:
    """Reachable subscribers past an inactivity threshold whose tier is not logged yet.

    Each event view is reduced to one row per subscriber before the joins.  Subscribers
    that never engaged have no age and are left out, unless ``never_engaged_from`` is
    ``"first_send"``.
    """
    sends = sent.groupBy("SubscriberKey").agg(F.min("EventDate").alias("_first_send"))
    last = F.col("_last_email")
    if never_engaged_from == "first_send":
        last = F.coalesce("_last_email", "_first_send")
    aged = (
        sends.join(latest_engagement(opens, clicks), "SubscriberKey", "left")
        .select("SubscriberKey", days_between(last, as_ts(as_of)).cast("bigint").alias("DaysSinceEngagement"))
        .filter(F.col("DaysSinceEngagement") >= INACTIVITY[-1][0])
        .withColumn("InactivityTier", bands(F.col("DaysSinceEngagement"), INACTIVITY, None))
    )
    who = subscribers.filter((F.col("SubscriberStatus") == "Active") & F.col("EmailOptIn")).select(
        "SubscriberKey", "EmailAddress", "FirstName"
    )
    return (
        aged.join(who, "SubscriberKey")
        .join(winback_log.select("SubscriberKey", "InactivityTier"), ["SubscriberKey", "InactivityTier"], "left_anti")
        .select(
            "SubscriberKey",
            "EmailAddress",
            "FirstName",
            "InactivityTier",
            "DaysSinceEngagement",
            as_ts(as_of).alias("DetectedDate"),
        )
    )


def winback_log_rows(entries: DataFrame, as_of: Moment) -> DataFrame:
    return entries.select("SubscriberKey", "InactivityTier", as_ts(as_of).alias("EnteredDate"))


def log_sunset(winback_log: DataFrame, keys: DataFrame) -> DataFrame:
    """Log in which the given contacts have a single Sunset row with their earliest date."""
    finished = keys.select("SubscriberKey").distinct()
    merged = (
        winback_log.join(finished, "SubscriberKey", "left_semi")
        .groupBy("SubscriberKey")
        .agg(F.min("EnteredDate").alias("EnteredDate"))
        .select("SubscriberKey", F.lit("Sunset").alias("InactivityTier"), "EnteredDate")
    )
    rest = winback_log.join(finished, "SubscriberKey", "left_anti").select(*merged.columns)
    return rest.unionByName(merged)


def sunset_keys(
    subscribers: DataFrame,
    winback_log: DataFrame,
    opens: DataFrame,
    clicks: DataFrame,
    series_done: DataFrame | None = None,
) -> DataFrame:
    """Active subscribers logged for sunset without an open or click since then.

    ``series_done`` restricts the result to contacts that finished the series.
    """
    logged = (
        winback_log.filter(F.col("InactivityTier") == "Sunset")
        .groupBy("SubscriberKey")
        .agg(F.min("EnteredDate").alias("_entered"))
    )
    if series_done is not None:
        logged = logged.join(series_done.select("SubscriberKey"), "SubscriberKey", "left_semi")
    active = subscribers.filter(F.col("SubscriberStatus") == "Active").select("SubscriberKey")
    # "No event at or after the entry" = "the last event is earlier", so one row per key suffices.
    return (
        active.join(logged, "SubscriberKey")
        .join(latest_engagement(opens, clicks), "SubscriberKey", "left")
        .filter(F.col("_last_email").isNull() | (F.col("_last_email") < F.col("_entered")))
        .select("SubscriberKey")
    )


def sunset(
    subscribers: DataFrame,
    winback_log: DataFrame,
    opens: DataFrame,
    clicks: DataFrame,
    as_of: Moment,
    series_done: DataFrame | None = None,
    require_series: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(subscribers, consent rows) after the sunset policy."""
    if require_series and series_done is None:
        raise ValueError("pass series_done, or require_series=False to sunset on the log alone")
    keys = sunset_keys(subscribers, winback_log, opens, clicks, series_done if require_series else None)
    updated = updated_from(
        subscribers,
        keys,
        ["SubscriberKey"],
        F.lit(True),
        {"SubscriberStatus": F.lit("Sunset"), "EmailOptIn": F.lit(False), "LastModifiedDate": as_ts(as_of)},
    )
    consent = keys.select(
        joined("SUNSET-", F.col("SubscriberKey"), "-", stamp(as_of)).alias("ConsentLogId"),
        "SubscriberKey",
        F.lit("Email").alias("ChannelType"),
        F.lit("OptOut").alias("ConsentAction"),
        F.lit("WinbackSunsetPolicy").alias("ConsentSource"),
        as_ts(as_of).alias("Timestamp"),
    )
    return updated, consent


def warmup_segment(
    subscribers: DataFrame, as_of: Moment, days: int | None = 30, exclude: DataFrame | None = None
) -> DataFrame:
    """Reachable subscribers engaged within ``days`` (None = all), minus an excluded segment."""
    audience = subscribers.filter((F.col("SubscriberStatus") == "Active") & F.col("EmailOptIn"))
    if days is not None:
        audience = audience.filter(F.col("LastEngagementDate") >= shift(as_of, -days, "day"))
    if exclude is not None:
        audience = audience.join(exclude.select("SubscriberKey"), "SubscriberKey", "left_anti")
    return audience.select("SubscriberKey", "EmailAddress", "FirstName", "LastEngagementDate", "BusinessUnitMID")


def under_cap(audience: DataFrame, caps: DataFrame) -> DataFrame:
    """Best-engaged recipients of each pool up to its cap (``IpPool``, ``Cap``; NULL = no cap)."""
    return first_under_cap(audience, "IpPool", "LastEngagementDate", "SubscriberKey", caps)


def best_scores_first(candidates: DataFrame, scores: DataFrame, cap: int) -> DataFrame:
    """Up to ``cap`` candidates per pool, highest latest engagement score first."""
    scored = candidates.join(latest_score(scores), "SubscriberKey")
    caps = candidates.select("IpPool").distinct().withColumn("Cap", F.lit(cap))
    return first_under_cap(scored, "IpPool", "EngagementScore", "SubscriberKey", caps)


def latest_score(scores: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("EngagementScore", "ScoreDate"), F.struct("ScoreDate", "EngagementScore")).alias("_s")
    return scores.groupBy("SubscriberKey").agg(newest).select("SubscriberKey", "_s.*")


def consistently_low(scores: DataFrame, cycles: int = 4, quantile: float = 0.10) -> DataFrame:
    """Subscribers whose last ``cycles`` scores are all at or below the quantile of latest scores."""
    recent = first_k(
        scores.select("SubscriberKey", "EngagementScore", "ScoreDate"),
        ["SubscriberKey"],
        [F.col("ScoreDate").desc(), F.col("EngagementScore").desc()],
        cycles,
        "RecencyRank",
    )
    per_key = recent.groupBy("SubscriberKey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("EngagementScore").alias("_worst"),
        F.max(F.when(F.col("RecencyRank") == 1, F.col("EngagementScore"))).alias("_latest"),
    )
    return _below_quantile(per_key, cycles, quantile)


def _below_quantile(per_key: DataFrame, cycles: int, quantile: float) -> DataFrame:
    limit = exact_percentile(per_key, "_latest", quantile, "_limit")
    return (
        per_key.filter(F.col("_n") == cycles)
        .crossJoin(F.broadcast(limit))
        .filter(F.col("_worst") <= F.col("_limit"))
        .select("SubscriberKey")
    )


def frequency_cap(preferences: DataFrame, scores: DataFrame, as_of: Moment) -> DataFrame:
    """Standard frequency becomes Reduced for consistently low scores."""
    return updated_from(
        preferences,
        consistently_low(scores),
        ["SubscriberKey"],
        F.col("FrequencyPreference") == "Standard",
        {
            "FrequencyPreference": F.lit("Reduced"),
            "LastUpdated": as_ts(as_of),
            "UpdateSource": F.lit("EinsteinLowEngagementCap"),
        },
    )


# -- send-time choice -----------------------------------------------------------
# Longest queue delay per journey in hours, and the default send window.
MAX_DELAY_HOURS = {"Birthday": 12}
MAX_DELAY_DEFAULT = 24
WINDOW_START, WINDOW_END = 9, 18


def best_hour(opens: DataFrame) -> DataFrame:
    """Hour of day with most opens per subscriber; the earlier hour on a tie."""
    hours = opens.groupBy("SubscriberKey", F.hour("EventDate").alias("BestHour")).agg(F.count(F.lit(1)).alias("_n"))
    pick = F.max_by("BestHour", F.struct("_n", -F.col("BestHour")))
    return hours.groupBy("SubscriberKey").agg(pick.alias("BestHour"))


def _hour_of(text: Column, fallback: int) -> Column:
    return F.coalesce(F.substring(text, 1, 2).try_cast("int"), F.lit(fallback))


def send_times(
    arrivals: DataFrame,
    opens: DataFrame,
    preferences: DataFrame,
    blackouts: DataFrame,
    max_delay_hours: int = MAX_DELAY_DEFAULT,
) -> DataFrame:
    """Send time of each arrival (SubscriberKey, ArrivalDate).

    The best hour, clamped into the preference window (or 9-18), on the first day on
    which it is not in the past; an arrival that would wait longer than allowed is sent
    at once; a blackout day pushes the send to the next free day.
    """
    prefs = preferences.select("SubscriberKey", "PreferredSendTimeStart", "PreferredSendTimeEnd")
    start = _hour_of(F.col("PreferredSendTimeStart"), WINDOW_START)
    end = _hour_of(F.col("PreferredSendTimeEnd"), WINDOW_END)
    chosen = F.least(F.greatest(F.coalesce("BestHour", start), start), end - 1)
    day = F.date_trunc("day", F.col("ArrivalDate")).cast("timestamp_ntz")
    hour = F.make_dt_interval(F.lit(0), F.col("_hour"), F.lit(0), F.lit(0).cast("decimal(18,6)"))
    one_day = F.expr("INTERVAL '1' DAY")
    wait = F.expr(f"INTERVAL '{max_delay_hours}' HOUR")
    timed = (
        arrivals.join(best_hour(opens), "SubscriberKey", "left")
        .join(prefs, "SubscriberKey", "left")
        .withColumn("_hour", chosen)
        .withColumn("_today", day + hour)
        .withColumn("_due", F.when(F.col("_today") >= F.col("ArrivalDate"), F.col("_today")).otherwise(F.col("_today") + one_day))
        .withColumn("_due", F.when(F.col("_due") > F.col("ArrivalDate") + wait, F.col("ArrivalDate")).otherwise(F.col("_due")))
    )
    # At most one row per calendar day (distinct dates), so the window and the broadcast are
    # bounded: consecutive blackout days form a run, mapped to the first day after it.
    order = W.orderBy("CalendarDate")
    runs = (
        blackouts.select("CalendarDate").distinct()
        .withColumn("_run", F.date_sub("CalendarDate", F.row_number().over(order)))
    )
    ends = runs.groupBy("_run").agg(F.max("CalendarDate").alias("_last"))
    moved = runs.join(ends, "_run").select(
        F.col("CalendarDate").alias("_day"), F.date_add("_last", 1).alias("_next")
    )
    return (
        timed.withColumn("_day", F.to_date("_due"))
        .join(F.broadcast(moved), "_day", "left")
        .withColumn(
            "SendAt",
            F.col("_due") + F.make_dt_interval(F.coalesce(F.datediff("_next", "_day"), F.lit(0))),
        )
        .select("SubscriberKey", "ArrivalDate", F.col("_hour").alias("SendHour"), "SendAt")
    )
