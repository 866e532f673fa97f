"""Queries for projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lifeloom.functions.asof import latest_before, previous_value
from lifeloom.functions.columns import all_of, bands, by_prefix, effective_price, or_default, pct
from lifeloom.functions.percentile import exact_percentile
from lifeloom.functions.ranking import first_k
from lifeloom.functions.times import as_ts, days_between, shift
from lifeloom.operators import carts, catalog, crm, hygiene, identity, insights, monitors, orders, reports, winback
from lifeloom.workload.base import query
from lifeloom.workload.sources import dmarc_records
from lifeloom.workload.views import EVENTS_NOW, ORDERS_NOW

# -- filters and projections -------------------------------------------------------------


@query(
    "flt_boolean_logic",
    """SELECT OrderId FROM {shop_orders}
       WHERE (OrderStatus NOT IN ('Cancelled', 'Returned') AND EstimatedDeliveryDate IS NOT NULL
              AND OrderTotal BETWEEN 1000 AND 300000)
          OR (ShippingCarrier IS NULL AND OrderStatus <> 'Shipped')""",
)
def _(t):
    plain = ~F.col("OrderStatus").isin("Cancelled", "Returned")
    a = plain & F.col("EstimatedDeliveryDate").isNotNull() & F.col("OrderTotal").between(1000, 300000)
    b = F.col("ShippingCarrier").isNull() & (F.col("OrderStatus") != "Shipped")
    return t.shop_orders.filter(a | b).select("OrderId")


@query(
    "flt_like_prefix",
    "SELECT JobID, SubscriberKey, EventDate, EmailName FROM {sent} WHERE starts_with(EmailName, 'EMAIL_WELCOME')",
)
def _(t):
    return t.sent.filter(F.col("EmailName").startswith("EMAIL_WELCOME"))


@query(
    "prj_case_bands",
    """SELECT SubscriberKey, ScoreDate, EngagementScore,
              CASE WHEN EngagementScore >= 80 THEN '80-100 (Highly Engaged)' WHEN EngagementScore >= 60 THEN '60-79 (Engaged)'
                   WHEN EngagementScore >= 40 THEN '40-59 (Moderate)' WHEN EngagementScore >= 20 THEN '20-39 (Low)'
                   ELSE '0-19 (At Risk)' END AS ScoreBand FROM {scores}""",
)
def _(t):
    return t.scores.withColumn("ScoreBand", bands(F.col("EngagementScore"), reports.SCORE_BANDS, reports.LOWEST_BAND))


@query("prj_constant_cols", "SELECT SubscriberKey, '5000011' AS BusinessUnitMID, 'Email' AS ChannelType FROM {signups}")
def _(t):
    return t.signups.select("SubscriberKey", F.lit("5000011").alias("BusinessUnitMID"), F.lit("Email").alias("ChannelType"))


@query(
    "flt_relative_time",
    f"""SELECT CartId FROM {{carts}} WHERE CartLastUpdatedDate <= TIMESTAMP '{EVENTS_NOW}' - INTERVAL 30 MINUTE
        AND CartCreatedDate >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL 14 DAY
        AND CartCreatedDate >= TIMESTAMP '{EVENTS_NOW}' - INTERVAL 1 MONTH""",
)
def _(t):
    return t.carts.filter(
        (F.col("CartLastUpdatedDate") <= shift(EVENTS_NOW, -30, "minute"))
        & (F.col("CartCreatedDate") >= shift(EVENTS_NOW, -14, "day"))
        & (F.col("CartCreatedDate") >= shift(EVENTS_NOW, -1, "month"))
    ).select("CartId")


@query(
    "flt_exists",
    """SELECT c.Id FROM {crm_contacts} c WHERE c.DoNotMarket OR EXISTS (
           SELECT 1 FROM {crm_cases} k WHERE k.ContactId = c.Id AND k.Escalated AND k.Status <> 'Closed')""",
)
def _(t):
    open_cases = t.crm_cases.filter("Escalated AND Status <> 'Closed'").select(F.col("ContactId").alias("Id")).distinct()
    flagged = t.crm_contacts.join(open_cases.withColumn("_open", F.lit(True)), "Id", "left")
    return flagged.filter(F.col("DoNotMarket") | F.col("_open").isNotNull()).select("Id")


@query(
    "flt_not_exists",
    "SELECT SubscriberKey FROM {subscribers} s WHERE NOT EXISTS "
    "(SELECT 1 FROM {old_opens} o WHERE o.SubscriberKey = s.SubscriberKey AND o.EventDate >= TIMESTAMP '2001-01-01')",
)
def _(t):
    recent = t.old_opens.filter(F.col("EventDate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return t.subscribers.join(recent.select("SubscriberKey"), "SubscriberKey", "left_anti").select("SubscriberKey")


@query(
    "flt_scalar_subquery",
    "SELECT SubscriberKey, EngagementScore FROM {scores} WHERE ScoreDate = (SELECT max(ScoreDate) FROM {scores})",
)
def _(t):
    return reports.at_latest_date(t.scores).select("SubscriberKey", "EngagementScore")


LTV_SQL = """
    SELECT BuyerId AS UnifiedIndividualId, CAST(spend AS DOUBLE) AS LifetimeSpend, n AS LifetimeOrderCount,
           CAST((2 * CAST(spend * 100 AS HUGEINT) + n) // (2 * n) AS DOUBLE) / 100 AS AvgOrderValue,
           last_day - first_day AS CustomerTenureDays, last_at AS LastOrderDate, idle AS DaysSinceLastOrder,
           CASE WHEN rich AND idle >= 90 THEN 'HighValueAtRisk' WHEN rich THEN 'HighValueActive'
                WHEN idle >= 180 THEN 'LowValueAtRisk' ELSE 'Standard' END AS ChurnRiskSegment
    FROM (SELECT *, spend >= 5000 AS rich, DATE '2001-08-02' - last_day AS idle
          FROM (SELECT BuyerId, sum(OrderTotal) AS spend, count(DISTINCT OrderId) AS n, max(OrderDate) AS last_at,
                       CAST(min(OrderDate) AS DATE) AS first_day, CAST(max(OrderDate) AS DATE) AS last_day
                FROM {buyer_orders} WHERE coalesce(OrderStatus NOT IN ('Cancelled', 'Returned'), FALSE)
                  AND BuyerId IN (SELECT UnifiedIndividualId FROM {individuals}) GROUP BY BuyerId) b) f"""


def ltv(t):
    return insights.lifetime_value(t.individuals, t.buyer_orders, ORDERS_NOW)


RULE_SQL = f"""SELECT UnifiedIndividualId, ChurnRiskSegment, DaysSinceLastOrder FROM ({LTV_SQL}) v
    WHERE ChurnRiskSegment = 'HighValueAtRisk' AND DaysSinceLastOrder >= 90 AND DaysSinceLastOrder < 270"""


@query("flt_segment_rule", RULE_SQL)
def _(t):
    return insights.segment(ltv(t), insights.HIGH_VALUE_AT_RISK).select(
        "UnifiedIndividualId", "ChurnRiskSegment", "DaysSinceLastOrder"
    )


@query(
    "flt_exit_criteria",
    "SELECT SubscriberKey FROM {subscribers} WHERE SubscriberStatus IN ('Unsubscribed', 'Sunset') OR NOT EmailOptIn",
)
def _(t):
    return hygiene.exit_criteria(t.subscribers)


@query("flt_entry_source", "SELECT CartId, SubscriberKey FROM {carts} WHERE CartStatus = 'Active' AND RecoveryEmailsSent = 0")
def _(t):
    abandoned = t.carts.withColumn("CartStatus", F.when(F.col("CartStatus") == "Active", "Abandoned").otherwise(F.col("CartStatus")))
    return carts.journey_entries(abandoned).select("CartId", "SubscriberKey")


@query(
    "flt_entry_suppression",
    """SELECT SubscriberKey, EmailAddress FROM {subscribers} WHERE lower(trim(EmailAddress)) NOT IN
       (SELECT lower(trim(EmailAddress)) FROM {suppression})""",
)
def _(t):
    return hygiene.drop_suppressed(t.subscribers.select("SubscriberKey", "EmailAddress"), t.suppression)


@query(
    "flt_send_eligible",
    """SELECT 'Promotional' AS Classification, s.SubscriberKey FROM {subscribers} s LEFT JOIN {preferences} p ON p.SubscriberKey = s.SubscriberKey
       WHERE s.SubscriberStatus = 'Active' AND s.EmailOptIn AND coalesce(p.PromotionalOptIn, TRUE)
         AND NOT coalesce(p.TransactionalOnly, FALSE) AND coalesce(p.FrequencyPreference, 'Standard') <> 'EssentialOnly'
         AND lower(trim(s.EmailAddress)) NOT IN (SELECT lower(trim(EmailAddress)) FROM {suppression})
       UNION ALL
       SELECT 'Transactional', SubscriberKey FROM {subscribers}
       WHERE SubscriberStatus NOT IN ('Unsubscribed', 'Bounced') AND lower(trim(EmailAddress)) NOT IN
             (SELECT lower(trim(EmailAddress)) FROM {suppression} WHERE SuppressionReason = 'LegalOptOut')""",
)
def _(t):
    parts = [
        hygiene.send_eligible(t.subscribers, t.preferences, t.suppression, c).select(F.lit(c).alias("Classification"), "SubscriberKey")
        for c in ("Promotional", "Transactional")
    ]
    return parts[0].unionByName(parts[1])


# -- joins -------------------------------------------------------------------------------
@query(
    "join_inner_equi",
    "SELECT o.OrderId, o.SubscriberKey, s.FirstName FROM {shop_orders} o JOIN {subscribers} s ON o.SubscriberKey = s.SubscriberKey",
)
def _(t):
    return t.shop_orders.select("OrderId", "SubscriberKey").join(t.subscribers.select("SubscriberKey", "FirstName"), "SubscriberKey")


@query(
    "join_left_equi",
    """SELECT o.OrderId, a.StateProvince FROM {shop_orders} o
       LEFT JOIN {addresses} a ON a.SubscriberKey = o.SubscriberKey AND a.AddressType = 'Shipping' AND a.IsDefault""",
)
def _(t):
    shipping = t.addresses.filter("AddressType = 'Shipping' AND IsDefault").select("SubscriberKey", "StateProvince")
    return t.shop_orders.select("OrderId", "SubscriberKey").join(shipping, "SubscriberKey", "left").drop("SubscriberKey")


@query(
    "join_left_range_residual",
    """SELECT a.TestId, count(o.EventDate) AS OpensAfterEntry FROM {ab_assignments} a LEFT JOIN {opens} o
       ON o.SubscriberKey = a.SubscriberKey AND o.EmailName = a.EmailNameSent AND o.EventDate >= a.EntryDate GROUP BY a.TestId""",
)
def _(t):
    a, o = t.ab_assignments, t.opens
    on = (
        (o.SubscriberKey == a.SubscriberKey) & (o.EmailName == a.EmailNameSent) & (o.EventDate >= a.EntryDate)
    )
    return a.join(o, on, "left").groupBy("TestId").agg(F.count("EventDate").alias("OpensAfterEntry"))


@query(
    "join_interval_attribution",
    """SELECT a.Variant, a.SubscriberKey, o.OrderId, CAST(o.OrderTotal AS DOUBLE) AS OrderTotal
       FROM {ab_assignments} a JOIN {event_orders} o ON o.SubscriberKey = a.SubscriberKey
        AND o.OrderDate BETWEEN a.EntryDate AND a.EntryDate + INTERVAL 14 DAY""",
)
def _(t):
    entries = t.ab_assignments.select("Variant", "SubscriberKey", F.col("EntryDate").alias("_start"))
    found = reports.attributed_orders(entries, t.event_orders, ["Variant"], 14)
    return found.select("Variant", "SubscriberKey", "OrderId", "OrderTotal")


@query(
    "join_anti",
    "SELECT s.SubscriberKey FROM {subscribers} s LEFT JOIN {loyalty} l ON l.SubscriberKey = s.SubscriberKey WHERE l.SubscriberKey IS NULL",
)
def _(t):
    return t.subscribers.join(t.loyalty, "SubscriberKey", "left_anti").select("SubscriberKey")


@query(
    "join_anti_computed_key",
    """WITH e AS (SELECT SubscriberKey, date_diff('day', CAST(max(EventDate) AS DATE), DATE '2001-08-02') AS d FROM {old_opens} GROUP BY 1),
            k AS (SELECT *, CASE WHEN d >= 270 THEN 'Sunset' WHEN d >= 180 THEN 'Tier2_180Day' WHEN d >= 90 THEN 'Tier1_90Day' END AS InactivityTier FROM e)
       SELECT k.SubscriberKey, k.InactivityTier FROM k LEFT JOIN {winback_log} w
       ON w.SubscriberKey = k.SubscriberKey AND w.InactivityTier = k.InactivityTier WHERE w.SubscriberKey IS NULL AND d >= 90""",
)
def _(t):
    age = days_between(F.max("EventDate"), as_ts(ORDERS_NOW))
    tiered = t.old_opens.groupBy("SubscriberKey").agg(age.alias("_d")).filter("_d >= 90")
    tiered = tiered.withColumn("InactivityTier", bands(F.col("_d"), winback.INACTIVITY, None)).drop("_d")
    return tiered.join(t.winback_log, ["SubscriberKey", "InactivityTier"], "left_anti")


@query(
    "join_self",
    """SELECT s.JobID, count(DISTINCT s.SubscriberKey) AS Subscribers FROM {sent} s
       JOIN {sent} j ON j.JobID = s.JobID AND j.SubscriberKey = s.SubscriberKey GROUP BY s.JobID""",
)
def _(t):
    # The self-join only re-reads the name of the same send: one pass gives the same counts.
    return t.sent.select("JobID", "SubscriberKey").distinct().groupBy("JobID").agg(F.count(F.lit(1)).alias("Subscribers"))


@query(
    "join_multiway_star",
    """SELECT p.SubscriberKey, c.Id AS ContactId, c.DoNotMarket, s.SubscriberStatus FROM {preferences} p
       JOIN {subscribers} s ON s.SubscriberKey = p.SubscriberKey JOIN {bridge} b ON b.SubscriberKey = s.SubscriberKey
       JOIN {crm_contacts} c ON c.Id = b.UnifiedIndividualId""",
)
def _(t):
    contacts = t.crm_contacts.select(F.col("Id").alias("UnifiedIndividualId"), "DoNotMarket")
    return (
        t.preferences.select("SubscriberKey")
        .join(t.subscribers.select("SubscriberKey", "SubscriberStatus"), "SubscriberKey")
        .join(t.bridge.select("SubscriberKey", "UnifiedIndividualId"), "SubscriberKey")
        .join(contacts, "UnifiedIndividualId")
        .withColumnRenamed("UnifiedIndividualId", "ContactId")
    )


@query(
    "join_latest_asof",
    """SELECT c.CartId, c.CartCreatedDate + INTERVAL 6 HOUR AS CheckedAt, arg_max(h.CartStatus, (h.StatusDate, h.CartStatus)) AS CartStatus
       FROM {carts} c LEFT JOIN {cart_history} h ON h.CartId = c.CartId AND h.StatusDate <= c.CartCreatedDate + INTERVAL 6 HOUR
       GROUP BY c.CartId, c.CartCreatedDate""",
)
def _(t):
    probes = t.carts.select("CartId", (F.col("CartCreatedDate") + F.expr("INTERVAL 6 HOUR")).alias("CheckedAt"))
    found = latest_before(probes, t.cart_history, ["CartId"], "CheckedAt", "StatusDate", ["CartStatus"], "day")
    return found.select("CartId", "CheckedAt", "CartStatus")


@query(
    "join_range_ramp",
    """SELECT IpPool, SendDate, n AS DayNumber, CASE WHEN n <= 3 THEN 1000 WHEN n <= 7 THEN 5000 WHEN n <= 11 THEN 10000
              WHEN n <= 15 THEN 25000 WHEN n <= 19 THEN 50000 WHEN n <= 23 THEN 100000 WHEN n <= 27 THEN 250000
              WHEN n <= 30 THEN 500000 END AS DailyCapPerIP
       FROM (SELECT IpPool, SendDate, CAST(extract(day FROM SendDate) + 2 AS BIGINT) AS n FROM {pool_days}) d""",
)
def _(t):
    days = t.pool_days.select("IpPool", "SendDate", (F.dayofmonth("SendDate") + 2).cast("bigint").alias("DayNumber"))
    steps = t.spark.createDataFrame(monitors.RAMP, "low INT, high INT, DailyCapPerIP BIGINT")
    inside = (F.col("DayNumber") >= F.col("low")) & (F.col("high").isNull() | (F.col("DayNumber") <= F.col("high")))
    return days.join(F.broadcast(steps), inside, "left").drop("low", "high")  # nine fixed rows


@query(
    "join_cross_config",
    f"""SELECT OrderId, Value FROM {{shop_orders}} CROSS JOIN (SELECT max(r_name) AS Value FROM {{region}}) c""",
)
def _(t):
    config = t.region.agg(F.max("r_name").alias("Value"))
    return t.shop_orders.select("OrderId").crossJoin(F.broadcast(config))  # exactly one row


# -- identity-style and ranked joins: see jobs.py for join_fuzzy_blocked and join_allocate_rank ---


# -- aggregates --------------------------------------------------------------------------
@query("agg_max_per_key", "SELECT SubscriberKey, max(EventDate) AS LastOpen FROM {opens} GROUP BY SubscriberKey")
def _(t):
    return t.opens.groupBy("SubscriberKey").agg(F.max("EventDate").alias("LastOpen"))


@query(
    "agg_sum_per_key",
    f"""SELECT SubscriberKey, CAST(sum(OrderTotal) AS DOUBLE) AS TTMSpend FROM {{shop_orders}}
        WHERE OrderStatus NOT IN ('Cancelled', 'Returned') AND OrderDate >= TIMESTAMP '{ORDERS_NOW}' - INTERVAL 12 MONTH
        GROUP BY SubscriberKey""",
)
def _(t):
    from lifeloom.operators.loyalty import trailing_spend

    return trailing_spend(t.shop_orders, ORDERS_NOW)


@query(
    "agg_multi_count_distinct",
    """SELECT s.JobID, count(DISTINCT s.SubscriberKey) AS SentCount, count(DISTINCT o.SubscriberKey) AS OpenCount,
              count(DISTINCT c.SubscriberKey) AS ClickCount, count(DISTINCT b.SubscriberKey) AS BounceCount
       FROM {sent} s LEFT JOIN {opens} o ON o.SubscriberKey = s.SubscriberKey AND o.JobID = s.JobID
       LEFT JOIN {clicks} c ON c.SubscriberKey = s.SubscriberKey AND c.JobID = s.JobID
       LEFT JOIN {bounces} b ON b.SubscriberKey = s.SubscriberKey AND b.JobID = s.JobID GROUP BY s.JobID""",
)
def _(t):
    facts = reports.campaign_facts(
        t.sent, t.opens, t.clicks, t.bounces, t.unsubscribes, t.complaints, since=as_ts("2024-01-01 00:00:00")
    )
    n = lambda flag: F.count_if(F.coalesce(F.col(flag), F.lit(False)))
    return facts.groupBy("JobID").agg(
        F.count(F.lit(1)).alias("SentCount"), n("Open").alias("OpenCount"), n("Click").alias("ClickCount"), n("Bounce").alias("BounceCount")
    )


@query(
    "agg_conditional_distinct",
    """SELECT JobID, count(DISTINCT CASE WHEN BounceCategory = 'Hard' THEN SubscriberKey END) AS HardBounces,
              count(DISTINCT CASE WHEN BounceCategory = 'Soft' THEN SubscriberKey END) AS SoftBounces FROM {bounces} GROUP BY JobID""",
)
def _(t):
    per_person = t.bounces.groupBy("JobID", "SubscriberKey").agg(
        F.max(F.col("BounceCategory") == "Hard").alias("_hard"), F.max(F.col("BounceCategory") == "Soft").alias("_soft")
    )
    return per_person.groupBy("JobID").agg(F.count_if("_hard").alias("HardBounces"), F.count_if("_soft").alias("SoftBounces"))


@query(
    "agg_ratio_pct",
    """SELECT IpPool, round(100.0 * sum(BounceCount) / nullif(CAST(sum(SentCount) AS DOUBLE), 0), 4) AS BounceRatePct
       FROM {pool_days} GROUP BY IpPool""",
)
def _(t):
    total = t.pool_days.groupBy("IpPool").agg(F.sum("BounceCount").alias("b"), F.sum("SentCount").alias("s"))
    return total.select("IpPool", pct(F.col("b"), F.col("s")).alias("BounceRatePct"))


SPEND_SQL = """SELECT o.BuyerId, l.Category, sum(l.LineTotal) AS CategorySpend FROM {buyer_orders} o
    JOIN {order_lines_cat} l ON l.OrderId = o.OrderId WHERE o.OrderStatus NOT IN ('Cancelled', 'Returned') GROUP BY 1, 2"""
#: Each buyer's categories as a list, most spent first.
FAVOURITES_SQL = f"""SELECT BuyerId, list(Category ORDER BY CategorySpend DESC, Category) AS liked FROM ({SPEND_SQL}) s GROUP BY BuyerId"""


@query(
    "agg_pivot_max_case",
    f"""SELECT BuyerId, liked[1] AS First, liked[3] AS Third FROM ({FAVOURITES_SQL}) r""",
)
def _(t):
    spend = insights.category_spend(t.buyer_orders, t.order_lines_cat)
    top = first_k(spend, ["BuyerId"], [F.col("CategorySpend").desc(), F.col("Category")], 3)
    return top.groupBy("BuyerId").agg(
        F.max(F.when(F.col("Rank") == 1, F.col("Category"))).alias("First"),
        F.max(F.when(F.col("Rank") == 3, F.col("Category"))).alias("Third"),
    )


@query(
    "agg_having",
    "SELECT l_orderkey AS OrderKey, l_linenumber AS LineNumber, count(*) AS n FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(t):
    grouped = t.lineitem.groupBy(F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("LineNumber"))
    return grouped.agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(
    "agg_percentile_cont",
    """SELECT quantile_cont(CAST(s AS DOUBLE), 0.1) AS ThresholdScore FROM
       (SELECT arg_max(EngagementScore, ScoreDate) AS s FROM {scores} GROUP BY SubscriberKey) x""",
)
def _(t):
    return exact_percentile(winback.latest_score(t.scores), "EngagementScore", 0.1, "ThresholdScore")


@query("agg_percentile_double", "SELECT quantile_cont(l_extendedprice * (1 - l_discount) + l_orderkey / 1000.0, 0.9) AS Threshold FROM {lineitem}")
def _(t):
    # About as many values as rows.
    value = F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_orderkey") / 1000.0
    return exact_percentile(t.lineitem.select(value.alias("v")), "v", 0.9, "Threshold")


@query(
    "agg_group_by_expr",
    """SELECT CAST(EventDate AS DATE) AS SendDate, CASE WHEN starts_with(EmailName, 'EMAIL_') THEN 'Journey' ELSE 'Other' END AS Kind,
              count(*) AS Sends FROM {sent} GROUP BY 1, 2""",
)
def _(t):
    kind = by_prefix(F.col("EmailName"), [("EMAIL_", "Journey")], "Other")
    return t.sent.groupBy(F.to_date("EventDate").alias("SendDate"), kind.alias("Kind")).agg(F.count(F.lit(1)).alias("Sends"))


@query(
    "agg_order_by_agg",
    "SELECT EmailName, count(*) AS Opens FROM {opens} GROUP BY EmailName ORDER BY min(EventDate) DESC",
)
def _(t):
    grouped = t.opens.groupBy("EmailName").agg(F.count(F.lit(1)).alias("Opens"), F.min("EventDate").alias("_first"))
    return grouped.orderBy(F.col("_first").desc()).drop("_first")


@query("agg_avg", "SELECT ScoreDate, round(avg(EngagementScore), 4) AS AvgScore FROM {scores} GROUP BY ScoreDate")
def _(t):
    return t.scores.groupBy("ScoreDate").agg(F.round(F.avg("EngagementScore"), 4).alias("AvgScore"))


@query(
    "agg_min_max_span",
    "SELECT SubscriberKey, date_diff('day', CAST(min(OrderDate) AS DATE), CAST(max(OrderDate) AS DATE)) AS TenureDays FROM {shop_orders} GROUP BY 1",
)
def _(t):
    return t.shop_orders.groupBy("SubscriberKey").agg(days_between(F.min("OrderDate"), F.max("OrderDate")).alias("TenureDays"))


DMARC_SQL = """SELECT CASE WHEN user_id % 3 = 0 THEN 'ip-pool-us-primary' WHEN user_id % 3 = 1 THEN 'ip-pool-ca-primary'
        ELSE 'UNKNOWN — investigate' END AS Pool, CAST(sum(event_id % 100) AS BIGINT) AS TotalMessages,
    CAST(sum(CASE WHEN value < 20 THEN event_id % 100 ELSE 0 END) AS BIGINT) AS DkimPass,
    CAST(sum(CASE WHEN value < 30 THEN event_id % 100 ELSE 0 END) AS BIGINT) AS SpfPass,
    CAST(sum(CASE WHEN value > 40 AND value <= 60 THEN event_id % 100 ELSE 0 END) AS BIGINT) AS Quarantined,
    CAST(sum(CASE WHEN value > 60 THEN event_id % 100 ELSE 0 END) AS BIGINT) AS Rejected FROM {events} GROUP BY 1"""


@query("agg_weighted_sum_by_class", DMARC_SQL)
def _(t):
    return monitors.dmarc_summary(dmarc_records(t)).select(
        "Pool", "TotalMessages", "DkimPass", "SpfPass", "Quarantined", "Rejected"
    )


# -- windows -----------------------------------------------------------------------------
@query(
    "win_row_number_desc",
    "SELECT * FROM (SELECT SubscriberKey, EngagementScore, ScoreDate, row_number() OVER (PARTITION BY SubscriberKey ORDER BY ScoreDate DESC) AS RecencyRank FROM {scores}) s",
)
def _(t):
    # One score per subscriber and week, so a window holds a subscriber's weeks.
    window = W.partitionBy("SubscriberKey").orderBy(F.col("ScoreDate").desc())
    return t.scores.withColumn("RecencyRank", F.row_number().over(window))


@query(
    "win_last_n",
    """SELECT SubscriberKey, EventDate, Recency FROM (SELECT SubscriberKey, EventDate, JobID,
           row_number() OVER (PARTITION BY SubscriberKey ORDER BY EventDate DESC) AS Recency FROM {opens}) s WHERE Recency <= 4""",
)
def _(t):
    return first_k(t.opens.select("SubscriberKey", "EventDate"), ["SubscriberKey"], [F.col("EventDate").desc()], 4, "Recency")


GUARD_SQL = """SELECT IpPool, SendDate, SentCount, BounceCount, ComplaintCount,
    CASE WHEN SentCount > 0 THEN BounceCount / CAST(SentCount AS DOUBLE) * 100.0 ELSE 0 END AS br,
    CASE WHEN SentCount > 0 THEN ComplaintCount / CAST(SentCount AS DOUBLE) * 100.0 ELSE 0 END AS cr,
    (CASE WHEN SentCount > 0 THEN BounceCount / CAST(SentCount AS DOUBLE) * 100.0 ELSE 0 END > 2.0
     OR CASE WHEN SentCount > 0 THEN ComplaintCount / CAST(SentCount AS DOUBLE) * 100.0 ELSE 0 END > 0.1) AS Breached FROM {pool_days}"""
ROLL_SQL = f"""SELECT *, CAST(sum(CASE WHEN Breached THEN 1 ELSE 0 END) OVER
    (PARTITION BY IpPool ORDER BY SendDate ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS BreachesInWindow,
    lag(SentCount) OVER (PARTITION BY IpPool ORDER BY SendDate) AS PriorVolume FROM ({GUARD_SQL}) g"""


@query("win_rolling_breach", f"SELECT IpPool, SendDate, Breached, BreachesInWindow FROM ({ROLL_SQL}) r")
def _(t):
    return monitors.rolling_breaches(t.pool_days).select("IpPool", "SendDate", "Breached", "BreachesInWindow")


@query("win_prior_value", f"SELECT IpPool, SendDate, SentCount, PriorVolume FROM ({ROLL_SQL}) r")
def _(t):
    return monitors.prior_volume(t.pool_days).select("IpPool", "SendDate", "SentCount", "PriorVolume")


@query(
    "win_gap_restart",
    """SELECT IpPool, SendDate, gap AS GapDays, CASE WHEN gap > 1 THEN CAST(floor(last * 0.5) AS BIGINT) END AS RestartVolume FROM (
         SELECT IpPool, SendDate, date_diff('day', lag(SendDate) OVER w, SendDate) AS gap, lag(SentCount) OVER w AS last
         FROM {pool_days} WHERE BounceCount > 0 WINDOW w AS (PARTITION BY IpPool ORDER BY SendDate)) x""",
)
def _(t):
    return monitors.gap_restart(t.pool_days.filter("BounceCount > 0")).select("IpPool", "SendDate", "GapDays", "RestartVolume")


CHANGE_SQL = """SELECT Id, ContactId, SystemModstamp FROM (SELECT *, lag(Escalated) OVER (PARTITION BY Id ORDER BY SystemModstamp, ChangeId) AS before
    FROM {case_history}) h WHERE Escalated AND NOT coalesce(before, FALSE)"""


@query("win_change_detect", CHANGE_SQL)
def _(t):
    return crm.escalations(t.case_history)


@query(
    "win_dod_growth",
    """SELECT IpPool, SendDate, round(SentCount / CAST(nullif(lag(SentCount) OVER w, 0) AS DOUBLE), 6) AS Growth,
              coalesce(SentCount / CAST(nullif(lag(SentCount) OVER w, 0) AS DOUBLE) > 1.1, FALSE) AS TooFast
       FROM {pool_days} WINDOW w AS (PARTITION BY IpPool ORDER BY SendDate)""",
)
def _(t):
    grown = monitors.day_over_day(t.pool_days, 1.1)
    return grown.select("IpPool", "SendDate", F.round("Growth", 6).alias("Growth"), "TooFast")


# -- sorts, limits, sets -----------------------------------------------------------------
@query(
    "srt_order_by",
    "SELECT SubscriberKey, LastEngagementDate FROM {dated_subscribers} WHERE LastEngagementDate IS NOT NULL ORDER BY LastEngagementDate DESC, SubscriberKey",
)
def _(t):
    dated = t.dated_subscribers.filter(F.col("LastEngagementDate").isNotNull())
    return dated.select("SubscriberKey", "LastEngagementDate").orderBy(F.col("LastEngagementDate").desc(), "SubscriberKey")


@query(
    "top_k_per_key",
    """SELECT Category, SKU, Slot FROM (SELECT Category, SKU, row_number() OVER (PARTITION BY Category ORDER BY AvgRating DESC, SKU) AS Slot
       FROM {products} WHERE InStock) p WHERE Slot <= 4""",
)
def _(t):
    from lifeloom.operators.recommend import top_in_stock

    return top_in_stock(t.products, 4).select("Category", "SKU", "Slot")


AUDIENCE = """SELECT SubscriberKey, LastEngagementDate, CASE WHEN SMSOptIn THEN 'ip-pool-us-primary' ELSE 'ip-pool-ca-primary' END AS IpPool
    FROM {dated_subscribers} WHERE LastEngagementDate IS NOT NULL"""


@query(
    "top_k_under_cap",
    f"""SELECT IpPool, SubscriberKey, Position FROM (SELECT *, row_number() OVER (PARTITION BY IpPool ORDER BY LastEngagementDate DESC, SubscriberKey) AS Position
        FROM ({AUDIENCE}) a) r JOIN (SELECT IpPool AS p, sum(SentCount) AS Cap FROM {{pool_days}} GROUP BY 1) c ON p = IpPool WHERE Position <= Cap""",
)
def _(t):
    caps = t.pool_days.groupBy("IpPool").agg(F.sum("SentCount").alias("Cap"))
    return winback.under_cap(t.sql(AUDIENCE), caps).select("IpPool", "SubscriberKey", "Position")


@query(
    "top_k_by_score",
    """SELECT IpPool, SubscriberKey, EngagementScore, Position FROM (
         SELECT *, row_number() OVER (PARTITION BY IpPool ORDER BY EngagementScore DESC, SubscriberKey) AS Position FROM (
           SELECT s.SubscriberKey, CASE WHEN SMSOptIn THEN 'ip-pool-us-primary' ELSE 'ip-pool-ca-primary' END AS IpPool,
                  arg_max(EngagementScore, ScoreDate) AS EngagementScore
           FROM {subscribers} s JOIN {scores} e ON e.SubscriberKey = s.SubscriberKey GROUP BY 1, 2) x) r WHERE Position <= 50""",
)
def _(t):
    pool = F.when(F.col("SMSOptIn"), "ip-pool-us-primary").otherwise("ip-pool-ca-primary")
    candidates = t.subscribers.select("SubscriberKey", pool.alias("IpPool"))
    return winback.best_scores_first(candidates, t.scores, 50).select("IpPool", "SubscriberKey", "EngagementScore", "Position")


@query(
    "top_first_row",
    "SELECT CartId, min(CartLineItemId) AS CartLineItemId FROM {cart_lines} GROUP BY CartId",
)
def _(t):
    return first_k(t.cart_lines, ["CartId"], [F.col("CartLineItemId")], 1).select("CartId", "CartLineItemId")


@query(
    "set_union_all",
    "SELECT SubscriberKey, EventDate FROM {opens} UNION ALL SELECT SubscriberKey, EventDate FROM {clicks}",
)
def _(t):
    return t.opens.select("SubscriberKey", "EventDate").unionByName(t.clicks.select("SubscriberKey", "EventDate"))


@query(
    "set_values_greatest",
    """SELECT SubscriberKey, (SELECT max(d) FROM (VALUES (LastEngagementDate), (o), (c)) v(d)) AS Latest FROM (
         SELECT s.SubscriberKey, s.LastEngagementDate, o.m AS o, c.m AS c FROM {dated_subscribers} s
         LEFT JOIN (SELECT SubscriberKey, max(EventDate) m FROM {opens} GROUP BY 1) o ON o.SubscriberKey = s.SubscriberKey
         LEFT JOIN (SELECT SubscriberKey, max(EventDate) m FROM {clicks} GROUP BY 1) c ON c.SubscriberKey = s.SubscriberKey) x""",
)
def _(t):
    o = t.opens.groupBy("SubscriberKey").agg(F.max("EventDate").alias("_o"))
    c = t.clicks.groupBy("SubscriberKey").agg(F.max("EventDate").alias("_c"))
    joined = t.dated_subscribers.join(o, "SubscriberKey", "left").join(c, "SubscriberKey", "left")
    return joined.select("SubscriberKey", F.greatest("LastEngagementDate", "_o", "_c").alias("Latest"))


# -- scalar functions --------------------------------------------------------------------
@query(
    "fn_dates",
    f"""SELECT OrderId, OrderDate + INTERVAL 30 MINUTE AS PlusMinutes, OrderDate + INTERVAL 1 MONTH AS PlusMonth,
               OrderDate - INTERVAL 90 DAY AS MinusDays, date_diff('day', CAST(OrderDate AS DATE), DATE '2001-08-02') AS Age,
               year(OrderDate) AS Y, month(OrderDate) AS M, day(OrderDate) AS D, strftime(OrderDate, '%Y') AS YearText
        FROM {{shop_orders}}""",
)
def _(t):
    d = F.col("OrderDate")
    return t.shop_orders.select(
        "OrderId",
        shift(d, 30, "minute").alias("PlusMinutes"),
        shift(d, 1, "month").alias("PlusMonth"),
        shift(d, -90, "day").alias("MinusDays"),
        days_between(d, as_ts(ORDERS_NOW)).alias("Age"),
        F.year(d).alias("Y"),
        F.month(d).alias("M"),
        F.dayofmonth(d).alias("D"),
        F.date_format(d, "yyyy").alias("YearText"),
    )


@query(
    "fn_text",
    """SELECT OrderId, concat('X-', ShippingCarrier, '-', OrderId) AS Joined, coalesce(nullif(ShippingCarrier, ''), 'there') AS Fallback,
              sha256(concat(SubscriberKey, 'salt')) AS Hashed, printf('%.2f', OrderTotal) AS Fixed, substring(TrackingNumber, 1, 4) AS Cut,
              format('{{:,.2f}}', CAST(OrderTotal AS DOUBLE)) AS Money
       FROM {shop_orders}""",
)
def _(t):
    from lifeloom.functions.columns import display_money, joined

    return t.shop_orders.select(
        "OrderId",
        joined("X-", F.col("ShippingCarrier"), "-", F.col("OrderId")).alias("Joined"),
        or_default("ShippingCarrier", "there").alias("Fallback"),
        F.sha2(joined(F.col("SubscriberKey"), "salt"), 256).alias("Hashed"),
        F.format_string("%.2f", F.col("OrderTotal").cast("double")).alias("Fixed"),
        F.substring("TrackingNumber", 1, 4).alias("Cut"),
        display_money("OrderTotal").alias("Money"),
    )


@query(
    "fn_validation",
    """SELECT SubscriberKey, regexp_matches(EmailAddress, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') AS EmailOk,
              regexp_matches(regexp_replace(MobileNumber, '[\\s()-]', '', 'g'), '^\\+?[0-9]{{10,15}}$') AS MobileOk,
              length(LastName) >= 3 AS LongEnough FROM {subscribers}""",
)
def _(t):
    from lifeloom.functions.columns import EMAIL_PATTERN, MOBILE_NOISE, MOBILE_PATTERN

    return t.subscribers.select(
        "SubscriberKey",
        F.col("EmailAddress").rlike(EMAIL_PATTERN).alias("EmailOk"),
        F.regexp_replace("MobileNumber", MOBILE_NOISE, "").rlike(MOBILE_PATTERN).alias("MobileOk"),
        (F.length("LastName") >= 3).alias("LongEnough"),
    )
