"""Queries for lifecycle jobs, reports, insights and monitors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lifeloom.functions.columns import effective_price, or_default
from lifeloom.operators import carts, catalog, crm, hygiene, insights, loyalty, monitors, orders, reports, winback
from lifeloom.sources.registry import Retention
from lifeloom.workload.base import query
from lifeloom.workload.primitives import DMARC_SQL, FAVOURITES_SQL, LTV_SQL, ROLL_SQL, RULE_SQL, SPEND_SQL, ltv
from lifeloom.workload.sources import dmarc_records
from lifeloom.workload.views import BU, CARTS_NOW, EVENTS_NOW, FALLBACK_NOW, ORDERS_NOW

O_TS = f"TIMESTAMP '{ORDERS_NOW}'"
E_TS = f"TIMESTAMP '{EVENTS_NOW}'"
NTZ = "timestamp_ntz"

# Trailing spend in the driver's data is far above the public thresholds; scaled so that all tiers occur.
SCALED_TIERS = [(900000, "Platinum"), (500000, "Gold"), (200000, "Silver")]
TIER_CASE = "CASE WHEN {x} >= 900000 THEN 'Platinum' WHEN {x} >= 500000 THEN 'Gold' WHEN {x} >= 200000 THEN 'Silver' ELSE 'Bronze' END"


def tier_case(x: str) -> str:
    return TIER_CASE.format(x=x)


# -- hygiene -----------------------------------------------------------------------------
@query(
    "job_global_suppression",
    f"""SELECT s.SubscriberKey,
          CASE WHEN due AND r IN ('SpamComplaint', 'Unsubscribe', 'LegalOptOut') THEN 'Unsubscribed' WHEN due AND r = 'HardBounce' THEN 'Bounced'
               ELSE SubscriberStatus END AS SubscriberStatus,
          CASE WHEN due THEN FALSE ELSE EmailOptIn END AS EmailOptIn,
          CASE WHEN due THEN {O_TS} END AS LastModifiedDate
        FROM (SELECT s.*, p.SuppressionReason AS r, p.SuppressionReason IS NOT NULL AND (SubscriberStatus <> 'Unsubscribed' OR EmailOptIn) AS due
              FROM {{subscribers}} s LEFT JOIN {{suppression}} p ON lower(trim(p.EmailAddress)) = lower(trim(s.EmailAddress))) s""",
)
def _(t):
    out = hygiene.apply_suppression(t.subscribers, t.suppression, ORDERS_NOW)
    return out.select("SubscriberKey", "SubscriberStatus", "EmailOptIn", "LastModifiedDate")


@query(
    "job_refresh_engagement",
    f"""SELECT s.SubscriberKey, CASE WHEN e IS NULL AND m IS NULL THEN LastEngagementDate
               ELSE greatest(coalesce(e, m), coalesce(m, e), coalesce(LastEngagementDate, e, m)) END AS LastEngagementDate,
               CASE WHEN e IS NULL AND m IS NULL THEN NULL ELSE {O_TS} END AS LastModifiedDate
        FROM {{dated_subscribers}} s
        LEFT JOIN (SELECT SubscriberKey, max(EventDate) e FROM (SELECT * FROM {{old_opens}} UNION ALL SELECT * FROM {{old_clicks}}) u GROUP BY 1) a ON a.SubscriberKey = s.SubscriberKey
        LEFT JOIN (SELECT MobileNumber, max(EventDate) m FROM {{old_sms}} WHERE EventType IN ('Inbound', 'KeywordResponse') GROUP BY 1) b ON b.MobileNumber = s.MobileNumber""",
)
def _(t):
    out = hygiene.refresh_engagement(t.dated_subscribers, t.old_opens, t.old_clicks, t.old_sms, ORDERS_NOW)
    return out.select("SubscriberKey", "LastEngagementDate", "LastModifiedDate")


@query(
    "job_cascade_orphans",
    """SELECT 'preferences' AS TableName, SubscriberKey AS RowKey FROM {preferences} WHERE SubscriberKey IN (SELECT SubscriberKey FROM {loyalty})
       UNION ALL SELECT 'addresses', AddressId FROM {addresses} WHERE SubscriberKey IN (SELECT SubscriberKey FROM {loyalty})
       UNION ALL SELECT 'carts', CartId FROM {carts} WHERE SubscriberKey IN (SELECT SubscriberKey FROM {loyalty})
       UNION ALL SELECT 'cart_lines', CartLineItemId FROM {cart_lines} WHERE CartId IN
          (SELECT CartId FROM {carts} WHERE SubscriberKey IN (SELECT SubscriberKey FROM {loyalty}))
       UNION ALL SELECT 'orders', OrderId FROM {shop_orders}""",
)
def _(t):
    # Loyalty members stand in for the subscribers that still exist.
    kept = hygiene.cascade_orphans(
        {
            "subscribers": t.loyalty.select("SubscriberKey"),
            "preferences": t.preferences,
            "addresses": t.addresses,
            "carts": t.carts,
            "cart_lines": t.cart_lines,
            "orders": t.shop_orders,
        }
    )
    keys = {"preferences": "SubscriberKey", "addresses": "AddressId", "carts": "CartId", "cart_lines": "CartLineItemId", "orders": "OrderId"}
    out = None
    for name, key in keys.items():
        rows = kept[name].select(F.lit(name).alias("TableName"), F.col(key).alias("RowKey"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "job_archive_orders",
    f"""SELECT OrderId, SubscriberKey, OrderDate, OrderStatus, CAST(OrderTotal AS DOUBLE) AS OrderTotal, Currency, ShippingCarrier,
               TrackingNumber, EstimatedDeliveryDate, ActualDeliveryDate, {O_TS} AS ArchivedDate
        FROM {{shop_orders}} WHERE OrderDate < {O_TS} - INTERVAL 1095 DAY""",
)
def _(t):
    return hygiene.archive_orders(t.shop_orders, ORDERS_NOW)


@query(
    "job_retention_sweep",
    f"""SELECT 'orders' AS TableName, OrderId AS RowKey FROM {{shop_orders}} WHERE NOT OrderDate < {O_TS} - INTERVAL 1095 DAY
        UNION ALL SELECT 'orders_archive', OrderId FROM {{shop_orders}} WHERE OrderDate < {O_TS} - INTERVAL 1095 DAY
        UNION ALL SELECT 'order_lines', LineItemId FROM {{order_lines}} WHERE OrderId IN
            (SELECT OrderId FROM {{shop_orders}} WHERE NOT OrderDate < {O_TS} - INTERVAL 1095 DAY)
        UNION ALL SELECT 'subscribers', SubscriberKey FROM {{dated_subscribers}}
            WHERE LastEngagementDate IS NULL OR LastEngagementDate >= {O_TS} - INTERVAL 730 DAY""",
)
def _(t):
    from lifeloom.sources.registry import REGISTRY

    tables = {"subscribers": t.dated_subscribers, "orders": t.shop_orders, "order_lines": t.order_lines}
    kept = hygiene.retention_sweep(tables, REGISTRY, ORDERS_NOW)
    keys = {"orders": "OrderId", "orders_archive": "OrderId", "order_lines": "LineItemId", "subscribers": "SubscriberKey"}
    out = None
    for name, key in keys.items():
        rows = kept[name].select(F.lit(name).alias("TableName"), F.col(key).alias("RowKey"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "job_dsar_erasure",
    """WITH k AS (SELECT SubscriberKey FROM {leaves} UNION SELECT b.SubscriberKey FROM {bridge} a JOIN {bridge} b
                   ON CAST(a.SubscriberKey AS BIGINT) // 3 = CAST(b.SubscriberKey AS BIGINT) // 3 WHERE a.SubscriberKey IN (SELECT SubscriberKey FROM {leaves}))
       SELECT 'subscribers' AS TableName, CASE WHEN SubscriberKey IN (SELECT SubscriberKey FROM k) THEN 'erased-' || SubscriberKey || '@erased.invalid' ELSE EmailAddress END AS RowKey FROM {subscribers}
       UNION ALL SELECT 'preferences', SubscriberKey FROM {preferences} WHERE SubscriberKey NOT IN (SELECT SubscriberKey FROM k)
       UNION ALL SELECT 'addresses', AddressId FROM {addresses} WHERE SubscriberKey NOT IN (SELECT SubscriberKey FROM k)
       UNION ALL SELECT 'carts', CartId FROM {carts} WHERE SubscriberKey NOT IN (SELECT SubscriberKey FROM k)
       UNION ALL SELECT 'consent_log', ConsentLogId || coalesce(CASE WHEN SubscriberKey IN (SELECT SubscriberKey FROM k) THEN NULL ELSE IPAddress END, '') FROM {consent_log}
       UNION ALL SELECT 'consent_log', 'DSAR-' || SubscriberKey || '-20240131000000' FROM {subscribers} WHERE SubscriberKey IN (SELECT SubscriberKey FROM k)
       UNION ALL SELECT 'suppression', 'sha256:' || sha256(lower(trim(EmailAddress))) FROM {subscribers} WHERE SubscriberKey IN (SELECT SubscriberKey FROM k)
       UNION ALL SELECT 'suppression', 'erased-' || SubscriberKey || '@erased.invalid' FROM {subscribers} WHERE SubscriberKey IN (SELECT SubscriberKey FROM k)
       UNION ALL SELECT 'suppression', EmailAddress FROM {suppression}""",
)
def _(t):
    tables = {
        "subscribers": t.subscribers,
        "preferences": t.preferences,
        "addresses": t.addresses,
        "carts": t.carts,
        "consent_log": t.consent_log,
        "suppression": t.suppression,
    }
    # Three neighbouring subscribers are one individual: a request of one of them concerns all three.
    person = F.concat(F.lit("U"), F.floor(F.col("SubscriberKey").cast("bigint") / 3).cast("string"))
    kept = hygiene.erase(tables, t.leaves.select("SubscriberKey"), EVENTS_NOW, t.bridge.withColumn("UnifiedIndividualId", person))
    shown = {
        "subscribers": F.col("EmailAddress"),
        "preferences": F.col("SubscriberKey"),
        "addresses": F.col("AddressId"),
        "carts": F.col("CartId"),
        "consent_log": F.concat_ws("", "ConsentLogId", "IPAddress"),
        "suppression": F.col("EmailAddress"),
    }
    out = None
    for name, key in shown.items():
        rows = kept[name].select(F.lit(name).alias("TableName"), key.alias("RowKey"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "job_bounce_complaint_suppression",
    f"""SELECT lower(trim(s.EmailAddress)) AS EmailAddress, max(r) AS SuppressionReason, {E_TS} AS SuppressedDate FROM (
          SELECT SubscriberKey, 'HardBounce' AS r FROM {{bounces}} WHERE BounceCategory = 'Hard'
          UNION ALL SELECT SubscriberKey, 'SpamComplaint' FROM {{complaints}}) f
        JOIN {{subscribers}} s ON s.SubscriberKey = f.SubscriberKey
        WHERE lower(trim(s.EmailAddress)) NOT IN (SELECT lower(trim(EmailAddress)) FROM {{suppression}}) GROUP BY 1""",
)
def _(t):
    rows = hygiene.suppress_bounces_and_complaints(t.suppression, t.subscribers, t.bounces, t.complaints, EVENTS_NOW, BU)
    return rows.select("EmailAddress", "SuppressionReason", "SuppressedDate")


@query(
    "job_sms_stop",
    """SELECT p.SubscriberKey, CASE WHEN k = 'STOP' THEN FALSE ELSE SMSOptIn END AS SMSOptIn,
              CASE WHEN k = 'STOP' THEN 'SMSKeyword' ELSE UpdateSource END AS UpdateSource
       FROM {preferences} p LEFT JOIN (SELECT SubscriberKey, k FROM {subscribers} s JOIN
            (SELECT MobileNumber, arg_max(upper(trim(Keyword)), (EventDate, Keyword)) AS k FROM {old_sms} GROUP BY 1) m
            ON m.MobileNumber = s.MobileNumber) x ON x.SubscriberKey = p.SubscriberKey""",
)
def _(t):
    return hygiene.sms_stop(t.preferences, t.subscribers, t.old_sms, ORDERS_NOW).select("SubscriberKey", "SMSOptIn", "UpdateSource")


# -- carts and codes ---------------------------------------------------------------------
CART_SQL = f"""SELECT CartId, CASE WHEN st = 'Abandoned' AND CartLastUpdatedDate <= TIMESTAMP '{CARTS_NOW}' - INTERVAL 14 DAY THEN 'Expired' ELSE st END AS CartStatus
    FROM (SELECT c.CartId, c.CartLastUpdatedDate, CASE WHEN c.CartStatus = 'Active' AND ItemCount > 0
              AND CartLastUpdatedDate <= TIMESTAMP '{CARTS_NOW}' - INTERVAL 30 MINUTE AND s.SubscriberStatus = 'Active' AND s.EmailOptIn
              THEN 'Abandoned' ELSE c.CartStatus END AS st FROM {{carts}} c LEFT JOIN {{subscribers}} s ON s.SubscriberKey = c.SubscriberKey) x"""


@query("job_abandoned_carts", CART_SQL)
def _(t):
    return carts.detect_abandoned(t.carts, t.subscribers, CARTS_NOW).select("CartId", "CartStatus")


@query(
    "job_cart_recovery",
    f"""SELECT a.CartId, CASE WHEN p.CartId IS NOT NULL THEN 'Converted' ELSE a.CartStatus END AS CartStatus,
               CASE WHEN p.CartId IS NOT NULL AND a.CartStatus = 'Abandoned' THEN {E_TS} END AS RecoveredDate
        FROM ({CART_SQL}) a LEFT JOIN (SELECT DISTINCT CartId FROM {{cart_history}} WHERE CartStatus = 'Converted') p ON p.CartId = a.CartId""",
)
def _(t):
    detected = carts.detect_abandoned(t.carts, t.subscribers, CARTS_NOW)
    checkouts = t.cart_history.filter("CartStatus = 'Converted'")
    return carts.recover(detected, checkouts, EVENTS_NOW).select("CartId", "CartStatus", "RecoveredDate")


def pool(t):
    return t.code_pool.withColumn("ExpirationDate", F.col("ExpirationDay").cast(NTZ)).drop("ExpirationDay")


def staged_codes(t):
    """Half of the codes are in the pool already; parts name the new ones."""
    new = t.part.select(
        F.concat(F.lit("N"), F.lpad(F.col("p_partkey").cast("string"), 10, "0")).alias("DiscountCode"),
        F.when(F.col("p_size") < 25, "AbandonedCart10").otherwise("AbandonedCart15").alias("CampaignType"),
        F.lit(15).alias("DiscountPercent"),
    )
    return new.unionByName(t.code_pool.select("DiscountCode", "CampaignType", "DiscountPercent"))


@query(
    "job_code_pool_replenish",
    f"""SELECT DiscountCode, CampaignType, IsUsed, CAST(ExpirationDay AS TIMESTAMP) AS ExpirationDate FROM {{code_pool}}
        WHERE NOT (NOT IsUsed AND ExpirationDay < CAST({E_TS} AS DATE))
        UNION ALL SELECT 'N' || lpad(CAST(p_partkey AS STRING), 10, '0'), CASE WHEN p_size < 25 THEN 'AbandonedCart10' ELSE 'AbandonedCart15' END,
               FALSE, {E_TS} + INTERVAL 90 DAY FROM {{part}}""",
)
def _(t):
    out = carts.replenish(pool(t), staged_codes(t), EVENTS_NOW)
    return out.select("DiscountCode", "CampaignType", "IsUsed", "ExpirationDate")


REQUESTS = """SELECT CAST(event_id AS STRING) AS RequestId, CAST(user_id AS STRING) AS SubscriberKey,
    CASE WHEN value > 60 THEN 'AbandonedCart10' WHEN value > 5 THEN 'AbandonedCart15' ELSE 'WelcomeSeries' END AS CampaignType,
    ts AS RequestedDate FROM {events} WHERE event_type = 'view'"""
ALLOC_SQL = f"""SELECT r.RequestId, r.CampaignType, coalesce(c.DiscountCode, CASE WHEN r.CampaignType = 'AbandonedCart15' THEN 'CARTSAVE15' ELSE 'CARTSAVE10' END) AS DiscountCode,
    c.DiscountCode IS NOT NULL AS Allocated,
    CASE WHEN c.DiscountCode IS NOT NULL THEN CAST({E_TS} AS DATE) + CASE WHEN r.CampaignType = 'AbandonedCart15' THEN 1 ELSE 7 END END AS ExpiresOn
    FROM (SELECT *, row_number() OVER (PARTITION BY CampaignType ORDER BY RequestedDate, RequestId) AS n FROM ({REQUESTS}) q) r
    LEFT JOIN (SELECT DiscountCode, CampaignType, row_number() OVER (PARTITION BY CampaignType ORDER BY DiscountCode) AS n FROM {{code_pool}} WHERE NOT IsUsed) c
      ON c.CampaignType = r.CampaignType AND c.n = r.n"""


def allocations(t):
    return carts.allocate_codes(t.sql(REQUESTS), pool(t), EVENTS_NOW)


@query("join_allocate_rank", f"SELECT RequestId, CampaignType, DiscountCode, Allocated FROM ({ALLOC_SQL}) a")
def _(t):
    return allocations(t).select("RequestId", "CampaignType", "DiscountCode", "Allocated")


@query("job_allocate_codes", ALLOC_SQL)
def _(t):
    return allocations(t).select("RequestId", "CampaignType", "DiscountCode", "Allocated", "ExpiresOn")


# -- orders ------------------------------------------------------------------------------
FALLBACK_SQL = f"""SELECT OrderId, SubscriberKey, 'APIEvent-OrderShipped' AS FallbackEventType FROM {{shop_orders}}
      WHERE OrderStatus = 'Confirmed' AND EstimatedDeliveryDate <= TIMESTAMP '{FALLBACK_NOW}' + INTERVAL 1 DAY
    UNION ALL SELECT OrderId, SubscriberKey, 'APIEvent-OrderDelivered' FROM {{shop_orders}}
      WHERE OrderStatus = 'Shipped' AND EstimatedDeliveryDate <= TIMESTAMP '{FALLBACK_NOW}' - INTERVAL 1 DAY"""


@query("job_order_fallback", FALLBACK_SQL)
def _(t):
    return orders.overdue_events(t.shop_orders, FALLBACK_NOW)


@query(
    "job_fallback_emit",
    f"""SELECT OrderId, FallbackEventType, '{{{{"ContactKey":"' || SubscriberKey || '","EventDefinitionKey":"' || FallbackEventType
            || '","Data":{{{{"SubscriberKey":"' || SubscriberKey || '","OrderId":"' || OrderId || '","Source":"TimeoutFallback"}}}}}}}}' AS Payload
        FROM ({FALLBACK_SQL}) q""",
)
def _(t):
    queue = orders.overdue_events(t.shop_orders, FALLBACK_NOW).withColumn("Processed", F.lit(False))
    return orders.outbox(queue)


@query(
    "job_anonymized_orders",
    f"""SELECT sha256(o.SubscriberKey || (SELECT max(r_name) FROM {{region}})) AS HashedCustomerId, OrderId, OrderDate, OrderStatus,
               CAST(OrderTotal AS DOUBLE) AS OrderTotal, Currency, StateProvince, CountryCode
        FROM {{shop_orders}} o LEFT JOIN (SELECT * FROM {{addresses}} WHERE AddressType = 'Shipping' AND IsDefault) a ON a.SubscriberKey = o.SubscriberKey
        WHERE OrderDate >= {O_TS} - INTERVAL 30 DAY""",
)
def _(t):
    config = t.region.select(F.lit("AnonymizationSalt").alias("Name"), F.col("r_name").alias("Value"))
    return orders.anonymized(t.shop_orders, t.addresses, config, ORDERS_NOW, days=30)


# -- loyalty -----------------------------------------------------------------------------
SPEND = f"""SELECT SubscriberKey, sum(OrderTotal) AS sp FROM {{shop_orders}} WHERE OrderStatus NOT IN ('Cancelled', 'Returned')
    AND OrderDate >= {O_TS} - INTERVAL 12 MONTH GROUP BY 1"""


@query(
    "job_loyalty_tiers",
    f"""SELECT SubscriberKey, CAST(sp AS DOUBLE) AS TrailingTwelveMonthSpend, {tier_case('sp')} AS CurrentTier,
               CAST(CASE WHEN sp >= 900000 THEN NULL WHEN sp >= 500000 THEN 900000 - sp WHEN sp >= 200000 THEN 500000 - sp ELSE 200000 - sp END AS DOUBLE) AS PointsToNextTier,
               CASE WHEN old <> {tier_case('sp')} THEN {O_TS} END AS TierEffectiveDate, {O_TS} + INTERVAL 12 MONTH AS TierExpirationDate
        FROM (SELECT l.SubscriberKey, l.CurrentTier AS old, coalesce(s.sp, 0) AS sp FROM {{loyalty}} l LEFT JOIN ({SPEND}) s ON s.SubscriberKey = l.SubscriberKey) x""",
)
def _(t):
    out = loyalty.recalculate_tiers(t.loyalty, t.shop_orders, ORDERS_NOW, SCALED_TIERS)
    return out.select(
        "SubscriberKey", "TrailingTwelveMonthSpend", "CurrentTier", "PointsToNextTier", "TierEffectiveDate", "TierExpirationDate"
    )


@query(
    "job_loyalty_enroll",
    f"""SELECT SubscriberKey, 'LOY-' || SubscriberKey AS LoyaltyMemberId, {tier_case('sp')} AS CurrentTier, CAST(sp AS DOUBLE) AS TrailingTwelveMonthSpend
        FROM ({SPEND}) s WHERE SubscriberKey NOT IN (SELECT SubscriberKey FROM {{loyalty}})""",
)
def _(t):
    rows = loyalty.enroll(t.loyalty, t.shop_orders, ORDERS_NOW, SCALED_TIERS)
    return rows.select("SubscriberKey", "LoyaltyMemberId", "CurrentTier", "TrailingTwelveMonthSpend")


@query(
    "job_points_earned",
    """SELECT SubscriberKey, CurrentTier, CAST(floor(CAST(TrailingTwelveMonthSpend AS DOUBLE) * CASE CurrentTier WHEN 'Platinum' THEN 2.0
         WHEN 'Gold' THEN 1.5 WHEN 'Silver' THEN 1.25 ELSE 1.0 END) AS BIGINT) AS PointsEarned FROM {loyalty}""",
)
def _(t):
    return loyalty.points_earned(t.loyalty)


BIRTHDAY_SQL = """SELECT s.SubscriberKey, EmailAddress, FirstName, coalesce(l.CurrentTier, 'Bronze') AS CurrentTier, 2001 AS BirthdayYear
    FROM {subscribers} s LEFT JOIN {loyalty} l ON l.SubscriberKey = s.SubscriberKey
    WHERE SubscriberStatus = 'Active' AND EmailOptIn AND month(DateOfBirth) = 8 AND day(DateOfBirth) = 2
      AND s.SubscriberKey NOT IN (SELECT SubscriberKey FROM {old_sent} WHERE year(EventDate) = 2001)"""


def birthday_entries(t):
    # Anyone mailed this year stands in for the log of this year's entries.
    log = t.old_sent.select("SubscriberKey", F.year("EventDate").alias("BirthdayYear"))
    return loyalty.birthday_entries(t.subscribers, t.loyalty, log, ORDERS_NOW)


@query("job_birthdays", BIRTHDAY_SQL)
def _(t):
    return birthday_entries(t)


@query(
    "prj_tier_offer",
    """SELECT SubscriberKey, CurrentTier, CASE CurrentTier WHEN 'Platinum' THEN '30% off + a surprise gift with your order'
         WHEN 'Gold' THEN '25% off + free gift wrapping' WHEN 'Silver' THEN '20% off + free shipping' ELSE '15% off your next order' END AS OfferText,
         CASE CurrentTier WHEN 'Platinum' THEN 'BDAYPLAT30' WHEN 'Gold' THEN 'BDAYGOLD25' WHEN 'Silver' THEN 'BDAYSILV20' ELSE 'BDAYBRZ15' END AS PromoCode
       FROM {loyalty}""",
)
def _(t):
    return loyalty.with_tier_offer(t.loyalty.select("SubscriberKey", "CurrentTier"))


@query(
    "prj_name_fallback",
    """SELECT OrderId, coalesce(nullif(ShippingCarrier, ''), 'there') AS FirstName, coalesce(nullif(CAST(NULL AS STRING), ''), 'WELCOME15') AS PromoCode
       FROM {shop_orders}""",
)
def _(t):
    blankish = t.shop_orders.withColumn("Promo", F.lit("").cast("string"))
    return blankish.select(
        "OrderId", or_default("ShippingCarrier", "there").alias("FirstName"), or_default("Promo", "WELCOME15").alias("PromoCode")
    )


@query(
    "prj_effective_price",
    """SELECT SKU, CAST(CASE WHEN SalePrice > 0 AND SalePrice < Price THEN SalePrice ELSE Price END AS DOUBLE) AS CartPrice,
              CAST(CASE WHEN SalePrice > 0 THEN SalePrice ELSE Price END AS DOUBLE) AS CrossSellPrice FROM {products}""",
)
def _(t):
    return t.products.select(
        "SKU", effective_price().alias("CartPrice"), effective_price(below_price=False).alias("CrossSellPrice")
    )


@query(
    "prj_shipping_enrich",
    """SELECT q.SubscriberKey, q.OrderId, coalesce(o.ShippingCarrier, '') AS ShippingCarrier, coalesce(o.TrackingNumber, '') AS TrackingNumber, o.EstimatedDeliveryDate
       FROM {event_orders} q LEFT JOIN {shop_orders} o ON o.OrderId = q.OrderId""",
)
def _(t):
    return orders.shipping_details(t.event_orders.select("SubscriberKey", "OrderId"), t.shop_orders)


# -- win-back ----------------------------------------------------------------------------
INACTIVE_SQL = """SELECT s.SubscriberKey, EmailAddress, FirstName, tier AS InactivityTier, d AS DaysSinceEngagement FROM (
      SELECT SubscriberKey, d, CASE WHEN d >= 270 THEN 'Sunset' WHEN d >= 180 THEN 'Tier2_180Day' WHEN d >= 90 THEN 'Tier1_90Day' END AS tier FROM (
        SELECT n.SubscriberKey, date_diff('day', CAST(greatest(coalesce(o, c), coalesce(c, o)) AS DATE), DATE '2001-08-02') AS d
        FROM (SELECT DISTINCT SubscriberKey FROM {old_sent}) n
        LEFT JOIN (SELECT SubscriberKey, max(EventDate) o FROM {old_opens} GROUP BY 1) a ON a.SubscriberKey = n.SubscriberKey
        LEFT JOIN (SELECT SubscriberKey, max(EventDate) c FROM {old_clicks} GROUP BY 1) b ON b.SubscriberKey = n.SubscriberKey) x WHERE d >= 90) y
    JOIN {subscribers} s ON s.SubscriberKey = y.SubscriberKey
    LEFT JOIN {winback_log} w ON w.SubscriberKey = y.SubscriberKey AND w.InactivityTier = tier
    WHERE SubscriberStatus = 'Active' AND EmailOptIn AND w.SubscriberKey IS NULL"""


def inactive(t):
    return winback.inactive_entries(t.subscribers, t.old_sent, t.old_opens, t.old_clicks, t.winback_log, ORDERS_NOW)


@query("job_inactive_tiers", INACTIVE_SQL)
def _(t):
    return inactive(t).drop("DetectedDate")


def sunset_sql(more: str = "") -> str:
    return f"""SELECT s.SubscriberKey, CASE WHEN k.SubscriberKey IS NOT NULL THEN 'Sunset' ELSE SubscriberStatus END AS SubscriberStatus,
               CASE WHEN k.SubscriberKey IS NOT NULL THEN FALSE ELSE EmailOptIn END AS EmailOptIn,
               CASE WHEN k.SubscriberKey IS NOT NULL THEN 'SUNSET-' || s.SubscriberKey || '-20010802000000' END AS ConsentLogId
        FROM {{subscribers}} s LEFT JOIN (
          SELECT s.SubscriberKey FROM {{subscribers}} s JOIN {{winback_log}} l ON l.SubscriberKey = s.SubscriberKey AND l.InactivityTier = 'Sunset'
          WHERE s.SubscriberStatus = 'Active' {more}
            AND NOT EXISTS (SELECT 1 FROM {{old_opens}} o WHERE o.SubscriberKey = s.SubscriberKey AND o.EventDate >= l.EnteredDate)
            AND NOT EXISTS (SELECT 1 FROM {{old_clicks}} c WHERE c.SubscriberKey = s.SubscriberKey AND c.EventDate >= l.EnteredDate)) k
        ON k.SubscriberKey = s.SubscriberKey"""


def sunset_rows(t, **options):
    updated, consent = winback.sunset(t.subscribers, t.winback_log, t.old_opens, t.old_clicks, ORDERS_NOW, **options)
    return updated.join(consent.select("SubscriberKey", "ConsentLogId"), "SubscriberKey", "left").select(
        "SubscriberKey", "SubscriberStatus", "EmailOptIn", "ConsentLogId"
    )


@query("job_sunset", sunset_sql())
def _(t):
    return sunset_rows(t, require_series=False)


@query("job_sunset_series", sunset_sql("AND CAST(s.SubscriberKey AS BIGINT) % 3 = 0"))
def _(t):
    # The default: only contacts that have finished the series, here every third.
    done = t.subscribers.filter(F.col("SubscriberKey").cast("bigint") % 3 == 0).select("SubscriberKey")
    return sunset_rows(t, series_done=done)


@query(
    "job_frequency_cap",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY SubscriberKey ORDER BY ScoreDate DESC) AS n FROM {scores}),
            t AS (SELECT quantile_cont(CAST(EngagementScore AS DOUBLE), 0.10) AS lim FROM r WHERE n = 1),
            low AS (SELECT SubscriberKey FROM r WHERE n <= 4 GROUP BY 1 HAVING count(*) = 4 AND max(EngagementScore) <= (SELECT lim FROM t))
       SELECT p.SubscriberKey, CASE WHEN low.SubscriberKey IS NOT NULL AND FrequencyPreference = 'Standard' THEN 'Reduced' ELSE FrequencyPreference END AS FrequencyPreference,
              CASE WHEN low.SubscriberKey IS NOT NULL AND FrequencyPreference = 'Standard' THEN 'EinsteinLowEngagementCap' ELSE UpdateSource END AS UpdateSource
       FROM {preferences} p LEFT JOIN low ON low.SubscriberKey = p.SubscriberKey""",
)
def _(t):
    return winback.frequency_cap(t.preferences, t.scores, EVENTS_NOW).select("SubscriberKey", "FrequencyPreference", "UpdateSource")


@query(
    "job_warmup_segment",
    f"""SELECT 'engaged' AS Stage, SubscriberKey, EmailAddress, LastEngagementDate FROM {{dated_subscribers}}
        WHERE SubscriberStatus = 'Active' AND EmailOptIn AND LastEngagementDate >= {O_TS} - INTERVAL 90 DAY
        UNION ALL SELECT 'full', SubscriberKey, EmailAddress, LastEngagementDate FROM {{dated_subscribers}}
        WHERE SubscriberStatus = 'Active' AND EmailOptIn AND SubscriberKey NOT IN (SELECT SubscriberKey FROM {{winback_log}})""",
)
def _(t):
    stages = {
        "engaged": winback.warmup_segment(t.dated_subscribers, ORDERS_NOW, 90),
        "full": winback.warmup_segment(t.dated_subscribers, ORDERS_NOW, None, t.winback_log),
    }
    out = None
    for name, df in stages.items():
        rows = df.select(F.lit(name).alias("Stage"), "SubscriberKey", "EmailAddress", "LastEngagementDate")
        out = rows if out is None else out.unionByName(rows)
    return out


# -- catalog -----------------------------------------------------------------------------
VALID = "SKU IS NOT NULL AND Price >= 0 AND InventoryCount >= 0"


@query(
    "job_catalog_reject",
    f"""SELECT 'CATALOG-VALIDATION-' || coalesce(SKU, '') || '-20010802000000-' || substring(md5(ErrorMessage), 1, 8) AS ErrorLogId, ErrorMessage, 'Warning' AS Severity
        FROM (SELECT SKU, 'Invalid row rejected: SKU=' || coalesce(SKU, 'NULL') || ', Price=' || coalesce(CAST(Price AS STRING), 'NULL')
               || ', InventoryCount=' || coalesce(CAST(InventoryCount AS STRING), 'NULL') AS ErrorMessage
        FROM {{staging_products}} WHERE NOT coalesce({VALID}, FALSE)) r""",
)
def _(t):
    return catalog.rejected(t.staging_products, ORDERS_NOW).select("ErrorLogId", "ErrorMessage", "Severity")


PROMOTE_SQL = f"""SELECT coalesce(p.SKU, s.SKU) AS SKU, CASE WHEN v THEN s.ProductName ELSE p.ProductName END AS ProductName,
      CAST(CASE WHEN v THEN s.Price ELSE p.Price END AS DOUBLE) AS Price, CAST(CASE WHEN v THEN s.SalePrice ELSE p.SalePrice END AS DOUBLE) AS SalePrice,
      CASE WHEN v THEN s.InStock WHEN s.SKU IS NULL THEN FALSE ELSE p.InStock END AS InStock,
      CASE WHEN v THEN s.InventoryCount WHEN s.SKU IS NULL THEN 0 ELSE p.InventoryCount END AS InventoryCount,
      CASE WHEN v OR s.SKU IS NULL THEN {O_TS} END AS LastSyncedDate
    FROM {{products}} p FULL OUTER JOIN (SELECT *, coalesce({VALID}, FALSE) AS v FROM {{staging_products}} WHERE SKU IS NOT NULL) s ON s.SKU = p.SKU
    WHERE p.SKU IS NOT NULL OR v"""


@query("job_catalog_promote", PROMOTE_SQL)
def _(t):
    out = catalog.promoted(t.products, t.staging_products, ORDERS_NOW)
    return out.select("SKU", "ProductName", "Price", "SalePrice", "InStock", "InventoryCount", "LastSyncedDate")


@query(
    "job_catalog_rowcount_guard",
    f"""SELECT today AS TodayCount, prev AS PreviousCount, round((today - prev) / CAST(prev AS DOUBLE) * 100.0, 1) AS ChangePct,
               (today - prev) / CAST(prev AS DOUBLE) * 100.0 < -20 AS Anomaly
        FROM (SELECT (SELECT count(*) FROM ({PROMOTE_SQL}) n WHERE InStock) AS today, (SELECT count(*) * 2 FROM {{products}} WHERE InStock) AS prev) x""",
)
def _(t):
    # Twice today's stock recorded yesterday: the guard must report an anomaly.
    before = t.products.filter("InStock").agg((F.count(F.lit(1)) * 2).cast("string").alias("MetricValue"))
    # A higher value recorded earlier must not count: the last one does.
    history = before.withColumn("MetricName", F.lit(catalog.METRIC)).withColumn("RecordedDate", F.lit("2001-08-01").cast("timestamp_ntz"))
    older = history.withColumns({"MetricValue": F.lit("999999999"), "RecordedDate": F.lit("2001-07-01").cast("timestamp_ntz")})
    history = history.unionByName(older)
    return catalog.row_count_check(catalog.promoted(t.products, t.staging_products, ORDERS_NOW), history)


# -- CRM ---------------------------------------------------------------------------------
@query(
    "job_identity_bridge_sync",
    f"""SELECT c.Id AS UnifiedIndividualId, '{BU}' AS BusinessUnitMID, s.SubscriberKey, 1.0 AS MatchConfidenceScore, {O_TS} AS LastResolvedDate
        FROM {{crm_contacts}} c JOIN {{subscribers}} s ON lower(trim(s.EmailAddress)) = lower(trim(c.Email))
        WHERE s.SubscriberKey NOT IN (SELECT SubscriberKey FROM {{bridge}} WHERE BusinessUnitMID = '{BU}')
        UNION ALL SELECT b.UnifiedIndividualId, b.BusinessUnitMID, b.SubscriberKey, CAST(b.MatchConfidenceScore AS DOUBLE),
               CASE WHEN c.Id IS NOT NULL THEN {O_TS} END FROM {{bridge}} b LEFT JOIN {{subscribers}} s ON s.SubscriberKey = b.SubscriberKey
        LEFT JOIN {{crm_contacts}} c ON c.Id = b.UnifiedIndividualId AND lower(trim(s.EmailAddress)) = lower(trim(c.Email))""",
)
def _(t):
    added = crm.bridge_matches(t.crm_contacts, t.subscribers, t.bridge, ORDERS_NOW, BU)
    refreshed = crm.refresh_bridge(t.bridge, t.crm_contacts, t.subscribers, ORDERS_NOW, BU)
    return added.unionByName(refreshed)


@query(
    "job_crm_suppression",
    """WITH c AS (SELECT b.SubscriberKey, bool_or(k.DoNotMarket OR x.ContactId IS NOT NULL) AS blocked FROM {bridge} b
                  JOIN {crm_contacts} k ON k.Id = b.UnifiedIndividualId
                  LEFT JOIN (SELECT DISTINCT ContactId FROM {crm_cases} WHERE Escalated AND Status <> 'Closed') x ON x.ContactId = k.Id GROUP BY 1)
       SELECT p.SubscriberKey, CASE WHEN blocked AND PromotionalOptIn THEN FALSE
                WHEN NOT PromotionalOptIn AND UpdateSource = 'CRMSuppressionSync' AND NOT blocked THEN TRUE ELSE PromotionalOptIn END AS PromotionalOptIn,
              CASE WHEN blocked AND PromotionalOptIn THEN 'CRMSuppressionSync' ELSE UpdateSource END AS UpdateSource
       FROM {preferences} p LEFT JOIN c ON c.SubscriberKey = p.SubscriberKey""",
)
def _(t):
    out = crm.promotional_suppression(t.preferences, t.bridge, t.crm_contacts, t.crm_cases, ORDERS_NOW)
    return out.select("SubscriberKey", "PromotionalOptIn", "UpdateSource")


# -- reports -----------------------------------------------------------------------------
def views(t):
    return t.sent, t.opens, t.clicks, t.bounces, t.unsubscribes, t.complaints


#: Names of the journeys as rows; a template without one counts as an ad hoc campaign.
NAMED = "(VALUES " + ", ".join(f"('{prefix}', '{label}')" for prefix, label in reports.JOURNEY_PREFIXES) + ") AS named(prefix, label)"


def reached(since: str, until: str = "TIMESTAMP '9999-01-01 00:00:00'") -> str:
    """One row per (job, template, subscriber, kind): the sends of a period, and what ever came back for them."""
    kinds = {"open": "opens", "click": "clicks", "bounce": "bounces", "unsubscribe": "unsubscribes", "complaint": "complaints"}
    back = " UNION ".join(f"SELECT '{kind}' AS kind, JobID, SubscriberKey FROM {{{view}}}" for kind, view in kinds.items())
    who = f"SELECT DISTINCT JobID, EmailName, SubscriberKey FROM {{sent}} WHERE EventDate >= {since} AND EventDate < {until}"
    return f"""SELECT 'sent' AS kind, * FROM ({who}) w
        UNION ALL SELECT kind, JobID, EmailName, SubscriberKey FROM ({who}) w JOIN ({back}) b USING (JobID, SubscriberKey)"""


def share(part: str) -> str:
    return f"round(100.0 * {part} / CAST(nullif(SentCount, 0) AS DOUBLE), 4)"


def tallies(*kinds: str) -> str:
    return ", ".join(f"count(*) FILTER (kind = '{kind}') AS {kind.capitalize()}Count" for kind in kinds)


@query(
    "rpt_campaign_performance",
    f"""WITH tally AS (SELECT JobID, EmailName, {tallies("sent", "open", "click", "bounce", "unsubscribe", "complaint")}
                       FROM ({reached(E_TS + " - INTERVAL 30 DAY")}) r GROUP BY JobID, EmailName)
        SELECT tally.*, coalesce(label, '{reports.OTHER_JOURNEY}') AS JourneyLabel, {share("OpenCount")} AS OpenRatePct, {share("ClickCount")} AS ClickRatePct,
               {share("BounceCount")} AS BounceRatePct, {share("ComplaintCount")} AS ComplaintRatePct
        FROM tally LEFT JOIN {NAMED} ON starts_with(EmailName, prefix)""",
)
def _(t):
    return reports.campaign_performance(*views(t), as_of=EVENTS_NOW)


@query(
    "rpt_click_rate_by_journey",
    f"""WITH person AS (SELECT DISTINCT coalesce(label, '{reports.OTHER_JOURNEY}') AS JourneyLabel, kind, SubscriberKey
                        FROM ({reached(E_TS + " - INTERVAL 30 DAY")}) r LEFT JOIN {NAMED} ON starts_with(EmailName, prefix)),
             tally AS (SELECT JourneyLabel, {tallies("sent", "open", "click")} FROM person GROUP BY JourneyLabel)
        SELECT JourneyLabel, SentCount, {share("OpenCount")} AS OpenRatePct, {share("ClickCount")} AS ClickRatePct FROM tally""",
)
def _(t):
    return reports.click_rate_by_journey(*views(t), as_of=EVENTS_NOW)


def _kpi_part(label: str, lo: str, hi: str) -> str:
    return f"""SELECT '{label}' AS p, CAST(SentCount AS DOUBLE) AS SentCount, {share("OpenCount")} AS OpenRatePct, {share("ClickCount")} AS ClickRatePct,
        {share("BounceCount")} AS BounceRatePct, {share("ComplaintCount")} AS ComplaintRatePct
        FROM (SELECT {tallies("sent", "open", "click", "bounce", "complaint")} FROM ({reached(lo, hi)}) r) x"""


@query(
    "rpt_program_kpis",
    f"""WITH k AS ({_kpi_part('c', E_TS + ' - INTERVAL 15 DAY', E_TS + ' + INTERVAL 1 SECOND')} UNION ALL {_kpi_part('p', E_TS + ' - INTERVAL 30 DAY', E_TS + ' - INTERVAL 15 DAY')}),
          m AS (UNPIVOT k ON SentCount, OpenRatePct, ClickRatePct, BounceRatePct, ComplaintRatePct INTO NAME Metric VALUE v)
        SELECT Metric, max(CASE WHEN p = 'c' THEN v END) AS CurrentValue, max(CASE WHEN p = 'p' THEN v END) AS PriorValue,
               round(max(CASE WHEN p = 'c' THEN v END) - max(CASE WHEN p = 'p' THEN v END), 4) AS Change FROM m GROUP BY Metric""",
)
def _(t):
    return reports.program_kpis(*views(t), as_of=EVENTS_NOW, days=15)


DELIV_SQL = f"""WITH day_sends AS (SELECT DISTINCT CAST(EventDate AS DATE) AS SendDate, JobID, SubscriberKey FROM {{sent}} WHERE EventDate >= {E_TS} - INTERVAL 20 DAY),
      trouble AS (SELECT 'Bounce' AS kind, JobID, SubscriberKey FROM {{bounces}} UNION SELECT BounceCategory || 'Bounce', JobID, SubscriberKey FROM {{bounces}}
                  UNION SELECT 'Complaint', JobID, SubscriberKey FROM {{complaints}}),
      person AS (SELECT SendDate, 'Sent' AS kind, SubscriberKey FROM day_sends UNION SELECT SendDate, kind, SubscriberKey FROM day_sends JOIN trouble USING (JobID, SubscriberKey)),
      tally AS (SELECT SendDate, {", ".join(f"count(*) FILTER (kind = '{k}') AS {k}Count" for k in ("Sent", "Bounce", "HardBounce", "SoftBounce", "Complaint"))}
                FROM person GROUP BY SendDate)
    SELECT tally.*, '{BU}' AS BusinessUnitMID, {share("BounceCount")} AS BounceRatePct, {share("ComplaintCount")} AS ComplaintRatePct,
           CASE WHEN BounceCount * 50 > SentCount OR ComplaintCount * 1000 > SentCount THEN 'BREACH' ELSE 'OK' END AS GuardrailStatus FROM tally"""


@query("rpt_deliverability", DELIV_SQL)
def _(t):
    return reports.deliverability(t.sent, t.bounces, t.complaints, EVENTS_NOW, BU, days=20)


def _variants(entries: str, group: str, email: str, start: str, days: int) -> str:
    return f"""SELECT {group} AS g, count(DISTINCT a.SubscriberKey) AS Sent,
        count(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM {{opens}} o WHERE o.SubscriberKey = a.SubscriberKey AND o.EmailName = a.{email} AND o.EventDate >= a.{start}) THEN a.SubscriberKey END) AS Opens,
        count(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM {{clicks}} o WHERE o.SubscriberKey = a.SubscriberKey AND o.EmailName = a.{email} AND o.EventDate >= a.{start}) THEN a.SubscriberKey END) AS Clicks,
        max(conv) AS Conversions, max(rev) AS AttributedRevenue
      FROM {{{entries}}} a LEFT JOIN (SELECT g2, count(DISTINCT SubscriberKey) AS conv, CAST(sum(OrderTotal) AS DOUBLE) AS rev FROM (
          SELECT DISTINCT e.{group} AS g2, o.SubscriberKey, o.OrderId, o.OrderTotal FROM {{{entries}}} e JOIN {{event_orders}} o
            ON o.SubscriberKey = e.SubscriberKey AND o.OrderDate BETWEEN e.{start} AND e.{start} + INTERVAL {days} DAY) d GROUP BY g2) r ON g2 = {group} GROUP BY 1"""


def _pct(n: str, d: str) -> str:
    return f"round(100.0 * {n} / CAST(nullif({d}, 0) AS DOUBLE), 4)"


@query(
    "rpt_ab_test",
    f"""SELECT 'Birthday Creative Test' AS TestName, g AS Variant, Sent, Opens, Clicks, Conversions, {_pct('Opens', 'Sent')} AS OpenRatePct,
          {_pct('Clicks', 'Sent')} AS ClickRatePct, {_pct('Conversions', 'Sent')} AS ConversionRatePct, AttributedRevenue
        FROM ({_variants('ab_assignments', 'Variant', 'EmailNameSent', 'EntryDate', 14)}) v ORDER BY Variant""",
)
def _(t):
    return reports.ab_test(t.ab_assignments, t.opens, t.clicks, t.event_orders, "Birthday Creative Test")


@query(
    "rpt_content_selection",
    f"""SELECT g AS ContentVariant, Sent, Clicks AS Clicked, {_pct('Clicks', 'Sent')} AS ClickRatePct, Conversions AS Converted, AttributedRevenue
        FROM ({_variants('content_experiment', 'ContentVariant', 'EmailName', 'SendDate', 7)}) v ORDER BY 1""",
)
def _(t):
    return reports.content_selection(t.content_experiment, t.clicks, t.event_orders)


@query(
    "rpt_engagement_distribution",
    """SELECT CASE WHEN EngagementScore >= 80 THEN '80-100 (Highly Engaged)' WHEN EngagementScore >= 60 THEN '60-79 (Engaged)'
                WHEN EngagementScore >= 40 THEN '40-59 (Moderate)' WHEN EngagementScore >= 20 THEN '20-39 (Low)' ELSE '0-19 (At Risk)' END AS ScoreBand,
              count(DISTINCT SubscriberKey) AS SubscriberCount, round(avg(EngagementScore), 4) AS AvgScoreInBand
       FROM {scores} WHERE ScoreDate = (SELECT max(ScoreDate) FROM {scores}) GROUP BY 1 ORDER BY min(EngagementScore) DESC""",
)
def _(t):
    return reports.engagement_distribution(t.scores)


@query(
    "rpt_latest_scores",
    """SELECT s.SubscriberKey, EngagementScore, ScoreDate FROM {subscribers} s JOIN {scores} e ON e.SubscriberKey = s.SubscriberKey
       WHERE ScoreDate = (SELECT max(ScoreDate) FROM {scores}) ORDER BY EngagementScore, s.SubscriberKey""",
)
def _(t):
    return reports.latest_scores(t.subscribers, t.scores)


# -- insights ----------------------------------------------------------------------------
@query("ins_lifetime_value", LTV_SQL)
def _(t):
    return ltv(t)


AFFINITY_SQL = f"""SELECT BuyerId AS UnifiedIndividualId, liked[1] AS TopCategory, liked[2] AS SecondCategory, CAST(most AS DOUBLE) AS TopCategorySpend
    FROM ({FAVOURITES_SQL}) r JOIN (SELECT BuyerId, max(CategorySpend) AS most FROM ({SPEND_SQL}) m GROUP BY BuyerId) t USING (BuyerId)"""


@query("ins_category_affinity", AFFINITY_SQL)
def _(t):
    return insights.category_affinity(t.buyer_orders, t.order_lines_cat)


def short_bridge(t):
    return t.bridge.select(F.expr("substring(UnifiedIndividualId, 2)").alias("UnifiedIndividualId"), "SubscriberKey")


@query(
    "ins_activation",
    f"""SELECT v.UnifiedIndividualId, b.SubscriberKey, LifetimeSpend, LifetimeOrderCount, DaysSinceLastOrder, ChurnRiskSegment, TopCategory, SecondCategory
        FROM ({LTV_SQL}) v LEFT JOIN ({AFFINITY_SQL}) a ON a.UnifiedIndividualId = v.UnifiedIndividualId
        JOIN {{bridge}} b ON substring(b.UnifiedIndividualId, 2) = v.UnifiedIndividualId""",
)
def _(t):
    merged = insights.merged_insights(ltv(t), insights.category_affinity(t.buyer_orders, t.order_lines_cat), ORDERS_NOW)
    return insights.activated(merged, short_bridge(t)).select(
        "UnifiedIndividualId", "SubscriberKey", "LifetimeSpend", "LifetimeOrderCount", "DaysSinceLastOrder", "ChurnRiskSegment",
        "TopCategory", "SecondCategory",
    )


@query(
    "seg_high_value_at_risk",
    f"""SELECT b.SubscriberKey, v.UnifiedIndividualId, v.DaysSinceLastOrder FROM ({RULE_SQL}) v
        JOIN {{bridge}} b ON substring(b.UnifiedIndividualId, 2) = v.UnifiedIndividualId""",
)
def _(t):
    return insights.high_value_at_risk(ltv(t), short_bridge(t)).drop("LifetimeSpend")


# -- monitors ----------------------------------------------------------------------------
@query(
    "mon_guardrail_day",
    f"SELECT IpPool, SendDate, round(br, 6) AS BounceRate, round(cr, 6) AS ComplaintRate, Breached FROM ({ROLL_SQL}) r",
)
def _(t):
    rated = monitors.daily_rates(t.pool_days)
    return rated.select(
        "IpPool", "SendDate", F.round("BounceRate", 6).alias("BounceRate"), F.round("ComplaintRate", 6).alias("ComplaintRate"), "Breached"
    )


@query(
    "mon_guardrail_action",
    f"""SELECT IpPool, SendDate, CASE WHEN BreachesInWindow >= 2 THEN 'ROLLBACK' WHEN Breached THEN 'HOLD_FLAT' ELSE 'PROCEED' END AS Action,
          CASE WHEN BreachesInWindow >= 2 THEN BreachesInWindow || ' of the last 3 days over a limit'
               WHEN Breached THEN printf('latest day over a limit: bounces %.2f%%, complaints %.3f%%', br, cr)
               ELSE 'all limits kept' END AS Reason,
          CASE WHEN BreachesInWindow >= 2 THEN PriorVolume END AS RollbackToVolume
        FROM (SELECT *, row_number() OVER (PARTITION BY IpPool ORDER BY SendDate DESC) AS n FROM ({ROLL_SQL}) r) x WHERE n = 1""",
)
def _(t):
    return monitors.next_action(t.pool_days)


@query(
    "mon_ramp_cap",
    """SELECT IpPool, SendDate, n AS DayNumber, CASE WHEN n <= 3 THEN 1000 WHEN n <= 7 THEN 5000 WHEN n <= 11 THEN 10000
              WHEN n <= 15 THEN 25000 WHEN n <= 19 THEN 50000 WHEN n <= 23 THEN 100000 WHEN n <= 27 THEN 250000
              WHEN n <= 30 THEN 500000 END AS DailyCapPerIP
       FROM (SELECT IpPool, SendDate, row_number() OVER (PARTITION BY IpPool ORDER BY SendDate) + 2 AS n FROM {pool_days}) d""",
)
def _(t):
    from pyspark.sql import Window as W

    numbered = t.pool_days.withColumn("DayNumber", F.row_number().over(W.partitionBy("IpPool").orderBy("SendDate")) + 2)
    return monitors.ramp_cap(numbered).select("IpPool", "SendDate", "DayNumber", "DailyCapPerIP")


@query(
    "mon_alert_sweep",
    f"""SELECT 'automation-ops' AS Channel, '[Error] Product-Catalog-Nightly-ETL / Validate-And-Promote-Catalog: Invalid row rejected: SKU=' || coalesce(SKU, 'NULL')
            || ', Price=' || coalesce(CAST(Price AS STRING), 'NULL') || ', InventoryCount=' || coalesce(CAST(InventoryCount AS STRING), 'NULL') AS Message
        FROM {{staging_products}} WHERE NOT coalesce({VALID}, FALSE) AND Price IS NULL
        UNION ALL SELECT 'deliverability', printf('unit %s, %s: %s%% bounces, %s%% complaints; limits 2%% and 0.1%%', BusinessUnitMID, CAST(SendDate AS STRING),
              CAST(round(CAST(BounceRatePct AS DECIMAL(18,4)), 2) AS STRING), CAST(round(CAST(ComplaintRatePct AS DECIMAL(18,4)), 3) AS STRING)) FROM ({DELIV_SQL}) d WHERE GuardrailStatus = 'BREACH'""",
)
def _(t):
    log = catalog.rejected(t.staging_products, ORDERS_NOW).withColumn(
        "Severity", F.when(F.col("ErrorMessage").contains("Price=NULL"), "Error").otherwise("Warning")
    )
    log = log.withColumn("Resolved", F.lit(False))
    status = reports.deliverability(t.sent, t.bounces, t.complaints, EVENTS_NOW, BU, days=20)
    return monitors.alert_rows(log, status, EVENTS_NOW).drop("RaisedDate")


@query(
    "mon_dmarc_summary",
    f"""SELECT *, round(DkimPass / CAST(TotalMessages AS DOUBLE) * 100.0, 1) AS DkimPassPct, round(SpfPass / CAST(TotalMessages AS DOUBLE) * 100.0, 1) AS SpfPassPct,
            starts_with(Pool, 'UNKNOWN') AND TotalMessages > 0 AS SpoofingAlert FROM ({DMARC_SQL}) d""",
)
def _(t):
    return monitors.dmarc_summary(dmarc_records(t))


# -- send time ---------------------------------------------------------------------------
@query(
    "sto_best_hour",
    """WITH h AS (SELECT SubscriberKey, hour(EventDate) AS h, count(*) AS n FROM {opens} GROUP BY 1, 2),
            b AS (SELECT SubscriberKey, arg_max(h, (n, -h)) AS h FROM h GROUP BY 1),
            a AS (SELECT e.SubscriberKey, e.EntryDate AS a, CASE WHEN p.PreferredSendTimeStart IS NULL THEN 9 ELSE 8 END AS lo,
                         CASE WHEN p.PreferredSendTimeEnd IS NULL THEN 18 ELSE 12 END AS hi, b.h
                  FROM {signups} e LEFT JOIN b ON b.SubscriberKey = e.SubscriberKey LEFT JOIN {preferences} p ON p.SubscriberKey = e.SubscriberKey),
            c AS (SELECT SubscriberKey, a, least(greatest(coalesce(h, lo), lo), hi - 1) AS hh FROM a),
            d AS (SELECT *, date_trunc('day', a) + to_hours(hh) AS today FROM c),
            e AS (SELECT *, CASE WHEN today >= a THEN today ELSE today + INTERVAL 1 DAY END AS due FROM d)
       SELECT SubscriberKey, a AS ArrivalDate, CAST(hh AS BIGINT) AS SendHour,
              due + CASE CAST(due AS DATE) WHEN DATE '2024-01-01' THEN INTERVAL 2 DAY WHEN DATE '2024-01-02' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS SendAt FROM e""",
)
def _(t):
    arrivals = t.signups.select("SubscriberKey", F.col("EntryDate").alias("ArrivalDate"))
    blackouts = t.events.select(F.to_date("ts").alias("CalendarDate")).distinct().filter("CalendarDate <= DATE '2024-01-02'")
    return winback.send_times(arrivals, t.opens, t.preferences, blackouts)
