"""Domain views over the driver's tables, as SQL that Spark and DuckDB both read.

The same text feeds the Spark queries and the check SQL; the operators themselves are
written in the DataFrame API, so the two sides agree only if the operator is right.
Attributes the driver's tables lack are derived from the columns they have (balances,
segments, priorities, sizes).  Every view reads its tables whole.
"""

from __future__ import annotations

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

#: "Now" of the order-based queries and of the event-based ones.
ORDERS_NOW = "2001-08-02 00:00:00"
EVENTS_NOW = "2024-01-31 00:00:00"
FALLBACK_NOW = "1998-06-01 00:00:00"
CARTS_NOW = "2024-01-30 12:00:00"
BU = "5000011"

VIEWS: dict[str, str] = {
    # -- people ---------------------------------------------------------------------
    "subscribers": """
        SELECT CAST(c_custkey AS STRING) AS SubscriberKey,
               lower(c_name) || '@example.com' AS EmailAddress,
               '+1' || lpad(CAST(c_custkey AS STRING), 10, '0') AS MobileNumber,
               c_mktsegment AS FirstName,
               translate(CAST(c_custkey AS STRING), '0123456789', 'aeioulnrst') AS LastName,
               DATE '1970-01-01' + CAST(floor(c_acctbal) AS INT) AS DateOfBirth,
               '5000011' AS BusinessUnitMID,
               c_acctbal >= 0 AS EmailOptIn,
               c_nationkey % 2 = 0 AS SMSOptIn,
               CASE WHEN c_acctbal < -500 THEN 'Unsubscribed' WHEN c_acctbal > 9500 THEN 'Held' ELSE 'Active' END
                   AS SubscriberStatus,
               CAST(NULL AS TIMESTAMP) AS LastModifiedDate
        FROM {customer}""",
    "suppression": """
        SELECT upper(c_name) || '@EXAMPLE.com ' AS EmailAddress,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'HardBounce' WHEN 'BUILDING' THEN 'SpamComplaint'
                    WHEN 'FURNITURE' THEN 'Unsubscribe' WHEN 'HOUSEHOLD' THEN 'LegalOptOut'
                    ELSE 'ManualSuppress' END AS SuppressionReason
        FROM {customer} WHERE c_acctbal > 8800 OR c_acctbal < -800""",
    "preferences": """
        SELECT CAST(c_custkey AS STRING) AS SubscriberKey,
               c_mktsegment IN ('AUTOMOBILE', 'BUILDING') AS CategoryWomens,
               c_mktsegment IN ('FURNITURE', 'BUILDING') AS CategoryMens,
               CASE WHEN c_nationkey < 15 THEN 'Standard' WHEN c_nationkey < 20 THEN 'Reduced' ELSE 'EssentialOnly' END
                   AS FrequencyPreference,
               c_acctbal < 5000 OR c_nationkey > 3 AS PromotionalOptIn,
               c_nationkey = 7 AS TransactionalOnly,
               TRUE AS SMSOptIn,
               CASE WHEN c_nationkey < 10 THEN '08:00' END AS PreferredSendTimeStart,
               CASE WHEN c_nationkey < 10 THEN '12:00' END AS PreferredSendTimeEnd,
               CAST(NULL AS TIMESTAMP) AS LastUpdated,
               CASE WHEN c_nationkey <= 2 THEN 'CRMSuppressionSync' ELSE 'PreferenceCenter' END AS UpdateSource
        FROM {customer} WHERE c_mktsegment <> 'MACHINERY'""",
    "addresses": """
        SELECT 'A' || CAST(c_custkey AS STRING) AS AddressId, CAST(c_custkey AS STRING) AS SubscriberKey,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Billing' ELSE 'Shipping' END AS AddressType,
               c_acctbal > 1000 AS IsDefault, n_name AS StateProvince,
               CAST(n_nationkey AS STRING) AS PostalCode,
               CASE WHEN n_regionkey = 0 THEN 'US' ELSE 'CA' END AS CountryCode
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    # -- orders ---------------------------------------------------------------------
    "shop_orders": """
        SELECT CAST(o_orderkey AS STRING) AS OrderId, CAST(o_custkey AS STRING) AS SubscriberKey,
               o_orderdate AS OrderDate,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Returned'
                    WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'Cancelled'
                    WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Confirmed'
                    ELSE 'Shipped' END AS OrderStatus,
               CAST(o_totalprice AS DECIMAL(18,2)) AS OrderTotal, 'USD' AS Currency,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 'Carrier ' || substring(o_orderpriority, 1, 1) END
                   AS ShippingCarrier,
               'T' || CAST(o_orderkey AS STRING) AS TrackingNumber,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate + INTERVAL '5' DAY END AS EstimatedDeliveryDate,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '6' DAY END AS ActualDeliveryDate
        FROM {orders}""",
    "order_lines": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
                   || '-' || CAST(l_suppkey AS STRING) AS LineItemId,
               CAST(l_orderkey AS STRING) AS OrderId, CAST(l_partkey AS STRING) AS SKU,
               CAST(l_quantity AS BIGINT) AS Quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS LineTotal
        FROM {lineitem}""",
    "order_lines_cat": """
        SELECT l.LineItemId, l.OrderId, l.SKU, l.LineTotal, p_type AS Category
        FROM {order_lines} l JOIN {part} ON l.SKU = CAST(p_partkey AS STRING)""",
    "buyer_orders": """
        SELECT OrderId, SubscriberKey AS BuyerId, OrderDate, OrderStatus, OrderTotal FROM {shop_orders}""",
    "individuals": "SELECT CAST(c_custkey AS STRING) AS UnifiedIndividualId FROM {customer}",
    "bridge": """
        SELECT 'U' || CAST(c_custkey AS STRING) AS UnifiedIndividualId, '5000011' AS BusinessUnitMID,
               CAST(c_custkey AS STRING) AS SubscriberKey, CAST(1 AS DECIMAL(18,2)) AS MatchConfidenceScore,
               CAST(NULL AS TIMESTAMP) AS LastResolvedDate
        FROM {customer} WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD')""",
    # -- catalog --------------------------------------------------------------------
    "products": """
        SELECT CAST(p_partkey AS STRING) AS SKU, p_name AS ProductName, p_type AS Category, p_brand AS Brand,
               CAST(p_retailprice AS DECIMAL(18,2)) AS Price,
               CASE WHEN p_size < 15 THEN CAST(p_retailprice * 0.8 AS DECIMAL(18,2))
                    WHEN p_size > 45 THEN CAST(p_retailprice * 1.2 AS DECIMAL(18,2))
                    ELSE CAST(0 AS DECIMAL(18,2)) END AS SalePrice,
               p_size <> 20 AS InStock,
               CASE WHEN p_size <> 20 THEN CAST(p_size AS BIGINT) * 3 ELSE CAST(0 AS BIGINT) END AS InventoryCount,
               CAST(1 + p_size % 5 AS DECIMAL(18,1)) AS AvgRating,
               CAST(NULL AS TIMESTAMP) AS LastSyncedDate
        FROM {part} WHERE p_size >= 5""",
    "staging_products": """
        SELECT CASE WHEN p_size = 4 THEN NULL ELSE CAST(p_partkey AS STRING) END AS SKU, p_name AS ProductName,
               p_type AS Category, p_brand AS Brand,
               CASE WHEN p_size = 9 THEN CAST(-1 AS DECIMAL(18,2)) WHEN p_size = 10 THEN NULL
                    ELSE CAST(p_retailprice * 1.1 AS DECIMAL(18,2)) END AS Price,
               CAST(0 AS DECIMAL(18,2)) AS SalePrice, p_size <> 21 AS InStock,
               CASE WHEN p_size = 11 THEN NULL WHEN p_size = 12 THEN CAST(-5 AS BIGINT)
                    ELSE CAST(p_size AS BIGINT) * 2 END AS InventoryCount,
               CAST(1 + p_size % 5 AS DECIMAL(18,1)) AS AvgRating
        FROM {part} WHERE p_size <= 45""",
    # -- engagement over years (orders stand in for sends, opens and clicks) ----------
    "old_sent": """
        SELECT CAST(o_custkey AS STRING) AS SubscriberKey, o_orderdate AS EventDate FROM {orders}""",
    "old_opens": """
        SELECT CAST(o_custkey AS STRING) AS SubscriberKey, o_orderdate AS EventDate FROM {orders}
        WHERE o_orderstatus = 'F'""",
    "old_clicks": """
        SELECT CAST(o_custkey AS STRING) AS SubscriberKey, o_orderdate AS EventDate FROM {orders}
        WHERE o_orderstatus = 'O'""",
    "old_sms": """
        SELECT '+1' || lpad(CAST(o_custkey AS STRING), 10, '0') AS MobileNumber, o_orderdate AS EventDate,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Inbound' WHEN o_orderpriority = '2-HIGH' THEN 'KeywordResponse'
                    ELSE 'Outbound' END AS EventType,
               CASE WHEN o_orderpriority = '1-URGENT' THEN ' stop' ELSE 'INFO' END AS Keyword
        FROM {orders} WHERE o_orderstatus = 'P'""",
    "dated_subscribers": """
        SELECT s.*, e.LastEngagementDate FROM {subscribers} s
        LEFT JOIN (SELECT SubscriberKey, max(EventDate) AS LastEngagementDate FROM {old_opens} GROUP BY SubscriberKey) e
        ON s.SubscriberKey = e.SubscriberKey""",
    "loyalty": """
        SELECT CAST(c_custkey AS STRING) AS SubscriberKey,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Gold' WHEN 'BUILDING' THEN 'Silver' WHEN 'FURNITURE' THEN 'Platinum'
                    ELSE 'Bronze' END AS CurrentTier,
               CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS TrailingTwelveMonthSpend,
               CAST(0 AS DECIMAL(18,2)) AS PointsToNextTier,
               CAST(NULL AS TIMESTAMP) AS TierEffectiveDate, CAST(NULL AS TIMESTAMP) AS TierExpirationDate,
               CAST(NULL AS TIMESTAMP) AS LastRecalculatedDate
        FROM {customer} WHERE c_nationkey < 20""",
    "winback_log": """
        SELECT CAST(c_custkey AS STRING) AS SubscriberKey,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Tier1_90Day' WHEN c_mktsegment = 'BUILDING' THEN 'Tier2_180Day'
                    ELSE 'Sunset' END AS InactivityTier,
               o.first_date AS EnteredDate
        FROM {customer} JOIN (SELECT o_custkey, min(o_orderdate) + INTERVAL '2000' DAY AS first_date
                              FROM {orders} GROUP BY o_custkey) o ON c_custkey = o_custkey
        WHERE c_mktsegment <> 'MACHINERY'""",
    # -- one month of events ----------------------------------------------------------
    "sent": """
        SELECT CAST(extract(day FROM ts) AS BIGINT) AS JobID, CAST(user_id AS STRING) AS SubscriberKey, ts AS EventDate,
               CASE extract(day FROM ts) % 7 WHEN 0 THEN 'EMAIL_WELCOME_01' WHEN 1 THEN 'EMAIL_CART_01' WHEN 2 THEN 'EMAIL_PP_02'
                    WHEN 3 THEN 'EMAIL_BIRTHDAY_VARIANT_A' WHEN 4 THEN 'EMAIL_WINBACK_01' WHEN 5 THEN 'EMAIL_VIP_RETENTION'
                    ELSE 'NEWSLETTER' END AS EmailName
        FROM {events} WHERE event_type IN ('signup', 'view')""",
    "opens": """
        SELECT CAST(extract(day FROM ts) AS BIGINT) AS JobID, CAST(user_id AS STRING) AS SubscriberKey, ts AS EventDate,
               CASE extract(day FROM ts) % 7 WHEN 0 THEN 'EMAIL_WELCOME_01' WHEN 1 THEN 'EMAIL_CART_01' WHEN 2 THEN 'EMAIL_PP_02'
                    WHEN 3 THEN 'EMAIL_BIRTHDAY_VARIANT_A' WHEN 4 THEN 'EMAIL_WINBACK_01' WHEN 5 THEN 'EMAIL_VIP_RETENTION'
                    ELSE 'NEWSLETTER' END AS EmailName
        FROM {events} WHERE event_type = 'view'""",
    "clicks": """
        SELECT CAST(extract(day FROM ts) AS BIGINT) AS JobID, CAST(user_id AS STRING) AS SubscriberKey, ts AS EventDate,
               CASE extract(day FROM ts) % 7 WHEN 0 THEN 'EMAIL_WELCOME_01' WHEN 1 THEN 'EMAIL_CART_01' WHEN 2 THEN 'EMAIL_PP_02'
                    WHEN 3 THEN 'EMAIL_BIRTHDAY_VARIANT_A' WHEN 4 THEN 'EMAIL_WINBACK_01' WHEN 5 THEN 'EMAIL_VIP_RETENTION'
                    ELSE 'NEWSLETTER' END AS EmailName
        FROM {events} WHERE event_type = 'click'""",
    "bounces": """
        SELECT CAST(extract(day FROM ts) AS BIGINT) AS JobID, CAST(user_id AS STRING) AS SubscriberKey, ts AS EventDate,
               CASE WHEN value > 60 THEN 'Hard' ELSE 'Soft' END AS BounceCategory
        FROM {events} WHERE event_type = 'error' AND value > 40""",
    "unsubscribes": """
        SELECT CAST(extract(day FROM ts) AS BIGINT) AS JobID, CAST(user_id AS STRING) AS SubscriberKey, ts AS EventDate
        FROM {events} WHERE event_type = 'error' AND value < 5""",
    "complaints": """
        SELECT CAST(extract(day FROM ts) AS BIGINT) AS JobID, CAST(user_id AS STRING) AS SubscriberKey, ts AS EventDate
        FROM {events} WHERE event_type = 'error' AND value BETWEEN 5 AND 8""",
    "event_orders": """
        SELECT CAST(event_id AS STRING) AS OrderId, CAST(user_id AS STRING) AS SubscriberKey, ts AS OrderDate,
               CAST(value AS DECIMAL(18,2)) AS OrderTotal
        FROM {events} WHERE event_type = 'purchase'""",
    "signups": """
        SELECT CAST(user_id AS STRING) AS SubscriberKey, min(ts) AS EntryDate FROM {events}
        WHERE event_type = 'signup' GROUP BY user_id""",
    "ab_assignments": """
        SELECT 'T' || SubscriberKey AS TestId, SubscriberKey, 'Birthday Creative Test' AS TestName,
               CASE WHEN c_acctbal < 4500 THEN 'A' ELSE 'B' END AS Variant, EntryDate,
               CASE WHEN c_acctbal < 4500 THEN 'EMAIL_WELCOME_01' ELSE 'EMAIL_BIRTHDAY_VARIANT_A' END AS EmailNameSent
        FROM {signups} JOIN {customer} ON SubscriberKey = CAST(c_custkey AS STRING)""",
    "content_experiment": """
        SELECT CAST(event_id AS STRING) AS ExperimentId, CAST(user_id AS STRING) AS SubscriberKey,
               CASE WHEN value > 20 THEN 'EMAIL_WELCOME_01' ELSE 'EMAIL_PP_02' END AS EmailName,
               CASE WHEN value > 15 THEN 'EinsteinContentSelection' ELSE 'RuleBasedControl' END AS ContentVariant,
               ts AS SendDate
        FROM {events} WHERE event_type = 'signup'""",
    "scores": """
        SELECT SubscriberKey, (k % 97) + (week % 3) AS EngagementScore, DATE '2024-01-01' + CAST(week * 7 AS INT) AS ScoreDate
        FROM (SELECT CAST(user_id AS STRING) AS SubscriberKey, user_id AS k,
                     CAST(floor((extract(day FROM ts) - 1) / 7) AS INT) AS week
              FROM {events} GROUP BY user_id, CAST(floor((extract(day FROM ts) - 1) / 7) AS INT)) w""",
    "leaves": """
        SELECT CAST(user_id AS STRING) AS SubscriberKey, min(ts) AS LeftDate FROM {events}
        WHERE event_type = 'error' AND value > 90 GROUP BY user_id""",
    "pool_days": """
        SELECT CASE WHEN user_id % 3 = 0 THEN 'ip-pool-us-primary' WHEN user_id % 3 = 1 THEN 'ip-pool-ca-primary'
                    ELSE 'ip-pool-outlet-shared' END AS IpPool,
               CAST(ts AS DATE) AS SendDate,
               count(CASE WHEN event_type <> 'error' THEN 1 END) AS SentCount,
               count(CASE WHEN event_type = 'error' AND value > 100 THEN 1 END) AS BounceCount,
               count(CASE WHEN event_type = 'error' AND value BETWEEN 5 AND 5.2 THEN 1 END) AS ComplaintCount
        FROM {events}
        GROUP BY CASE WHEN user_id % 3 = 0 THEN 'ip-pool-us-primary' WHEN user_id % 3 = 1 THEN 'ip-pool-ca-primary'
                      ELSE 'ip-pool-outlet-shared' END, CAST(ts AS DATE)""",
    # -- carts: one per user and day ----------------------------------------------------
    "carts": """
        SELECT CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS CartId,
               CAST(user_id AS STRING) AS SubscriberKey, min(ts) AS CartCreatedDate, max(ts) AS CartLastUpdatedDate,
               CASE WHEN max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1 AND min(value) > 10
                    THEN 'Converted' ELSE 'Active' END AS CartStatus,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS CartTotal,
               count(CASE WHEN event_type <> 'error' THEN 1 END) AS ItemCount,
               count(CASE WHEN event_type = 'signup' THEN 1 END) AS RecoveryEmailsSent,
               CAST(NULL AS TIMESTAMP) AS RecoveredDate
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    "cart_lines": """
        SELECT CAST(event_id AS STRING) AS CartLineItemId,
               CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS CartId,
               CAST(user_id AS STRING) AS SubscriberKey, regexp_extract(props, '[0-9]+', 0) AS SKU,
               CAST(1 + floor(value / 100) AS BIGINT) AS Quantity, ts AS AddedToCartDate
        FROM {events}""",
    "cart_history": """
        SELECT CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS CartId,
               ts AS StatusDate,
               CASE WHEN event_type = 'purchase' THEN 'Converted' WHEN event_type = 'click' THEN 'Active' ELSE 'Abandoned' END
                   AS CartStatus
        FROM {events}""",
    # -- CRM ----------------------------------------------------------------------------
    "crm_contacts": """
        SELECT 'U' || CAST(c_custkey AS STRING) AS Id, upper(c_name) || '@example.com' AS Email, c_mktsegment AS FirstName,
               c_acctbal < 500 AS DoNotMarket, CAST(c_nationkey AS STRING) AS PostalCode
        FROM {customer} WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')""",
    "crm_cases": """
        SELECT CAST(o_orderkey AS STRING) AS Id, 'U' || CAST(o_custkey AS STRING) AS ContactId,
               CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS Status,
               o_orderpriority AS Priority, o_orderpriority = '1-URGENT' AND o_totalprice > 300000 AS Escalated
        FROM {orders}""",
    "case_history": """
        SELECT CAST(user_id AS STRING) AS Id, 'U' || CAST(user_id AS STRING) AS ContactId, event_id AS ChangeId,
               ts AS SystemModstamp, event_type = 'error' AS Escalated,
               CASE WHEN event_type = 'purchase' THEN 'Closed' ELSE 'Open' END AS Status
        FROM {events}""",
    "consent_log": """
        SELECT 'C' || CAST(event_id AS STRING) AS ConsentLogId, CAST(user_id AS STRING) AS SubscriberKey,
               CASE WHEN event_type = 'error' THEN 'OptOut' ELSE 'OptIn' END AS ConsentAction,
               '10.0.0.1' AS IPAddress, ts AS Timestamp
        FROM {events}""",
    # -- codes --------------------------------------------------------------------------
    "code_pool": """
        SELECT 'P' || lpad(CAST(s_suppkey AS STRING), 10, '0') AS DiscountCode,
               CASE WHEN s_nationkey < 12 THEN 'AbandonedCart10' ELSE 'AbandonedCart15' END AS CampaignType,
               10 AS DiscountPercent, s_acctbal < 2000 AS IsUsed,
               CASE WHEN s_acctbal > 8000 THEN DATE '2023-12-01' ELSE DATE '2024-03-01' END AS ExpirationDay
        FROM {supplier}""",
    # -- journeys ---------------------------------------------------------------------
    "signup_entries": """
        SELECT CAST(user_id AS STRING) AS SubscriberKey, ts AS EntryDate FROM {events} WHERE event_type = 'signup'""",
    "cart_entries": """
        SELECT CAST(user_id AS STRING) AS CartId, CAST(user_id AS STRING) AS SubscriberKey, ts AS EntryDate
        FROM {events} WHERE event_type = 'signup'""",
    "user_history": """
        SELECT CAST(user_id AS STRING) AS CartId, ts AS StatusDate,
               CASE WHEN event_type = 'purchase' THEN 'Converted' ELSE 'Abandoned' END AS CartStatus
        FROM {events}""",
    "order_entries": """
        SELECT CAST(o_custkey AS STRING) AS SubscriberKey, CAST(o_orderkey AS STRING) AS OrderId, o_orderdate AS EntryDate
        FROM {orders}""",
    "shipped": """
        SELECT CAST(o_orderkey AS STRING) AS OrderId,
               o_orderdate + CASE WHEN o_orderpriority = '1-URGENT' THEN INTERVAL '2' DAY WHEN o_orderpriority = '5-LOW' THEN INTERVAL '12' DAY
                                  ELSE INTERVAL '6' DAY END AS EventDate
        FROM {orders} WHERE o_totalprice > 50000
        UNION ALL SELECT CAST(l_orderkey AS STRING), l_shipdate FROM {lineitem}""",
    "delivered": """
        SELECT CAST(o_orderkey AS STRING) AS OrderId, o_orderdate + INTERVAL '11' DAY AS EventDate FROM {orders}
        WHERE o_orderstatus <> 'P'
        UNION ALL SELECT CAST(l_orderkey AS STRING), l_shipdate FROM {lineitem} WHERE l_linestatus = 'F'""",
    "returned": """
        SELECT CAST(o_orderkey AS STRING) AS OrderId, o_orderdate + INTERVAL '15' DAY AS EventDate FROM {orders}
        WHERE o_orderstatus = 'F' AND o_totalprice < 200000""",
    "old_entries": """
        SELECT SubscriberKey, EnteredDate AS EntryDate FROM {winback_log}""",
    "old_orders": """
        SELECT CAST(o_custkey AS STRING) AS SubscriberKey, o_orderdate AS OrderDate FROM {orders}""",
    "case_entries": """
        SELECT CAST(user_id AS STRING) AS CaseId, CAST(user_id AS STRING) AS SubscriberKey, ts AS EntryDate
        FROM {events} WHERE event_type = 'error'""",
    "case_states": """
        SELECT Id AS CaseId, SystemModstamp AS StatusDate, Status FROM {case_history}""",
    # -- identity: three sources with one layout ------------------------------------------
    "id_records": """
        SELECT 'M' || CAST(c_custkey AS STRING) AS RecordId, 'MC_Subscribers' AS Source, CAST(c_custkey AS STRING) AS SourceKey,
               lower(c_name) || '@example.com' AS EmailAddress, '+1' || lpad(CAST(c_custkey AS STRING), 10, '0') AS MobileNumber,
               c_mktsegment AS FirstName, translate(CAST(c_custkey AS STRING), '0123456789', 'aeioulnrst') AS LastName,
               CAST(c_nationkey AS STRING) AS PostalCode, CAST(NULL AS STRING) AS MailingAddress,
               DATE '2000-01-01' + CAST(floor(c_acctbal) AS INT) AS UpdatedAt, '5000011' AS BusinessUnitMID
        FROM {customer}
        UNION ALL
        SELECT 'S' || CAST(c_custkey AS STRING), 'SF_Contacts', 'U' || CAST(c_custkey AS STRING), upper(c_name) || '@EXAMPLE.com',
               CAST(NULL AS STRING), c_mktsegment, 'Mc' || translate(CAST(c_custkey AS STRING), '0123456789', 'aeioulnrst'),
               CAST(c_nationkey AS STRING), 'Street ' || CAST(c_custkey AS STRING), DATE '2010-01-01' - CAST(floor(c_acctbal) AS INT), '5000011'
        FROM {customer} WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
        UNION ALL
        SELECT 'P' || CAST(c_custkey AS STRING), 'POS_Customers', CAST(c_custkey AS STRING), CAST(NULL AS STRING),
               CASE WHEN c_nationkey < 6 THEN '(' || substring(lpad(CAST(c_custkey AS STRING), 10, '0'), 1, 3) || ') '
                         || substring(lpad(CAST(c_custkey AS STRING), 10, '0'), 4, 7) END,
               lower(c_mktsegment), translate(CAST(c_custkey AS STRING), '0123456789', 'aeioulnrst') || 's',
               CAST(c_nationkey AS STRING), 'Shop ' || CAST(c_nationkey AS STRING), DATE '2005-01-01', '5000011'
        FROM {customer} WHERE c_nationkey < 12""",
}
