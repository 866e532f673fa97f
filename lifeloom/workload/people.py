"""Queries for data quality, recommendations, submissions and identity resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from lifeloom.functions.columns import norm_phone
from lifeloom.operators import carts, forms, identity, loyalty, quality, recommend
from lifeloom.plans import journeys
from lifeloom.session import kept, scratch
from lifeloom.sources.files import parse_events
from lifeloom.sources.keyed import KeyedTable
from lifeloom.sources.registry import ColumnDef, TableDef
from lifeloom.workload.base import query
from lifeloom.workload.jobs import SCALED_TIERS, tier_case
from lifeloom.workload.views import BU, EVENTS_NOW, ORDERS_NOW

E_TS = f"TIMESTAMP '{EVENTS_NOW}'"
O_TS = f"TIMESTAMP '{ORDERS_NOW}'"


# -- data quality ------------------------------------------------------------------------
def finding(check: str, key: str, rest: str, detail: str = "NULL") -> str:
    return f"SELECT '{check}' AS CheckName, {key} AS Key, CAST({detail} AS STRING) AS Detail {rest}"


D1 = finding("Orphaned preferences", "SubscriberKey", "FROM {preferences} WHERE SubscriberKey NOT IN (SELECT SubscriberKey FROM {loyalty})")
D2 = finding("Orphaned order lines", "LineItemId", "FROM {order_lines} WHERE OrderId NOT IN (SELECT OrderId FROM {shop_orders} WHERE OrderStatus <> 'Cancelled')")
D3 = finding("Order lines with unknown SKU", "LineItemId", "FROM {order_lines} WHERE SKU NOT IN (SELECT SKU FROM {products})", "SKU")
D4 = finding(
    "Active subscriber on suppression list", "SubscriberKey",
    "FROM {subscribers} WHERE SubscriberStatus = 'Active' AND EmailOptIn AND lower(trim(EmailAddress)) IN (SELECT lower(trim(EmailAddress)) FROM {suppression})",
    "EmailAddress",
)
D5 = finding(
    "Duplicate line key", "OrderId || '|' || CAST(n AS STRING)",
    "FROM (SELECT CAST(l_orderkey AS STRING) AS OrderId, l_linenumber AS n, count(*) AS c FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1) x", "c",
)
D6 = finding(
    "Loyalty tier does not match spend bracket", "SubscriberKey",
    f"FROM {{loyalty}} WHERE CurrentTier <> CASE WHEN TrailingTwelveMonthSpend >= 5000 THEN 'Platinum' WHEN TrailingTwelveMonthSpend >= 2000 THEN 'Gold' "
    "WHEN TrailingTwelveMonthSpend >= 500 THEN 'Silver' ELSE 'Bronze' END", "CurrentTier",
)
D7 = finding("Orphaned cart lines", "CartLineItemId", "FROM {cart_lines} WHERE CartId NOT IN (SELECT CartId FROM {carts} WHERE CartStatus = 'Active')")
D8 = finding("Consent log with future timestamp", "ConsentLogId", "FROM {consent_log} WHERE Timestamp > TIMESTAMP '2024-01-20 00:00:00'")
D8_KEYS = D8.replace("CAST(NULL AS STRING) AS Detail ", "")


@query("dq_orphan_preferences", D1)
def _(t):
    return quality.orphan_preferences(t.preferences, t.loyalty)


@query("dq_orphan_order_lines", D2)
def _(t):
    return quality.orphan_order_lines(t.order_lines, t.shop_orders.filter("OrderStatus <> 'Cancelled'"))


@query("dq_unknown_sku", D3)
def _(t):
    return quality.unknown_sku(t.order_lines, t.products)


@query("dq_active_suppressed", D4)
def _(t):
    return quality.active_suppressed(t.subscribers, t.suppression)


def line_keys(t):
    return t.lineitem.select(F.col("l_orderkey").alias("OrderId"), F.col("l_linenumber").alias("LineNumber"))


@query("dq_duplicate_key", D5)
def _(t):
    return quality.duplicate_keys(line_keys(t), ["OrderId", "LineNumber"], "Duplicate line key")


@query("dq_tier_mismatch", D6)
def _(t):
    return quality.tier_mismatch(t.loyalty)


@query("dq_orphan_cart_lines", D7)
def _(t):
    return quality.orphan_cart_lines(t.cart_lines, t.carts.filter("CartStatus = 'Active'"))


@query("dq_future_consent", D8.replace("CAST(NULL AS STRING) AS Detail", "strftime(Timestamp, '%Y-%m-%d') AS Detail"))
def _(t):
    found = quality.future_consent(t.consent_log, "2024-01-20 00:00:00")
    return found.withColumn("Detail", F.substring("Detail", 1, 10))


#: Loyalty members stand in for subscribers: some are on the list, and every 97th is there twice.
MEMBERS = """SELECT l.SubscriberKey, s.EmailAddress, coalesce(s.SubscriberStatus, 'Active') AS SubscriberStatus, coalesce(s.EmailOptIn, TRUE) AS EmailOptIn
    FROM {loyalty} l LEFT JOIN {subscribers} s ON s.SubscriberKey = l.SubscriberKey JOIN (SELECT 1 AS n UNION ALL SELECT 97) x ON CAST(l.SubscriberKey AS BIGINT) % n = 0"""
M4 = f"""SELECT 'Active subscriber on suppression list' AS CheckName, SubscriberKey AS Key FROM ({MEMBERS}) m
    WHERE SubscriberStatus = 'Active' AND EmailOptIn AND lower(trim(EmailAddress)) IN (SELECT lower(trim(EmailAddress)) FROM {{suppression}})"""
M5 = f"SELECT 'Duplicate SubscriberKey' AS CheckName, SubscriberKey AS Key FROM ({MEMBERS}) m GROUP BY SubscriberKey HAVING count(*) > 1"


@query(
    "dq_all_checks",
    " UNION ALL ".join(f"SELECT CheckName, Key FROM ({d}) x{i}" for i, d in enumerate([D1, D2, D3, M4, M5, D6, D7, D8])),
)
def _(t):
    tables = {
        "subscribers": t.sql(MEMBERS),
        "preferences": t.preferences,
        "orders": t.shop_orders.filter("OrderStatus <> 'Cancelled'"),
        "order_lines": t.order_lines,
        "products": t.products,
        "suppression": t.suppression,
        "loyalty": t.loyalty,
        "carts": t.carts.filter("CartStatus = 'Active'"),
        "cart_lines": t.cart_lines,
        "consent_log": t.consent_log,
    }
    return quality.all_checks(tables, "2024-01-20 00:00:00").select("CheckName", "Key")


RAW_EVENTS = """SELECT event_id, ts AS ReceivedAt, CASE WHEN event_type = 'error' AND value < 20 THEN NULL ELSE CAST(user_id AS STRING) END AS c,
    CASE event_type WHEN 'signup' THEN 'APIEvent-Welcome-Signup' WHEN 'purchase' THEN 'APIEvent-OrderPlaced' WHEN 'click' THEN 'APIEvent-OrderShipped'
         WHEN 'view' THEN 'APIEvent-OrderDelivered' ELSE 'APIEvent-CaseEscalated' END AS k, CAST(user_id AS STRING) AS u,
    CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS o, value AS v,
    CASE WHEN value > 60 THEN 'not an address' ELSE 'u' || CAST(user_id AS STRING) || '@example.com' END AS e FROM {events}"""


def raw_events(df):
    """JSON event text from driver events (batch or streaming), one row per event."""
    kind = F.col("event_type")
    key = (
        F.when(kind == "signup", "APIEvent-Welcome-Signup")
        .when(kind == "purchase", "APIEvent-OrderPlaced")
        .when(kind == "click", "APIEvent-OrderShipped")
        .when(kind == "view", "APIEvent-OrderDelivered")
        .otherwise("APIEvent-CaseEscalated")
    )
    user = F.col("user_id").cast("string")
    day = F.to_date("ts").cast("string")
    order = F.concat_ws("-", user, day)
    contact = F.when(~((kind == "error") & (F.col("value") < 20)), user)
    email = F.when(F.col("value") > 60, "not an address").otherwise(F.concat(F.lit("u"), user, F.lit("@example.com")))
    is_order = kind.isin("purchase", "click", "view")
    data = F.struct(
        user.alias("SubscriberKey"),
        F.when(kind == "signup", email).alias("EmailAddress"),
        F.when(kind == "signup", day).alias("SignupDate"),
        F.when(is_order, order).alias("OrderId"),
        F.when(kind == "purchase", day).alias("OrderDate"),
        F.when(kind == "click", F.concat(F.lit("Carrier "), (F.col("user_id") % 3).cast("string"))).alias("ShippingCarrier"),
        F.when(kind == "click", F.concat(F.lit("T"), F.col("event_id").cast("string"))).alias("TrackingNumber"),
        F.when(kind == "click", day).alias("ShippedDate"),
        F.when(kind == "view", day).alias("ActualDeliveryDate"),
        F.when((kind == "error") & (F.col("value") < 50), order).alias("CaseId"),
        F.lit("ignored").alias("Extra"),
    )
    payload = F.struct(contact.alias("ContactKey"), key.alias("EventDefinitionKey"), data.alias("Data"))
    return df.select("event_id", F.col("ts").cast("timestamp").alias("ReceivedAt"), F.to_json(payload).alias("value"))


REASON = """CASE WHEN c IS NULL THEN 'ContactKey and EventDefinitionKey are required'
    WHEN k = 'APIEvent-CaseEscalated' AND NOT v < 50 THEN 'Missing required field in Data'
    WHEN k = 'APIEvent-Welcome-Signup' AND v > 60 THEN 'Invalid email address' END"""


@query("dq_event_validation", f"SELECT event_id, k AS EventDefinitionKey, {REASON} AS Reason FROM ({RAW_EVENTS}) r")
def _(t):
    checked = quality.validated_events(parse_events(raw_events(t.events)))
    return checked.select("event_id", "EventDefinitionKey", "Reason")


@query(
    "dq_schema_constraints",
    """SELECT 'required' AS "Constraint", 'SubscriberKey' AS "Column", count(CASE WHEN SubscriberKey IS NULL THEN 1 END) AS Violations FROM {shop_orders}
       UNION ALL SELECT 'length', 'OrderStatus', count(CASE WHEN length(OrderStatus) > 7 THEN 1 END) FROM {shop_orders}
       UNION ALL SELECT 'required', 'ShippingCarrier', count(CASE WHEN ShippingCarrier IS NULL THEN 1 END) FROM {shop_orders}
       UNION ALL SELECT 'enum', 'OrderStatus', 0
       UNION ALL SELECT 'unique', 'SubscriberKey', count(*) FROM (SELECT SubscriberKey FROM {shop_orders} GROUP BY 1 HAVING count(*) > 1) x""",
)
def _(t):
    # Stricter than the model, so that rules fire: one order per subscriber, short status, known carrier.
    strict = TableDef(
        "orders",
        (
            ColumnDef("SubscriberKey", "text", key=True, required=True),
            ColumnDef("OrderStatus", "text", length=7),
            ColumnDef("ShippingCarrier", "text", required=True),
        ),
    )
    return quality.constraint_violations(t.shop_orders, strict)


@query(
    "dq_cart_payload",
    """SELECT CartId, CASE WHEN CartStatus NOT IN ('Active', 'Abandoned', 'Expired') THEN 'Unknown CartStatus' WHEN CartTotal - 50 < 0 THEN 'CartTotal is negative'
         WHEN ItemCount - 1 < 0 THEN 'ItemCount is negative' END AS Reason FROM {carts}""",
)
def _(t):
    payload = t.carts.select(
        "CartId",
        "SubscriberKey",
        F.when(F.col("CartStatus") == "Converted", "Paid").otherwise(F.col("CartStatus")).alias("CartStatus"),
        (F.col("CartTotal") - 50).alias("CartTotal"),
        (F.col("ItemCount") - 1).alias("ItemCount"),
    )
    return quality.validated_carts(payload).select("CartId", "Reason")


PROFILE_FORMS = """SELECT CAST(c_custkey AS STRING) AS SubscriberKey, CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE c_mktsegment END AS FirstName,
    'New' AS LastName, DATE '2001-01-01' + CAST(floor(c_acctbal) - 4000 AS INT) AS DateOfBirth,
    CASE WHEN c_nationkey < 5 THEN 'call me' WHEN c_nationkey < 10 THEN '(555) 123-4567' WHEN c_nationkey < 15 THEN '' ELSE '+15551234567' END AS MobileNumber
    FROM {customer}"""
PROFILE_REASON = """CASE WHEN trim(FirstName) = '' THEN 'first name missing' WHEN DateOfBirth > DATE '2001-08-02' THEN 'birth date after the form'
    WHEN 2001 - year(DateOfBirth) > 120 THEN 'birth date over 120 years back'
    WHEN MobileNumber <> '' AND NOT regexp_matches(regexp_replace(MobileNumber, '[\\s()-]', '', 'g'), '^\\+?[0-9]{{10,15}}$') THEN 'mobile number not readable' END"""


@query("dq_profile_submission", f"SELECT SubscriberKey, {PROFILE_REASON} AS Reason FROM ({PROFILE_FORMS}) f")
def _(t):
    return quality.validated_profiles(t.sql(PROFILE_FORMS), ORDERS_NOW).select("SubscriberKey", "Reason")


# -- recommendations ---------------------------------------------------------------------
def shop_catalog(t):
    """Products under the shop's category names."""
    name = F.when(F.col("Category").isin("ECONOMY", "PROMO"), "Womens").when(F.col("Category") == "SMALL", "Mens").otherwise(F.col("Category"))
    return t.products.withColumn("Category", name)


SHOP = """SELECT SKU, AvgRating, InStock, CASE WHEN Category IN ('ECONOMY', 'PROMO') THEN 'Womens' WHEN Category = 'SMALL' THEN 'Mens' ELSE Category END AS Category FROM {products}"""
TOP = "SELECT Category, SKU, Slot FROM (SELECT *, row_number() OVER (PARTITION BY Category ORDER BY AvgRating DESC, SKU) AS Slot FROM ({shop}) p WHERE InStock) q WHERE Slot <= {k}"


@query(
    "rec_welcome_products",
    f"""SELECT s.SubscriberKey, p.Category, p.Slot, p.SKU FROM (SELECT s.SubscriberKey,
          CASE WHEN q.SubscriberKey IS NULL OR CategoryWomens THEN 'Womens' WHEN CategoryMens THEN 'Mens' ELSE 'Womens' END AS Category
          FROM {{subscribers}} s LEFT JOIN {{preferences}} q ON q.SubscriberKey = s.SubscriberKey) s JOIN ({TOP.format(shop=SHOP, k=4)}) p ON p.Category = s.Category""",
)
def _(t):
    return recommend.welcome_products(t.subscribers, t.preferences, shop_catalog(t))


@query(
    "rec_cross_sell",
    f"""WITH o AS (SELECT h.OrderId, coalesce(f.Category, 'PROMO') AS Category FROM {{shop_orders}} h
                LEFT JOIN (SELECT OrderId, arg_min(Category, LineItemId) AS Category FROM {{order_lines_cat}} GROUP BY 1) f ON f.OrderId = h.OrderId)
        SELECT OrderId, Category, row_number() OVER (PARTITION BY OrderId ORDER BY Slot) AS Slot, SKU FROM (
          SELECT o.OrderId, o.Category, p.Slot, p.SKU FROM o JOIN ({TOP.format(shop='SELECT * FROM {products}', k=8)}) p ON p.Category = o.Category
          WHERE NOT EXISTS (SELECT 1 FROM {{order_lines}} l WHERE l.OrderId = o.OrderId AND l.SKU = p.SKU)) x
        QUALIFY row_number() OVER (PARTITION BY OrderId ORDER BY x.Slot) <= 4""",
)
def _(t):
    return recommend.cross_sell(t.order_lines_cat, t.shop_orders, t.products, default="PROMO")


@query(
    "rec_cart_blocks",
    """SELECT l.CartId, l.Slot, l.SKU, l.Quantity, p.ProductName, CAST(p.Price AS DOUBLE) AS Price, CAST(p.SalePrice AS DOUBLE) AS SalePrice,
              coalesce(p.InStock, FALSE) AS InStock, coalesce(p.SalePrice > 0 AND p.SalePrice < p.Price, FALSE) AS OnSale
       FROM (SELECT *, row_number() OVER (PARTITION BY CartId ORDER BY AddedToCartDate DESC, CartLineItemId) AS Slot FROM {cart_lines}) l
       LEFT JOIN {products} p ON p.SKU = l.SKU WHERE l.Slot <= 10""",
)
def _(t):
    return carts.product_blocks(t.cart_lines, t.products)


# -- tokens and submissions --------------------------------------------------------------
@query(
    "tok_mint",
    f"""SELECT sha256(SubscriberKey || '|send-1|PreferenceCenter') AS Token, SubscriberKey, 'PreferenceCenter' AS Purpose, {E_TS} AS CreatedDate,
               {E_TS} + INTERVAL 30 DAY AS ExpirationDate, FALSE AS Used FROM {{subscribers}}""",
)
def _(t):
    return forms.mint_tokens(t.subscribers, "send-1", EVENTS_NOW)


@query(
    "tok_resolve",
    f"""SELECT CAST(event_id AS STRING) AS RequestId, SubscriberKey FROM {{events}} JOIN (
          SELECT CAST(c_custkey AS STRING) AS SubscriberKey, 'token-' || lpad(CAST(c_custkey AS STRING), 6, '0') AS Token,
                 {E_TS} + CASE WHEN c_acctbal > 5000 THEN INTERVAL 30 DAY ELSE INTERVAL (-1) DAY END AS x FROM {{customer}}) k
        ON k.Token = CASE WHEN event_type = 'error' THEN 'bad' ELSE 'token-' || lpad(CAST(user_id AS STRING), 6, '0') END WHERE x >= {E_TS}""",
)
def _(t):
    name = lambda c: F.concat(F.lit("token-"), F.lpad(F.col(c).cast("string"), 6, "0"))
    now = F.lit(EVENTS_NOW).cast("timestamp_ntz")
    tokens = t.customer.select(
        name("c_custkey").alias("Token"),
        F.col("c_custkey").cast("string").alias("SubscriberKey"),
        F.when(F.col("c_acctbal") > 5000, now + F.expr("INTERVAL 30 DAY")).otherwise(now - F.expr("INTERVAL 1 DAY")).alias("ExpirationDate"),
    )
    requests = t.events.select(
        F.col("event_id").cast("string").alias("RequestId"), F.when(F.col("event_type") == "error", "bad").otherwise(name("user_id")).alias("Token")
    )
    return forms.resolve_tokens(requests, tokens, EVENTS_NOW).select("RequestId", "SubscriberKey")


SIGNUP_FORMS = """SELECT lpad(CAST(event_id AS STRING), 12, '0') AS SubmissionId, CASE WHEN event_type = 'error' THEN 'broken address'
    WHEN event_type = 'view' THEN 'Customer#' || lpad(CAST(user_id AS STRING), 9, '0') || '@Example.com' ELSE 'New' || split_part(split_part(props, ': ', 2), chr(125), 1) || '@example.com' END AS EmailAddress,
    event_type AS FirstName FROM {events}"""


@query(
    "sub_signup_apply",
    f"""SELECT 'SUB-' || substring(sha256(m), 1, 16) AS SubscriberKey, EmailAddress, FirstName, 'SIGNUP-SUB-' || substring(sha256(m), 1, 16) AS ConsentLogId,
               'APIEvent-Welcome-Signup' AS EventDefinitionKey
        FROM (SELECT *, lower(trim(EmailAddress)) AS m, row_number() OVER (PARTITION BY lower(trim(EmailAddress)) ORDER BY SubmissionId) AS n FROM ({SIGNUP_FORMS}) f
              WHERE regexp_matches(EmailAddress, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$')) x
        WHERE n = 1 AND m NOT IN (SELECT lower(trim(EmailAddress)) FROM {{subscribers}})""",
)
def _(t):
    # One address per property value, without the characters a form would not accept.
    batch = t.sql(SIGNUP_FORMS)
    out = forms.apply_signups(t.subscribers, batch, EVENTS_NOW, BU)
    events = out["events"].select(F.col("ContactKey").alias("SubscriberKey"), "EventDefinitionKey")
    return (
        out["subscribers"].select("SubscriberKey", "EmailAddress", "FirstName")
        .join(out["consent_log"].select("SubscriberKey", "ConsentLogId"), "SubscriberKey")
        .join(events, "SubscriberKey")
    )


PREF_FORMS = """SELECT CAST(user_id AS STRING) AS SubscriberKey, ts AS SubmittedDate,
    CASE WHEN value < 10 THEN 'Reduced' WHEN value < 40 THEN 'EssentialOnly' WHEN value < 80 THEN 'Standard' ELSE 'Never' END AS FrequencyPreference,
    event_type <> 'error' AS PromotionalOptIn FROM {events}"""


@query(
    "sub_preferences_apply",
    f"""WITH l AS (SELECT SubscriberKey, max(SubmittedDate) AS d, arg_max(FrequencyPreference, SubmittedDate) AS f, arg_max(PromotionalOptIn, SubmittedDate) AS p
                   FROM ({PREF_FORMS}) x WHERE FrequencyPreference <> 'Never' GROUP BY 1)
        SELECT coalesce(l.SubscriberKey, q.SubscriberKey) AS SubscriberKey, CASE WHEN l.SubscriberKey IS NULL THEN FrequencyPreference ELSE f END AS FrequencyPreference,
               CASE WHEN l.SubscriberKey IS NULL THEN PromotionalOptIn ELSE p END AS PromotionalOptIn, CategoryWomens,
               CASE WHEN l.SubscriberKey IS NULL THEN NULL WHEN p THEN 'OptIn' ELSE 'OptOut' END AS ConsentAction
        FROM {{preferences}} q FULL OUTER JOIN l ON l.SubscriberKey = q.SubscriberKey""",
)
def _(t):
    out = forms.apply_preferences(t.preferences, t.sql(PREF_FORMS), EVENTS_NOW)
    consent = out["consent_log"].select("SubscriberKey", "ConsentAction")
    prefs = out["preferences"].select("SubscriberKey", "FrequencyPreference", "PromotionalOptIn", "CategoryWomens")
    return prefs.join(consent, "SubscriberKey", "left")


@query(
    "sub_profile_apply",
    f"""SELECT s.SubscriberKey, CASE WHEN f.SubscriberKey IS NULL THEN s.LastName ELSE f.LastName END AS LastName,
               CASE WHEN f.SubscriberKey IS NULL THEN s.DateOfBirth ELSE f.DateOfBirth END AS DateOfBirth,
               CASE WHEN f.SubscriberKey IS NULL THEN s.MobileNumber ELSE f.MobileNumber END AS MobileNumber
        FROM {{subscribers}} s LEFT JOIN (SELECT * FROM ({PROFILE_FORMS}) p WHERE {PROFILE_REASON} IS NULL) f ON f.SubscriberKey = s.SubscriberKey""",
)
def _(t):
    batch = t.sql(PROFILE_FORMS).withColumn("SubmittedDate", F.lit(ORDERS_NOW).cast("timestamp_ntz"))
    out = forms.apply_profiles(t.subscribers, batch, ORDERS_NOW)
    return out.select("SubscriberKey", "LastName", "DateOfBirth", "MobileNumber")


LEAVE_FORMS = """SELECT CAST(user_id AS STRING) AS SubscriberKey,
    CASE WHEN event_type = 'error' AND value > 60 THEN 'unsubscribe' WHEN event_type = 'click' AND value > 60 THEN 'reduce' ELSE 'unknown' END AS Action FROM {events}"""


@query(
    "sub_unsubscribe_apply",
    f"""WITH f AS ({LEAVE_FORMS}), u AS (SELECT DISTINCT SubscriberKey FROM f WHERE Action = 'unsubscribe'), r AS (SELECT DISTINCT SubscriberKey FROM f WHERE Action = 'reduce')
        SELECT 'subscribers' AS TableName, SubscriberKey AS RowKey, CASE WHEN SubscriberKey IN (SELECT SubscriberKey FROM u) THEN 'Unsubscribed' ELSE SubscriberStatus END AS RowValue FROM {{subscribers}}
        UNION ALL SELECT 'suppression', lower(trim(EmailAddress)), 'Unsubscribe' FROM {{subscribers}} WHERE SubscriberKey IN (SELECT SubscriberKey FROM u)
            AND lower(trim(EmailAddress)) NOT IN (SELECT lower(trim(EmailAddress)) FROM {{suppression}})
        UNION ALL SELECT 'consent_log', 'UNSUB-' || SubscriberKey || '-20240131000000', 'OptOut' FROM u
        UNION ALL SELECT 'preferences', coalesce(p.SubscriberKey, r.SubscriberKey), CASE WHEN r.SubscriberKey IS NULL THEN FrequencyPreference ELSE 'Reduced' END
            FROM {{preferences}} p FULL OUTER JOIN r ON r.SubscriberKey = p.SubscriberKey""",
)
def _(t):
    out = forms.apply_unsubscribes(t.subscribers, t.preferences, t.suppression, t.sql(LEAVE_FORMS), EVENTS_NOW, BU)
    shown = {
        "subscribers": ("SubscriberKey", "SubscriberStatus"),
        "suppression": ("EmailAddress", "SuppressionReason"),
        "consent_log": ("ConsentLogId", "ConsentAction"),
        "preferences": ("SubscriberKey", "FrequencyPreference"),
    }
    rows = None
    for name, (key, value) in shown.items():
        part = out[name].select(F.lit(name).alias("TableName"), F.col(key).alias("RowKey"), F.col(value).alias("RowValue"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


HEX = "CAST('0x' || substring(md5({x}), 1, 8) AS BIGINT) % 100"


@query(
    "exp_holdout_split",
    f"SELECT SubscriberKey, CASE WHEN {HEX.format(x=chr(39).join(['SubscriberKey || ', '|content-2024', '']))} < 10 THEN 'Holdout' ELSE 'Treatment' END AS Path FROM {{subscribers}}",
)
def _(t):
    return journeys.holdout(t.subscribers, "SubscriberKey", "content-2024").select("SubscriberKey", "Path")


# -- identity ----------------------------------------------------------------------------
PHONE = """CASE WHEN length(regexp_replace(MobileNumber, '[^0-9]', '', 'g')) = 0 THEN NULL WHEN length(regexp_replace(MobileNumber, '[^0-9]', '', 'g')) = 10
    THEN '+1' || regexp_replace(MobileNumber, '[^0-9]', '', 'g') ELSE '+' || regexp_replace(MobileNumber, '[^0-9]', '', 'g') END"""


@query("idr_normalize_phone", f"SELECT RecordId, {PHONE} AS Phone FROM {{id_records}}")
def _(t):
    return t.id_records.select("RecordId", norm_phone("MobileNumber").alias("Phone"))


def star(value: str, confidence: float, rule: str) -> str:
    return f"""SELECT hub AS "Left", RecordId AS "Right", CAST({confidence} AS DOUBLE) AS Confidence, '{rule}' AS Rule FROM (
        SELECT RecordId, min(RecordId) OVER (PARTITION BY {value}) AS hub FROM {{id_records}} WHERE {value} <> '') x WHERE RecordId <> hub"""


EMAIL_SQL = star("lower(trim(EmailAddress))", 1.00, "Exact-Email-Match")
PHONE_SQL = star(PHONE, 0.95, "Exact-Phone-Match")
NAMES = "SELECT lower(trim(PostalCode)) AS z, lower(trim(FirstName)) AS f, lower(trim(LastName)) AS l, RecordId FROM {id_records}"
FUZZY_SQL = f"""SELECT hub AS "Left", RecordId AS "Right", CAST(0.75 AS DOUBLE) AS Confidence, 'Fuzzy-Name-Match' AS Rule FROM (
      SELECT RecordId, min(RecordId) OVER (PARTITION BY z, f, l) AS hub FROM ({NAMES}) n) x WHERE RecordId <> hub
    UNION ALL SELECT a.i, b.i, 0.75, 'Fuzzy-Name-Match' FROM (SELECT z, f, l, min(RecordId) AS i FROM ({NAMES}) n GROUP BY 1, 2, 3) a
    JOIN (SELECT z, f, l, min(RecordId) AS i FROM ({NAMES}) n GROUP BY 1, 2, 3) b ON a.z = b.z AND a.i < b.i
    WHERE jaro_winkler_similarity(a.f, b.f) >= 0.9 AND jaro_winkler_similarity(a.l, b.l) >= 0.9"""
LINKS_SQL = f"{EMAIL_SQL} UNION ALL {PHONE_SQL} UNION ALL {FUZZY_SQL}"
COMPONENT_SQL = f"""WITH RECURSIVE e AS (SELECT DISTINCT a, b FROM (SELECT "Left" AS a, "Right" AS b FROM ({LINKS_SQL}) l UNION ALL SELECT "Right", "Left" FROM ({LINKS_SQL}) r) u),
    reach AS (SELECT RecordId AS n, RecordId AS m FROM {{id_records}} UNION SELECT reach.n, e.b FROM reach JOIN e ON e.a = reach.m)"""
UNIFIED = "SELECT n AS RecordId, min(m) AS UnifiedIndividualId FROM reach GROUP BY n"


@query("idr_exact_email", EMAIL_SQL)
def _(t):
    return identity.email_links(t.id_records)


@query("idr_exact_phone", PHONE_SQL)
def _(t):
    return identity.phone_links(t.id_records)


@query("idr_fuzzy_name", FUZZY_SQL)
def _(t):
    return identity.name_links(t.id_records)


@query(
    "join_fuzzy_blocked",
    f"""SELECT a.i AS LeftId, b.i AS RightId FROM (SELECT DISTINCT z, f, l, RecordId AS i FROM ({NAMES}) n) a
        JOIN (SELECT DISTINCT z, f, l, RecordId AS i FROM ({NAMES}) n) b ON a.z = b.z AND a.i < b.i
        WHERE jaro_winkler_similarity(a.f, b.f) >= 0.95 AND jaro_winkler_similarity(a.l, b.l) >= 0.95""",
)
def _(t):
    return identity.name_pairs(t.id_records, 0.95).select(F.col("Left").alias("LeftId"), F.col("Right").alias("RightId"))


def resolved(t):
    return identity.resolve(t.id_records)


@query("idr_components", f"{COMPONENT_SQL} {UNIFIED}")
def _(t):
    return resolved(t)[1]


@query("idr_components_incremental", f"{COMPONENT_SQL} {UNIFIED}")
def _(t):
    # Records and links arrive in three batches; a batch reads the individuals so far and its own links only.
    links = kept(identity.all_links(t.id_records), "links")
    table = KeyedTable(t.spark, scratch(t.spark, "individuals"), ["RecordId"])
    part = lambda *keys: F.pmod(F.xxhash64(*keys), F.lit(3))
    for batch in range(3):
        records = t.id_records.filter(part("RecordId") == batch).select("RecordId")
        identity.fold_links(table, f"batch-{batch}", records, links.filter(part("Left", "Right") == batch))
    return table.read()


def survivor(field: str, preferred: str = "FALSE") -> str:
    known = f"{field} IS NOT NULL AND {field} <> ''"
    return f"arg_max(CASE WHEN {known} THEN {field} END, CASE WHEN {known} THEN ({preferred}, UpdatedAt, r.RecordId) END) AS {field}"


@query(
    "idr_survivorship",
    f"""{COMPONENT_SQL} SELECT UnifiedIndividualId, {survivor('EmailAddress', "Source = 'MC_Subscribers'")}, {survivor('MobileNumber')}, {survivor('FirstName')},
          {survivor('LastName')}, {survivor('PostalCode')}, {survivor('MailingAddress', "Source = 'SF_Contacts'")}, count(*) AS RecordCount
        FROM {{id_records}} r JOIN ({UNIFIED}) u ON u.RecordId = r.RecordId GROUP BY 1""",
)
def _(t):
    return identity.survivors(t.id_records, resolved(t)[1])


@query(
    "idr_write_bridge",
    f"""{COMPONENT_SQL}, best AS (SELECT i, max(c) AS c FROM (SELECT "Left" AS i, Confidence AS c FROM ({LINKS_SQL}) l UNION ALL SELECT "Right", Confidence FROM ({LINKS_SQL}) r) x GROUP BY 1)
        SELECT UnifiedIndividualId, BusinessUnitMID, min(SourceKey) AS SubscriberKey, max(c) AS MatchConfidenceScore FROM {{id_records}} r
        JOIN ({UNIFIED}) u ON u.RecordId = r.RecordId JOIN best ON i = r.RecordId WHERE Source = 'MC_Subscribers' GROUP BY 1, 2""",
)
def _(t):
    links, individuals = resolved(t)
    rows = identity.bridge_rows(t.id_records, individuals, links, EVENTS_NOW)
    empty = t.bridge.filter("false")
    return identity.write_bridge(empty, rows).select("UnifiedIndividualId", "BusinessUnitMID", "SubscriberKey", "MatchConfidenceScore")
