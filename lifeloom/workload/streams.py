"""Queries that run a stream to completion over the driver's events and read its sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from lifeloom.session import scratch, settle
from lifeloom.sources import registry
from lifeloom.sources.tables import TableStore
from lifeloom.streaming import events as streams
from lifeloom.workload.base import Tables, query
from lifeloom.workload.jobs import CART_SQL
from lifeloom.workload.people import RAW_EVENTS, REASON, raw_events
from lifeloom.workload.primitives import CHANGE_SQL
from lifeloom.workload.views import CARTS_NOW


def event_stream(t: Tables) -> DataFrame:
    schema = t.events.schema
    source = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return source.withColumn("at", F.col("ts").cast("timestamp"))


def finished(t: Tables, df: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available and read what it appended."""
    folder = scratch(t.spark, label)
    streams.run_append(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.schema(df.schema).parquet(f"{folder}/out")


WATERMARK = "(SELECT max(ts) FROM {events})"


@query(
    "str_event_ingest",
    f"""SELECT DISTINCT c AS ContactKey, k AS EventDefinitionKey, 'accepted' AS Path, CASE WHEN k = 'APIEvent-Welcome-Signup' THEN substring(o, strpos(o, '-') + 1) || ' 00:00:00' ELSE o END AS Detail
        FROM ({RAW_EVENTS}) r WHERE ({REASON}) IS NULL
        UNION ALL SELECT c, k, 'quarantine', {REASON} FROM ({RAW_EVENTS}) r WHERE ({REASON}) IS NOT NULL""",
)
def _(t):
    folder = scratch(t.spark, "ingest")
    raw = raw_events(event_stream(t)).drop("event_id")
    for running in streams.run_ingest(raw, folder, f"{folder}/checkpoint"):
        running.awaitTermination()
    accepted = t.spark.read.parquet(f"{folder}/accepted").select(
        "ContactKey", "EventDefinitionKey", F.lit("accepted").alias("Path"), F.col("BusinessKey").alias("Detail")
    )
    rejected = t.spark.read.parquet(f"{folder}/quarantine").select(
        "ContactKey", "EventDefinitionKey", F.lit("quarantine").alias("Path"), F.col("Reason").alias("Detail")
    )
    return accepted.unionByName(rejected)


ACCEPTED = f"SELECT * FROM ({RAW_EVENTS}) r WHERE ({REASON}) IS NULL"
ENTRIES_SQL = """SELECT 'welcome_entry' AS TableName, u AS RowKey, arg_max(e, ReceivedAt) AS RowValue FROM a WHERE k = 'APIEvent-Welcome-Signup' GROUP BY u
        UNION ALL SELECT 'post_purchase_entry', o, u FROM a WHERE k = 'APIEvent-OrderPlaced' GROUP BY o, u
        UNION ALL SELECT 'case_entry', o, u FROM a WHERE k = 'APIEvent-CaseEscalated' GROUP BY o, u"""
#: Orders that were there before: every fifth order of the events, as Placed, and orders that no event names.
KNOWN_ORDERS = """SELECT OrderId, SubscriberKey, OrderDate, CASE WHEN OrderId LIKE '%-%' THEN 'Placed' ELSE OrderStatus END AS OrderStatus, OrderTotal FROM (
        SELECT CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS OrderId, CAST(user_id AS STRING) AS SubscriberKey,
               date_trunc('day', ts) AS OrderDate, 'Placed' AS OrderStatus, CAST(12.5 AS DECIMAL(18,2)) AS OrderTotal FROM {events} WHERE user_id % 5 = 0
        UNION SELECT OrderId, SubscriberKey, OrderDate, OrderStatus, OrderTotal FROM {shop_orders} WHERE OrderStatus = 'Returned') x"""


def order_events(where: str = "TRUE") -> str:
    """Per order what its events say: newest status, and the newest value of each field."""
    return f"""SELECT o, arg_max(CASE k WHEN 'APIEvent-OrderShipped' THEN 'Shipped' ELSE 'Delivered' END, ReceivedAt) AS status,
          arg_max('Carrier ' || CAST(CAST(u AS BIGINT) % 3 AS STRING), ReceivedAt) FILTER (k = 'APIEvent-OrderShipped') AS carrier,
          arg_max('T' || CAST(event_id AS STRING), ReceivedAt) FILTER (k = 'APIEvent-OrderShipped') AS tracking,
          max(CAST(ReceivedAt AS DATE)) FILTER (k = 'APIEvent-OrderShipped') AS shipped, max(CAST(ReceivedAt AS DATE)) FILTER (k = 'APIEvent-OrderDelivered') AS delivered
        FROM a WHERE k IN ('APIEvent-OrderShipped', 'APIEvent-OrderDelivered') AND ({where}) GROUP BY o"""


def order_rows(events: str) -> str:
    return f"""SELECT 'orders' AS TableName, coalesce(OrderId, o) AS RowKey, concat_ws('|', coalesce(status, OrderStatus), coalesce(carrier, '-'), coalesce(tracking, '-'),
          coalesce(CAST(shipped AS STRING), '-'), coalesce(CAST(delivered AS STRING), '-'), coalesce(SubscriberKey, '-'), coalesce(CAST(OrderTotal AS STRING), '-')) AS RowValue
        FROM ({KNOWN_ORDERS}) known FULL JOIN ({events}) e ON o = OrderId"""


def known_orders(t: Tables) -> DataFrame:
    """The same with all columns that the registry gives ``orders``, and no others."""
    rows = t.sql(KNOWN_ORDERS)
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in registry.schema("orders").fields])


def shown_orders(store: TableStore) -> DataFrame:
    day = lambda c: F.to_date(c).cast("string")
    shown = ["OrderStatus", "ShippingCarrier", "TrackingNumber", day("ShippedDate"), day("ActualDeliveryDate"), "SubscriberKey", F.col("OrderTotal").cast("string")]
    value = F.concat_ws("|", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("-")) for c in shown])
    return store.read("orders").select(F.lit("orders").alias("TableName"), F.col("OrderId").alias("RowKey"), value.alias("RowValue"))


def in_batches(t: Tables, parts: int, at: str, start: Callable[[DataFrame], StreamingQuery]) -> DataFrame:
    """Run the events as a stream of ``parts`` micro-batches, dealt by ``at`` (an expression giving 0, 1, …); returns the source.

    ``start`` starts the stream over what has arrived, with one checkpoint: a part is one batch, of as many files as it has tasks.
    """
    folder = scratch(t.spark, "batches")
    for part in range(parts):
        t.events.filter(f"{at} = {part}").write.mode("append").parquet(folder)
        source = t.spark.readStream.schema(t.events.schema).parquet(folder).withColumn("at", F.col("ts").cast("timestamp"))
        start(source).awaitTermination()
    return source


def accepted(source: DataFrame) -> DataFrame:
    return streams.checked_events(raw_events(source).drop("event_id")).filter("Reason IS NULL")


@query("str_event_route", f"WITH a AS ({ACCEPTED}) {ENTRIES_SQL} UNION ALL {order_rows(order_events())}")
def _(t):
    # Five batches whose times overlap, over an order table that was loaded before.
    folder = scratch(t.spark, "route")
    store = TableStore(t.spark, f"{folder}/tables")
    store.replace("orders", known_orders(t))
    route = streams.route_into(store)
    in_batches(t, 5, "pmod(event_id * 7, 5)", lambda source: streams.run_foreach(accepted(source), route, f"{folder}/checkpoint"))
    rows = shown_orders(store)
    for name, key, value in (("welcome_entry", "SubscriberKey", "EmailAddress"), ("post_purchase_entry", "OrderId", "SubscriberKey"), ("case_entry", "CaseId", "SubscriberKey")):
        rows = rows.unionByName(store.read(name).select(F.lit(name).alias("TableName"), F.col(key).alias("RowKey"), F.col(value).alias("RowValue")))
    return rows


@query(
    "str_late_replay",
    f"""WITH a AS ({ACCEPTED}), edge AS (SELECT max(ReceivedAt) - INTERVAL 1 DAY AS t FROM a WHERE event_id % 7 <> 0),
        late AS (SELECT o FROM a, edge WHERE event_id % 7 = 0 AND ReceivedAt < t AND k IN ('APIEvent-OrderShipped', 'APIEvent-OrderDelivered'))
        SELECT 'late' AS TableName, o AS RowKey, 'x' || CAST(count(*) AS STRING) AS RowValue FROM late GROUP BY o UNION ALL {order_rows(order_events())}""",
)
def _(t):
    # Four parts of the events in time order, then every seventh event: most of those are behind the watermark.
    folder = scratch(t.spark, "late")
    store = TableStore(t.spark, f"{folder}/tables")
    store.replace("orders", known_orders(t))
    bounds = t.events.filter("event_id % 7 <> 0").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    step = (bounds.hi - bounds.lo) / 4
    part = f"CASE WHEN event_id % 7 = 0 THEN 4 WHEN ts < TIMESTAMP_NTZ '{bounds.lo + step}' THEN 0 WHEN ts < TIMESTAMP_NTZ '{bounds.lo + 2 * step}' THEN 1 WHEN ts < TIMESTAMP_NTZ '{bounds.lo + 3 * step}' THEN 2 ELSE 3 END"
    late = streams.LateRows(t.spark, f"{folder}/late", "ReceivedAt")
    route = streams.route_into(store)
    checked = accepted(in_batches(t, 5, part, lambda source: streams.run_foreach(accepted(source), late.aside(route), f"{folder}/checkpoint")))
    waiting = late.waiting(checked.schema).filter(F.col("EventDefinitionKey").isin("APIEvent-OrderShipped", "APIEvent-OrderDelivered"))
    rows = settle(waiting.groupBy(F.col("Data.OrderId").alias("RowKey")).count().select(F.lit("late").alias("TableName"), "RowKey", F.concat(F.lit("x"), F.col("count").cast("string")).alias("RowValue")))
    late.replay(checked.schema, route)
    return rows.unionByName(shown_orders(store))


def cart_updates(df: DataFrame) -> DataFrame:
    user = F.col("user_id").cast("string")
    return df.select(
        F.concat_ws("-", user, F.to_date("ts").cast("string")).alias("CartId"),
        user.alias("SubscriberKey"),
        F.when(F.col("event_type") == "purchase", "Converted").otherwise("Active").alias("CartStatus"),
        F.col("ts").alias("CartLastUpdatedDate"),
        F.col("event_id"),
    )


@query(
    "str_cart_upsert",
    """SELECT CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS CartId, arg_max(CASE WHEN event_type = 'purchase' THEN 'Converted' ELSE 'Active' END, ts) AS CartStatus,
              max(ts) AS CartLastUpdatedDate FROM {events} GROUP BY 1""",
)
def _(t):
    folder = scratch(t.spark, "cartstream")
    store = TableStore(t.spark, f"{folder}/tables")
    handle = streams.upsert_carts_into(store)
    in_batches(t, 4, "pmod(event_id, 4)", lambda source: streams.run_foreach(cart_updates(source), handle, f"{folder}/checkpoint"))
    return store.read("carts").select("CartId", "CartStatus", "CartLastUpdatedDate")


def sessions(key: str, gap: str, lateness: str) -> str:
    """Sessions of a key that the final watermark has closed."""
    return f"""SELECT * FROM (SELECT k, sum(brk) OVER (PARTITION BY k ORDER BY ts, event_id) AS s, ts, event_type, value FROM (
          SELECT {key} AS k, ts, event_id, event_type, value, CASE WHEN ts > lag(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id) + INTERVAL {gap} OR lag(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id) IS NULL
               THEN 1 ELSE 0 END AS brk FROM {{events}}) b) c
        QUALIFY max(ts) OVER (PARTITION BY k, s) + INTERVAL {gap} <= date_trunc('millisecond', {WATERMARK} - INTERVAL {lateness})"""


@query(
    "str_cart_abandon",
    f"""SELECT CartId, SubscriberKey, CartLastUpdatedDate, AbandonedAt, Updates FROM (
          SELECT k AS CartId, k AS SubscriberKey, max(ts) AS CartLastUpdatedDate, max(ts) + INTERVAL 30 MINUTE AS AbandonedAt, count(*) AS Updates, arg_max(event_type, ts) AS last
          FROM ({sessions('CAST(user_id AS STRING)', '30 MINUTE', '1 HOUR')}) s GROUP BY k, s) x WHERE last <> 'purchase'""",
)
def _(t):
    user = F.col("user_id").cast("string")
    status = F.when(F.col("event_type") == "purchase", "Converted").otherwise("Active")
    updates = event_stream(t).select(user.alias("CartId"), user.alias("SubscriberKey"), status.alias("CartStatus"), F.col("at").alias("UpdatedAt"))
    return finished(t, streams.abandoned_sessions(updates), "sessions")


@query(
    "str_event_timeout",
    f"""WITH p AS (SELECT CAST(event_id AS STRING) AS PlacementId, CAST(user_id AS STRING) AS OrderId, ts AS PlacedAt FROM {{events}} WHERE event_type = 'signup'),
             s AS (SELECT CAST(user_id AS STRING) AS OrderId, ts AS ShippedAt FROM {{events}} WHERE event_type = 'purchase'),
             w AS (SELECT date_trunc('millisecond', least((SELECT max(PlacedAt) FROM p), (SELECT max(ShippedAt) FROM s)) - INTERVAL 1 DAY) AS t)
        SELECT p.PlacementId, p.OrderId, p.PlacedAt, s.ShippedAt FROM p JOIN s ON s.OrderId = p.OrderId AND s.ShippedAt BETWEEN p.PlacedAt AND p.PlacedAt + INTERVAL 1 DAY
        UNION ALL SELECT p.PlacementId, p.OrderId, p.PlacedAt, NULL FROM p, w WHERE p.PlacedAt + INTERVAL 1 DAY < w.t AND NOT EXISTS
            (SELECT 1 FROM s WHERE s.OrderId = p.OrderId AND s.ShippedAt BETWEEN p.PlacedAt AND p.PlacedAt + INTERVAL 1 DAY)""",
)
def _(t):
    user = F.col("user_id").cast("string").alias("OrderId")
    placed = event_stream(t).filter("event_type = 'signup'").select(
        F.col("event_id").cast("string").alias("PlacementId"), user, F.col("at").alias("PlacedAt")
    )
    shipped = event_stream(t).filter("event_type = 'purchase'").select(user, F.col("at").alias("ShippedAt"))
    return finished(t, streams.event_or_timeout(placed, shipped, days=1), "timeout")


@query(
    "str_reentry_guard",
    """WITH RECURSIVE e AS (SELECT CAST(user_id AS STRING) AS SubscriberKey, ts FROM {events} WHERE event_type = 'signup'),
         g AS (SELECT SubscriberKey, min(ts) AS ts FROM e GROUP BY 1
               UNION ALL SELECT n.SubscriberKey, n.ts FROM (SELECT g.SubscriberKey, min(e.ts) AS ts FROM g JOIN e ON e.SubscriberKey = g.SubscriberKey AND e.ts >= g.ts + INTERVAL 7 DAY GROUP BY 1) n)
       SELECT SubscriberKey, ts AS EntryDate FROM g WHERE ts <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM e)""",
)
def _(t):
    streams.use_rocksdb(t.spark)
    entries = event_stream(t).filter("event_type = 'signup'").select(
        F.col("user_id").cast("string").alias("SubscriberKey"), F.col("at").alias("EntryDate")
    )
    return finished(t, streams.entries_once(entries, 7), "guard")


@query(
    "str_send_dedupe",
    "SELECT DISTINCT CAST(date_trunc('hour', ts) AS STRING) AS MessageKey, CAST(user_id AS STRING) AS ContactKey FROM {events}",
)
def _(t):
    sends = event_stream(t).select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").cast("string").alias("MessageKey"),
        F.col("user_id").cast("string").alias("ContactKey"),
        F.col("at").alias("RequestedAt"),
    )
    return finished(t, streams.sends_once(sends, "1 hour"), "sends").select("MessageKey", "ContactKey")


@query(
    "str_rate_windows",
    f"""SELECT 'BU' || CAST(user_id % 3 AS STRING) AS BusinessUnitMID, date_trunc('hour', ts) AS WindowStart, count(*) AS Calls, count(*) > 5 AS OverLimit FROM {{events}}
        GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {WATERMARK} - INTERVAL 5 MINUTE""",
)
def _(t):
    calls = event_stream(t).select(
        F.concat(F.lit("BU"), (F.col("user_id") % 3).cast("string")).alias("BusinessUnitMID"), F.col("at").alias("ReceivedAt")
    )
    return finished(t, streams.rate_windows(calls, limit=5, width="1 hour"), "rates")


@query(
    "str_debounce",
    f"""SELECT k AS CartId, 'SKU-' || k AS SKU, arg_max(CAST(floor(value) AS BIGINT), ts) AS Quantity, max(ts) AS UpdatedAt, count(*) AS Changes
        FROM ({sessions('CAST(user_id AS STRING)', '2 HOUR', '10 SECOND')}) s GROUP BY k, s""",
)
def _(t):
    user = F.col("user_id").cast("string")
    updates = event_stream(t).select(
        user.alias("CartId"), F.concat(F.lit("SKU-"), user).alias("SKU"), F.floor("value").alias("Quantity"), F.col("at").alias("UpdatedAt")
    )
    return finished(t, streams.debounced(updates, quiet="2 hours"), "debounce")


@query(
    "str_case_change",
    f"SELECT Id AS CaseId, SystemModstamp AS ChangedAt FROM ({CHANGE_SQL}) c WHERE SystemModstamp <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM {{events}})",
)
def _(t):
    streams.use_rocksdb(t.spark)
    changes = event_stream(t).select(
        F.col("user_id").cast("string").alias("CaseId"),
        F.col("event_id").alias("ChangeId"),
        (F.col("event_type") == "error").alias("Escalated"),
        F.col("at").alias("ChangedAt"),
    )
    return finished(t, streams.escalation_changes(changes), "cases")


@query(
    "str_engagement_rollup",
    f"""SELECT CAST(ts AS DATE) AS EventDay, user_id % 50 AS JobID, count(CASE WHEN event_type = 'view' THEN 1 END) AS Opens, count(CASE WHEN event_type = 'click' THEN 1 END) AS Clicks
        FROM {{events}} WHERE event_type IN ('view', 'click') GROUP BY 1, 2
        HAVING CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM {{events}} WHERE event_type IN ('view', 'click')) - INTERVAL 1 HOUR""",
)
def _(t):
    kind = F.when(F.col("event_type") == "view", "open").otherwise("click")
    rows = event_stream(t).filter("event_type IN ('view', 'click')").select(
        (F.col("user_id") % 50).alias("JobID"), kind.alias("Kind"), F.col("at").alias("EventDate")
    )
    return finished(t, streams.engagement_rollup(rows), "rollup")


@query("str_microbatch_poll", CART_SQL)
def _(t):
    folder = scratch(t.spark, "poll")
    store = TableStore(t.spark, f"{folder}/tables")
    store.replace("carts", t.carts)
    store.replace("subscribers", t.subscribers)
    handle = streams.poll_abandonment(store, lambda _batch: CARTS_NOW)
    streams.run_foreach(event_stream(t).select("event_id"), handle, f"{folder}/checkpoint").awaitTermination()
    return store.read("carts").select("CartId", "CartStatus")
