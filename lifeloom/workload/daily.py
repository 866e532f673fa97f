"""What runs leave behind from day to day: reach as daily bitmaps, used codes, answered events, collapsed logs, guarded nights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.times import as_ts, shift
from lifeloom.operators import carts, catalog, daily, orders, winback
from lifeloom.plans import jobs
from lifeloom.session import scratch
from lifeloom.sources.tables import TableStore
from lifeloom.workload.base import ORACLES, Tables, query
from lifeloom.workload.jobs import ALLOC_SQL, FALLBACK_NOW, FALLBACK_SQL, PROMOTE_SQL, REQUESTS, allocations, pool, views
from lifeloom.workload.views import BU, EVENTS_NOW

#: Spans of days that are folded one after the other, as nights would.
NIGHTS = [("2023-12-01", "2024-01-15"), ("2024-01-16", "2024-01-29"), ("2024-01-30", "2024-01-30"), ("2024-01-31", "2024-02-28")]


def folded(t: Tables) -> daily.DailyReach:
    reach = daily.DailyReach(t.spark, scratch(t.spark, "daily"))
    for first, last in NIGHTS:
        reach.fold(daily.event_kinds(*views(t)), first, last)
    return reach


def same_as(key: str, other: str):
    """Register a query whose rows are those of another one."""

    def register(fn):
        ORACLES[key] = ORACLES[other]
        return query(key)(fn)

    return register


def days_ago(n: int):
    return F.to_date(shift(EVENTS_NOW, -n, "day"))


@same_as("rpt_campaign_performance_daily", "rpt_campaign_performance")
def _(t):
    return daily.campaign_performance(folded(t).reach(days_ago(30)))


@same_as("rpt_click_rate_by_journey_daily", "rpt_click_rate_by_journey")
def _(t):
    return daily.click_rate_by_journey(folded(t).reach(days_ago(30)))


@same_as("rpt_deliverability_daily", "rpt_deliverability")
def _(t):
    return daily.deliverability(folded(t).reach(days_ago(20)), BU)


@same_as("rpt_program_kpis_daily", "rpt_program_kpis")
def _(t):
    reach = folded(t)
    now = F.to_date(as_ts(EVENTS_NOW))
    return daily.program_kpis(reach.reach(days_ago(15), now), reach.reach(days_ago(30), days_ago(15)))


# -- what jobs leave behind ------------------------------------------------------------------
NOW = f"TIMESTAMP '{EVENTS_NOW}'"


@query(
    "job_codes_marked",
    f"""WITH given AS (SELECT a.DiscountCode, a.CampaignType, q.SubscriberKey FROM ({ALLOC_SQL}) a JOIN ({REQUESTS}) q ON q.RequestId = a.RequestId WHERE a.Allocated)
        SELECT p.DiscountCode, p.IsUsed OR g.DiscountCode IS NOT NULL AS IsUsed, CASE WHEN NOT p.IsUsed THEN g.SubscriberKey END AS AllocatedTo,
               CASE WHEN NOT p.IsUsed AND g.DiscountCode IS NOT NULL THEN {NOW} + INTERVAL 1 DAY * CASE WHEN g.CampaignType = 'AbandonedCart15' THEN 1 ELSE 7 END
                    ELSE CAST(p.ExpirationDay AS TIMESTAMP) END AS ExpirationDate
        FROM {{code_pool}} p LEFT JOIN given g ON g.DiscountCode = p.DiscountCode""",
)
def _(t):
    stock = pool(t).withColumns({"AllocatedToSubscriberKey": F.lit(None).cast("string"), "AllocatedDate": F.lit(None).cast("timestamp_ntz")})
    marked = carts.mark_allocated(stock, allocations(t), EVENTS_NOW)
    return marked.select("DiscountCode", "IsUsed", F.col("AllocatedToSubscriberKey").alias("AllocatedTo"), "ExpirationDate")


@query(
    "job_code_pool_short",
    """WITH free AS (SELECT CampaignType, count(*) FILTER (NOT IsUsed) AS FreeCodes FROM {code_pool} GROUP BY 1)
       SELECT * FROM free WHERE FreeCodes <= (SELECT max(FreeCodes) FROM free)""",
)
def _(t):
    # The buffer is one code more than the best stocked campaign has: every campaign is short, each with its own count.
    best = t.code_pool.filter("NOT IsUsed").groupBy("CampaignType").count().agg(F.max("count")).first()[0] or 0
    return carts.short_pools(pool(t), best + 1)


#: Answers of the event endpoint, by order id.
ANSWERS = f"SELECT OrderId, FallbackEventType, CASE CAST(OrderId AS BIGINT) % 5 WHEN 0 THEN 200 WHEN 1 THEN 202 WHEN 2 THEN 429 WHEN 3 THEN 500 END AS StatusCode FROM ({FALLBACK_SQL}) f"


@query(
    "job_fallback_outcome",
    f"""SELECT 'queue' AS TableName, f.OrderId AS RowKey, FallbackEventType || '|' || CASE WHEN StatusCode IN (200, 202) THEN 'processed' ELSE 'open' END AS RowValue FROM ({ANSWERS}) f
        UNION ALL SELECT 'error_log', 'FALLBACK-' || OrderId || '-' || FallbackEventType || '-20240131000000',
               'Error|HTTP ' || CAST(StatusCode AS STRING) || ' for OrderId=' || OrderId || ' EventType=' || FallbackEventType FROM ({ANSWERS}) f WHERE StatusCode > 299""",
)
def _(t):
    queue = orders.overdue_events(t.shop_orders, FALLBACK_NOW).withColumns({"Processed": F.lit(False), "ProcessedDate": F.lit(None).cast("timestamp_ntz")})
    answers = t.sql(ANSWERS)
    done = orders.mark_processed(queue, answers, EVENTS_NOW)
    shown = F.concat("FallbackEventType", F.lit("|"), F.when(F.col("Processed"), "processed").otherwise("open"))
    rows = done.select(F.lit("queue").alias("TableName"), F.col("OrderId").alias("RowKey"), shown.alias("RowValue"))
    log = orders.delivery_errors(answers, EVENTS_NOW)
    return rows.unionByName(log.select(F.lit("error_log").alias("TableName"), F.col("ErrorLogId").alias("RowKey"), F.concat("Severity", F.lit("|"), "ErrorMessage").alias("RowValue")))


@query(
    "job_winback_log_collapse",
    """SELECT SubscriberKey, InactivityTier, EnteredDate FROM {winback_log} WHERE CAST(SubscriberKey AS BIGINT) % 2 = 1
       UNION ALL SELECT SubscriberKey, 'Tier1_90Day', EnteredDate - INTERVAL 90 DAY FROM {winback_log} WHERE CAST(SubscriberKey AS BIGINT) % 2 = 1
       UNION ALL SELECT SubscriberKey, 'Sunset', min(EnteredDate) - INTERVAL 90 DAY FROM {winback_log} WHERE CAST(SubscriberKey AS BIGINT) % 2 = 0 GROUP BY 1""",
)
def _(t):
    # Every contact has an earlier tier in its log; every second one has finished the series.
    early = t.winback_log.select("SubscriberKey", F.lit("Tier1_90Day").alias("InactivityTier"), (F.col("EnteredDate") - F.expr("INTERVAL '90' DAY")).alias("EnteredDate"))
    done = t.winback_log.filter(F.col("SubscriberKey").cast("bigint") % 2 == 0)
    return winback.log_sunset(t.winback_log.unionByName(early), done)


@query(
    "job_catalog_two_nights",
    f"""WITH night1 AS (SELECT SKU, InStock FROM ({PROMOTE_SQL}) n), n AS (SELECT count(*) FILTER (InStock) AS c, count(*) AS a FROM night1)
        SELECT 'night 1' AS Night, 'products' AS TableName, CAST(a AS STRING) || ' rows, ' || CAST(c AS STRING) || ' in stock' AS Detail FROM n
        UNION ALL SELECT 'night 1', 'row_count_history', CAST(c AS STRING) FROM n
        UNION ALL SELECT 'night 2', 'products', CAST(a AS STRING) || ' rows, ' || CAST(c AS STRING) || ' in stock' FROM n
        UNION ALL SELECT 'night 2', 'row_count_history', CAST(c AS STRING) FROM n
        UNION ALL SELECT 'night 2', 'error_log', 'Critical|100.0% fewer products in stock: 0 after ' || CAST(c AS STRING) || '; nothing was published' FROM n""",
)
def _(t):
    # The second night's feed is one product that is out of stock: the guard stops it, and the first night's tables stay.
    store = TableStore(t.spark, scratch(t.spark, "catalog"))
    store.replace("products", t.products)
    store.replace("staging_products", t.staging_products)
    store.replace("row_count_history", t.spark.createDataFrame([], "MetricName STRING, MetricValue STRING, RecordedDate TIMESTAMP_NTZ"))
    nights = []
    for night, as_of in (("night 1", "2001-08-02 00:00:00"), ("night 2", "2001-08-03 00:00:00")):
        try:
            jobs.catalog_night(store, as_of)
        except catalog.AnomalyError:
            log = store.read("error_log").filter("Severity = 'Critical'")
            nights.append(log.select(F.lit(night).alias("Night"), F.lit("error_log").alias("TableName"), F.concat("Severity", F.lit("|"), "ErrorMessage").alias("Detail")))
        products = store.read("products").agg(F.count(F.lit(1)).cast("string").alias("a"), F.count_if("InStock").cast("string").alias("c"))
        nights.append(products.select(F.lit(night).alias("Night"), F.lit("products").alias("TableName"), F.concat("a", F.lit(" rows, "), "c", F.lit(" in stock")).alias("Detail")))
        nights.append(store.read("row_count_history").select(F.lit(night).alias("Night"), F.lit("row_count_history").alias("TableName"), F.col("MetricValue").alias("Detail")))
        gone = t.staging_products.filter("SKU IS NOT NULL").orderBy("SKU").limit(1).withColumns({"InStock": F.lit(False), "InventoryCount": F.lit(0).cast("bigint"), "Price": F.coalesce("Price", F.lit(1)).cast("decimal(18,2)")})
        store.replace("staging_products", gone.select(*t.staging_products.columns))
    return reduce(DataFrame.unionByName, nights)
