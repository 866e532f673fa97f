"""Queries for scans, sources and sinks.

Sink queries write below the session's shared folder and return what a reader sees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lifeloom.operators import crm
from lifeloom.session import scratch
from lifeloom.sources import files, tables
from lifeloom.sources.registry import table
from lifeloom.sources.tables import TableStore
from lifeloom.workload.base import Tables, query
from lifeloom.workload.views import ORDERS_NOW


def store(t: Tables) -> TableStore:
    return TableStore(t.spark, scratch(t.spark, "tables"))


@query(
    "src_table_registry",
    "SELECT SubscriberKey, OrderId, OrderDate, OrderStatus, CAST(OrderTotal AS DOUBLE) AS OrderTotal, 'USD' AS Currency "
    "FROM {shop_orders}",
)
def _(t):
    # Untyped text in, declared types and defaults out.
    raw = t.shop_orders.select(
        *[F.col(c).cast("string").alias(c) for c in ("OrderId", "SubscriberKey", "OrderDate", "OrderStatus", "OrderTotal")]
    )
    typed = files.typed(raw, table("orders"))
    return typed.select("SubscriberKey", "OrderId", "OrderDate", "OrderStatus", "OrderTotal", "Currency")


STAGED = "SKU, ProductName, Category, Brand, CAST(Price AS DOUBLE) AS Price, InStock, InventoryCount"


@query("src_csv_snapshot_import", f"SELECT {STAGED} FROM {{staging_products}}")
def _(t):
    path = scratch(t.spark, "feed")
    t.staging_products.write.option("header", True).csv(path)
    read = files.read_csv(t.spark, path, "staging_products", t.staging_products.columns)
    s = store(t)
    s.replace("staging_products", read)
    return s.read("staging_products").select("SKU", "ProductName", "Category", "Brand", "Price", "InStock", "InventoryCount")


@query("src_code_import", "SELECT DiscountCode, CampaignType, CAST(DiscountPercent AS BIGINT) AS DiscountPercent FROM {code_pool}")
def _(t):
    path = scratch(t.spark, "codes")
    t.code_pool.select("DiscountCode", "CampaignType", "DiscountPercent").write.option("header", True).csv(path)
    names = ["DiscountCode", "CampaignType", "DiscountPercent"]
    return files.read_csv(t.spark, path, "staging_codes", names)


@query(
    "src_csv_seed_upsert",
    """SELECT p.SKU, CASE WHEN s.SKU IS NULL THEN p.ProductName ELSE s.ProductName END AS ProductName,
              CAST(CASE WHEN s.SKU IS NULL THEN p.Price ELSE s.Price END AS DOUBLE) AS Price, p.LastSyncedDate
       FROM {products} p LEFT JOIN (SELECT * FROM {staging_products} WHERE SKU IS NOT NULL) s ON p.SKU = s.SKU
       UNION ALL
       SELECT s.SKU, s.ProductName, CAST(s.Price AS DOUBLE), NULL FROM {staging_products} s
       LEFT JOIN {products} p ON p.SKU = s.SKU WHERE s.SKU IS NOT NULL AND p.SKU IS NULL""",
)
def _(t):
    path = scratch(t.spark, "seed")
    t.staging_products.filter("SKU IS NOT NULL").select("SKU", "ProductName", "Price").write.option("header", True).csv(path)
    seed = t.spark.read.schema("SKU STRING, ProductName STRING, Price DECIMAL(18,2)").option("header", True).csv(path)
    merged = tables.upserted(t.products.select("SKU", "ProductName", "Price", "LastSyncedDate"), seed, ["SKU"])
    return merged.withColumn("LastSyncedDate", F.col("LastSyncedDate").cast("timestamp_ntz"))


@query(
    "src_event_json",
    """SELECT SubscriberKey AS ContactKey, 'APIEvent-OrderPlaced' AS EventDefinitionKey, OrderId, OrderDate
       FROM {event_orders}""",
)
def _(t):
    data = F.struct("SubscriberKey", "OrderId", "OrderDate", F.lit("x").alias("UnknownField"))
    text = t.event_orders.select(
        F.to_json(
            F.struct(
                F.col("SubscriberKey").alias("ContactKey"), F.lit("APIEvent-OrderPlaced").alias("EventDefinitionKey"), data.alias("Data")
            ),
            {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
        ).alias("value")
    )
    return files.parse_events(text).select("ContactKey", "EventDefinitionKey", "Data.OrderId", "Data.OrderDate")


@query(
    "src_rowset_explode",
    "SELECT CartId, SubscriberKey, CartStatus, CAST(CartTotal AS DOUBLE) AS CartTotal, ItemCount FROM {carts}",
)
def _(t):
    entry = F.struct(
        F.struct("CartId").alias("keys"), F.struct("SubscriberKey", "CartStatus", "CartTotal", "ItemCount").alias("values")
    )
    # Calls with many entries, and one call with none.
    calls = t.carts.groupBy(F.pmod(F.xxhash64("CartId"), F.lit(40)).alias("call")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    calls = calls.select("value").unionByName(t.spark.range(1).select(F.lit("[]").alias("value")))
    flat = files.explode_rowset(calls)
    return flat.select("CartId", "SubscriberKey", "CartStatus", "CartTotal", "ItemCount")


@query(
    "src_cart_skus_json",
    """SELECT CartId, SKU, Quantity FROM {cart_lines} UNION ALL SELECT 'empty-' || CartId, NULL, NULL FROM {carts} WHERE CartStatus = 'Converted'
       UNION ALL SELECT 'unset-' || CartId, NULL, NULL FROM {carts} WHERE CartStatus = 'Converted'""",
)
def _(t):
    # Carts with one line and with several, with an empty list, and without a list.
    item = F.struct(F.col("SKU").alias("sku"), F.col("Quantity").alias("qty"))
    carts = t.cart_lines.groupBy("CartId").agg(F.to_json(F.collect_list(item)).alias("SKUsJSON"))
    for name, text in (("empty-", F.lit("[]")), ("unset-", F.lit(None).cast("string"))):
        bare = t.carts.filter("CartStatus = 'Converted'").select(F.concat(F.lit(name), "CartId").alias("CartId"), text.alias("SKUsJSON"))
        carts = carts.unionByName(bare)
    return files.explode_cart_skus(carts).select("CartId", "SKU", "Quantity")


@query(
    "src_crm_mirror",
    """SELECT Id, arg_max(ContactId, (SystemModstamp, ChangeId)) AS ContactId, max(SystemModstamp) AS SystemModstamp,
              arg_max(Status, (SystemModstamp, ChangeId)) AS Status
       FROM {case_history} GROUP BY Id""",
)
def _(t):
    changes = t.case_history.select("Id", "ContactId", "ChangeId", "SystemModstamp", "Status")
    early = changes.filter(F.col("SystemModstamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    late = changes.filter(F.col("SystemModstamp") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    mirror = tables.latest_rows(early, ["Id"], "SystemModstamp")
    return crm.refresh_mirror(mirror, late).select("Id", "ContactId", "SystemModstamp", "Status")


@query(
    "src_dmarc_xml",
    """SELECT CASE WHEN user_id % 3 = 0 THEN '136.147.0.' WHEN user_id % 3 = 1 THEN '168.245.0.' ELSE '10.9.0.' END
                  || CAST(user_id % 250 AS STRING) AS SourceIp,
              event_id % 100 AS MessageCount, CASE WHEN value < 20 THEN 'pass' ELSE 'fail' END AS Dkim,
              CASE WHEN value < 30 THEN 'pass' ELSE 'fail' END AS Spf,
              CASE WHEN value > 60 THEN 'reject' WHEN value > 40 THEN 'quarantine' ELSE 'none' END AS Disposition
       FROM {events}""",
)
def _(t):
    return dmarc_records(t)


def dmarc_records(t: Tables):
    """One report record per event, written as XML report files and read back."""
    fields = t.sql(
        """SELECT CASE WHEN user_id % 3 = 0 THEN '136.147.0.' WHEN user_id % 3 = 1 THEN '168.245.0.' ELSE '10.9.0.' END
                      || CAST(user_id % 250 AS STRING) AS ip, event_id % 100 AS n,
                  CASE WHEN value < 20 THEN 'pass' ELSE 'fail' END AS dkim, CASE WHEN value < 30 THEN 'pass' ELSE 'fail' END AS spf,
                  CASE WHEN value > 60 THEN 'reject' WHEN value > 40 THEN 'quarantine' ELSE 'none' END AS disposition
           FROM {events}"""
    )
    policy = F.struct("disposition", "dkim", "spf").alias("policy_evaluated")
    records = fields.select(F.struct(F.col("ip").alias("source_ip"), F.col("n").alias("count"), policy).alias("row"))
    path = scratch(t.spark, "dmarc")
    records.write.format("xml").option("rootTag", "feedback").option("rowTag", "record").save(path)
    return files.read_dmarc(t.spark, path)


@query(
    "src_filtered_read",
    """SELECT OrderId, SubscriberKey, CAST(OrderTotal AS DOUBLE) AS OrderTotal FROM {shop_orders}
       WHERE OrderStatus IN ('Shipped', 'Delivered') AND Currency = 'USD'""",
)
def _(t):
    return files.filtered_read(
        t.shop_orders, ["OrderId", "SubscriberKey", "OrderTotal"], {"OrderStatus": ["Shipped", "Delivered"], "Currency": "USD"}
    )


# -- sinks -----------------------------------------------------------------------------
@query(
    "sink_truncate_load",
    f"SELECT OrderId, OrderDate FROM {{shop_orders}} WHERE OrderDate < TIMESTAMP '{ORDERS_NOW}' - INTERVAL 1095 DAY",
)
def _(t):
    from lifeloom.operators.hygiene import archive_orders

    s = store(t)
    s.replace("orders_archive", t.shop_orders.select("OrderId", "OrderDate").filter("false"))
    return s.replace("orders_archive", archive_orders(t.shop_orders, ORDERS_NOW).select("OrderId", "OrderDate"))


@query("sink_select_into", "SELECT OrderId, SubscriberKey FROM {shop_orders} WHERE OrderStatus = 'Returned'")
def _(t):
    return store(t).replace(
        "returns", t.shop_orders.filter("OrderStatus = 'Returned'").select("OrderId", "SubscriberKey")
    )


@query("sink_append", "SELECT ConsentLogId, SubscriberKey, ConsentAction FROM {consent_log}")
def _(t):
    rows = t.consent_log.select("ConsentLogId", "SubscriberKey", "ConsentAction")
    s = store(t)
    s.append("consent_log", rows.filter("ConsentAction = 'OptIn'"), ["ConsentLogId"])
    s.append("consent_log", rows, ["ConsentLogId"])  # overlaps the first run
    return s.append("consent_log", rows, ["ConsentLogId"])  # a re-run adds nothing


@query(
    "sink_upsert",
    """SELECT CartId, arg_max(CartStatus, (StatusDate, CartStatus)) AS CartStatus, max(StatusDate) AS StatusDate
       FROM {cart_history} GROUP BY CartId""",
)
def _(t):
    first = t.cart_history.filter("CartStatus = 'Active'")
    s = store(t)
    s.upsert("carts", first, ["CartId"], latest="StatusDate")
    return s.upsert("carts", t.cart_history, ["CartId"], latest="StatusDate").select("CartId", "CartStatus", "StatusDate")


@query(
    "sink_update_from",
    """SELECT s.SubscriberKey, CASE WHEN l.SubscriberKey IS NOT NULL AND s.SubscriberStatus = 'Active'
                                    THEN 'Unsubscribed' ELSE s.SubscriberStatus END AS SubscriberStatus
       FROM {subscribers} s LEFT JOIN {leaves} l ON s.SubscriberKey = l.SubscriberKey""",
)
def _(t):
    out = tables.updated_from(
        t.subscribers,
        t.leaves.select("SubscriberKey"),
        ["SubscriberKey"],
        F.col("SubscriberStatus") == "Active",
        {"SubscriberStatus": F.lit("Unsubscribed")},
    )
    return out.select("SubscriberKey", "SubscriberStatus")


@query("sink_delete_where", "SELECT OrderId FROM {shop_orders} WHERE ShippingCarrier IS NULL OR ShippingCarrier <> 'Carrier 1'")
def _(t):
    return tables.deleted_where(t.shop_orders, F.col("ShippingCarrier") == "Carrier 1").select("OrderId")


@query(
    "sink_delete_anti",
    "SELECT SubscriberKey, CurrentTier FROM {loyalty} WHERE SubscriberKey IN (SELECT SubscriberKey FROM {preferences})",
)
def _(t):
    return tables.with_parent(t.loyalty, t.preferences, "SubscriberKey").select("SubscriberKey", "CurrentTier")


@query(
    "sink_dated_csv_export",
    f"""SELECT OrderId, SubscriberKey, CAST(OrderTotal AS DOUBLE) AS OrderTotal, 0 AS LeftBehind FROM {{shop_orders}}
        WHERE OrderDate < TIMESTAMP '{ORDERS_NOW}' - INTERVAL 1095 DAY""",
)
def _(t):
    from lifeloom.operators.hygiene import archive_orders

    s = store(t)
    s.replace("orders_archive", archive_orders(t.shop_orders, ORDERS_NOW))
    path = tables.export_and_clear(s, "orders_archive", scratch(t.spark, "export"), ORDERS_NOW)
    back = files.read_csv(t.spark, path, "orders_archive")
    left = s.read("orders_archive").agg(F.count(F.lit(1)).alias("LeftBehind"))
    return back.select("OrderId", "SubscriberKey", "OrderTotal").crossJoin(F.broadcast(left))
