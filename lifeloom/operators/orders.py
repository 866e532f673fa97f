"""Order-status fallback, event outbox and the anonymised order extract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.functions.columns import joined
from lifeloom.functions.times import Moment, as_ts, shift, stamp
from lifeloom.sources.tables import updated_from

# Status that is overdue, days after which it is, and the event it stands for.
FALLBACKS = [("Confirmed", 1, "APIEvent-OrderShipped"), ("Shipped", -1, "APIEvent-OrderDelivered")]


def overdue_events(orders: DataFrame, as_of: Moment) -> DataFrame:
    """One row per order whose carrier event is overdue.  A single pass: an order has one status."""
    event = None
    for status, days, name in FALLBACKS:
        due = (F.col("OrderStatus") == status) & (F.col("EstimatedDeliveryDate") <= shift(as_of, days, "day"))
        event = F.when(due, name) if event is None else event.when(due, name)
    return (
        orders.filter(F.col("OrderStatus").isin(*[f[0] for f in FALLBACKS]))
        .select("OrderId", "SubscriberKey", event.alias("FallbackEventType"))
        .filter(F.col("FallbackEventType").isNotNull())
    )


def outbox(queue: DataFrame) -> DataFrame:
    """Event payload text of every unprocessed queue row."""
    data = F.struct("SubscriberKey", "OrderId", F.lit("TimeoutFallback").alias("Source"))
    payload = F.struct(
        F.col("SubscriberKey").alias("ContactKey"), F.col("FallbackEventType").alias("EventDefinitionKey"), data.alias("Data")
    )
    return queue.filter(~F.coalesce("Processed", F.lit(False))).select(
        "OrderId", "FallbackEventType", F.to_json(payload).alias("Payload")
    )


def mark_processed(queue: DataFrame, delivered: DataFrame, as_of: Moment) -> DataFrame:
    """Queue after delivery: accepted rows (StatusCode 200/202) are processed, others stay."""
    accepted = delivered.filter(F.col("StatusCode").isin(200, 202)).select("OrderId", "FallbackEventType")
    return updated_from(
        queue,
        accepted.dropDuplicates(),
        ["OrderId", "FallbackEventType"],
        F.lit(True),
        {"Processed": F.lit(True), "ProcessedDate": as_ts(as_of)},
    )


def delivery_errors(delivered: DataFrame, as_of: Moment) -> DataFrame:
    """Error-log rows for rejected deliveries."""
    failed = delivered.filter(~F.col("StatusCode").isin(200, 202))
    return failed.select(
        joined("FALLBACK-", F.col("OrderId"), "-", F.col("FallbackEventType"), "-", stamp(as_of)).alias("ErrorLogId"),
        F.lit("Order-Status-Timeout-Fallback").alias("AutomationName"),
        F.lit("Fire-Fallback-Events").alias("ActivityName"),
        joined(
            "HTTP ", F.col("StatusCode"), " for OrderId=", F.col("OrderId"), " EventType=", F.col("FallbackEventType")
        ).alias("ErrorMessage"),
        F.lit("Error").alias("Severity"),
        as_ts(as_of).alias("OccurredDate"),
        F.lit(False).alias("Resolved"),
    )


def anonymized(orders: DataFrame, addresses: DataFrame, config: DataFrame, as_of: Moment, days: int = 1) -> DataFrame:
    """Recent orders with a salted one-way customer hash and the default shipping region."""
    salt = config.filter(F.col("Name") == "AnonymizationSalt").agg(F.max("Value").alias("_salt"))
    shipping = addresses.filter((F.col("AddressType") == "Shipping") & F.col("IsDefault")).select(
        "SubscriberKey", "StateProvince", "CountryCode"
    )
    return (
        orders.filter(F.col("OrderDate") >= shift(as_of, -days, "day"))
        .join(shipping, "SubscriberKey", "left")
        .crossJoin(F.broadcast(salt))
        .select(
            F.sha2(joined(F.col("SubscriberKey"), F.col("_salt")), 256).alias("HashedCustomerId"),
            "OrderId",
            "OrderDate",
            "OrderStatus",
            "OrderTotal",
            "Currency",
            "StateProvince",
            "CountryCode",
        )
    )


def shipping_details(recipients: DataFrame, orders: DataFrame) -> DataFrame:
    """Carrier, tracking number and delivery date for each (SubscriberKey, OrderId); empty text when unknown."""
    facts = orders.select("OrderId", "ShippingCarrier", "TrackingNumber", "EstimatedDeliveryDate")
    return recipients.join(facts, "OrderId", "left").select(
        "SubscriberKey",
        "OrderId",
        F.coalesce("ShippingCarrier", F.lit("")).alias("ShippingCarrier"),
        F.coalesce("TrackingNumber", F.lit("")).alias("TrackingNumber"),
        "EstimatedDeliveryDate",
    )
