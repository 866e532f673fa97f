"""Ordered jobs over a table store.

Each job reads current versions, computes the new ones and publishes them together;
a later step sees the earlier step's result as a DataFrame, not through storage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lifeloom.functions.times import Moment
from lifeloom.operators import carts, catalog, hygiene, loyalty, orders, winback
from lifeloom.sources.registry import REGISTRY
from lifeloom.session import settle
from lifeloom.sources.tables import TableStore, upserted


def nightly_hygiene(store: TableStore, as_of: Moment) -> None:
    """Suppress, refresh engagement, apply retention, cascade orphans, archive orders."""
    subscribers = hygiene.apply_suppression(store.read("subscribers"), store.read("suppression"), as_of)
    subscribers = hygiene.refresh_engagement(
        subscribers, store.read("opens"), store.read("clicks"), store.read("sms_log"), as_of
    )
    tables = {"subscribers": subscribers}
    for name in ("preferences", "addresses", "loyalty", "carts", "cart_lines", "orders", "order_lines"):
        if store.exists(name):
            tables[name] = store.read(name)
    swept = hygiene.retention_sweep(tables, REGISTRY, as_of)
    # What is archived waits for its export: earlier rows stay until that has cleared them.
    if "orders_archive" in swept and store.exists("orders_archive"):
        swept["orders_archive"] = upserted(store.read("orders_archive"), swept["orders_archive"], ["OrderId"])
    store.publish(swept)


def cart_sweep(store: TableStore, as_of: Moment) -> None:
    store.replace("carts", carts.detect_abandoned(store.read("carts"), store.read("subscribers"), as_of))


def loyalty_night(store: TableStore, as_of: Moment) -> None:
    """Recalculate members, then enrol new buyers."""
    members, bought = store.read("loyalty"), store.read("orders")
    updated = loyalty.recalculate_tiers(members, bought, as_of)
    store.replace("loyalty", updated.unionByName(loyalty.enroll(members, bought, as_of), allowMissingColumns=True))


def birthday_day(store: TableStore, as_of: Moment, zone: str = "UTC") -> None:
    """Today's entries and their log rows; a second run the same day adds nothing."""
    log = store.read("birthday_log")
    entries = loyalty.birthday_entries(store.read("subscribers"), store.read("loyalty"), log, as_of, zone)
    current = store.replace("birthday_entry", entries)
    store.append("birthday_log", loyalty.birthday_log_rows(current, as_of), ["SubscriberKey", "BirthdayYear"])


def winback_week(store: TableStore, as_of: Moment) -> None:
    """This run's entries replace the entry table and are logged."""
    entries = winback.inactive_entries(
        store.read("subscribers"), store.read("sent"), store.read("opens"), store.read("clicks"), store.read("winback_log"), as_of
    )
    current = store.replace("winback_entry", entries)
    store.append("winback_log", winback.winback_log_rows(current, as_of), ["SubscriberKey", "InactivityTier"])


def catalog_night(store: TableStore, as_of: Moment) -> None:
    """Reject, promote, guard, and only then publish."""
    staged = store.read("staging_products")
    store.append("error_log", catalog.rejected(staged, as_of).withColumn("Resolved", F.lit(False)), ["ErrorLogId"])
    # Settled once: what is checked is what is published.
    new = settle(catalog.promoted(store.read("products"), staged, as_of))
    history = store.read("row_count_history")
    check = catalog.row_count_check(new, history)
    try:
        recorded = catalog.guard(new, history, as_of)
    except catalog.AnomalyError:
        store.append("error_log", catalog.guard_log(check, as_of), ["ErrorLogId"])
        raise
    store.publish({"products": new, "row_count_history": upserted(history, recorded, ["MetricName"])})


def order_fallback_hour(store: TableStore, as_of: Moment) -> None:
    """Queue overdue orders, keeping what was processed before."""
    queue = orders.overdue_events(store.read("orders"), as_of).withColumn("Processed", F.lit(False))
    store.append("fallback_queue", queue, ["OrderId", "FallbackEventType"])
