"""Ordered jobs over two runs each, on tables with the registry's own columns."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lifeloom.operators import catalog
from lifeloom.plans import jobs
from lifeloom.sources import registry
from lifeloom.sources.tables import TableStore, export_and_clear

FIRST, SECOND = "2026-07-25 04:00:00", "2026-07-26 04:00:00"
EVENTS = "JobID BIGINT, SubscriberKey STRING, EventDate TIMESTAMP_NTZ, EmailName STRING"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def at(day, month=7, year=2026, hour=0):
    return datetime(year, month, day, hour)


def put(store, name, *rows):
    """Replace a table by rows of the registry's columns; what a row does not name is NULL."""
    schema = registry.schema(name)
    values = [tuple(Decimal(r[f.name]) if f.dataType.typeName() == "decimal" and r.get(f.name) is not None else r.get(f.name) for f in schema.fields) for r in rows]
    loose = schema.fromJson(schema.jsonValue())
    for field in loose.fields:
        field.nullable = True
    store.replace(name, store.spark.createDataFrame(values, loose))


def events(store, name, *rows):
    store.replace(name, store.spark.createDataFrame([(1, k, t, "x") for k, t in rows], EVENTS))


def column(store, name, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in store.read(name).collect()}


def person(key, **more):
    return {"SubscriberKey": key, "EmailAddress": f"{key}@x.com", "SubscriberStatus": "Active", "EmailOptIn": True, "LastEngagementDate": at(1, 7, 2025)} | more


def test_two_nights_of_hygiene(store, tmp_path):
    put(store, "subscribers", person("a"), person("listed"), person("gone", LastEngagementDate=at(1, 1, 2020)), person("woke", LastEngagementDate=at(1, 1, 2020)))
    put(store, "suppression", {"EmailAddress": " LISTED@x.com ", "SuppressionReason": "HardBounce", "SuppressedDate": at(1)})
    events(store, "opens", ("woke", at(20)))
    events(store, "clicks")
    store.replace("sms_log", store.spark.createDataFrame([], "MobileNumber STRING, EventDate TIMESTAMP_NTZ, EventType STRING"))
    put(store, "preferences", {"SubscriberKey": "a"}, {"SubscriberKey": "gone"})
    old, edge, new = at(1, 1, 2023), at(26, 7, 2023, 12), at(1)
    orders = [("o-old", "a", old), ("o-edge", "a", edge), ("o-new", "a", new), ("o-gone", "gone", new)]
    put(store, "orders", *[{"OrderId": o, "SubscriberKey": s, "OrderDate": t, "OrderStatus": "Delivered", "OrderTotal": "5"} for o, s, t in orders])
    put(store, "order_lines", *[{"LineItemId": f"l-{o}", "OrderId": o, "SKU": "s"} for o, *_ in orders])
    jobs.nightly_hygiene(store, FIRST)
    people = column(store, "subscribers", "SubscriberKey", "EmailOptIn", "LastEngagementDate")
    assert set(people) == {"a", "listed", "woke"} and people["listed"][0] is False and people["woke"][1] == at(20)
    assert set(column(store, "preferences", "SubscriberKey")) == {"a"}
    first = set(column(store, "orders", "OrderId"))
    assert "o-old" not in first and {"o-edge", "o-new"} <= first
    assert set(column(store, "orders_archive", "OrderId")) == {"o-old"}
    assert set(column(store, "order_lines", "LineItemId")) == {f"l-{o}" for o in first}
    # The next night one more order has aged; what waits in the archive stays until its export.
    jobs.nightly_hygiene(store, "2026-07-27 04:00:00")
    assert set(column(store, "orders_archive", "OrderId")) == {"o-old", "o-edge"}
    assert set(column(store, "orders", "OrderId")) == first - {"o-edge"}
    export_and_clear(store, "orders_archive", str(tmp_path / "out"), SECOND)
    jobs.nightly_hygiene(store, "2026-07-28 04:00:00")
    assert column(store, "orders_archive", "OrderId") == {}


def test_a_guarded_second_catalog_night(store):
    product = lambda n, **more: {"SKU": f"p{n}", "ProductName": f"P{n}", "Price": "3", "InStock": True, "InventoryCount": 5} | more
    put(store, "products", *[product(n) for n in range(10)])
    put(store, "staging_products", *[product(n, Price="4") for n in range(10)], product(11), product(12, Price=None))
    store.replace("row_count_history", store.spark.createDataFrame([], "MetricName STRING, MetricValue STRING, RecordedDate TIMESTAMP_NTZ"))
    jobs.catalog_night(store, FIRST)
    assert len(column(store, "products", "SKU")) == 11 and column(store, "products", "SKU", "Price")["p0"] == (Decimal(4),)
    assert [r.MetricValue for r in store.read("row_count_history").collect()] == ["11"]
    put(store, "staging_products", *[product(n) for n in range(3)])
    before = column(store, "products", "SKU", "Price", "InStock")
    with pytest.raises(catalog.AnomalyError):
        jobs.catalog_night(store, SECOND)
    assert column(store, "products", "SKU", "Price", "InStock") == before
    assert sorted(r.Severity for r in store.read("error_log").collect()) == ["Critical", "Warning"]


def test_cart_sweep_twice(store):
    put(store, "subscribers", person("a"), person("b", EmailOptIn=False))
    cart = lambda n, key, day: {"CartId": n, "SubscriberKey": key, "CartStatus": "Active", "ItemCount": 1, "CartTotal": "9", "CartLastUpdatedDate": at(day)}
    put(store, "carts", cart("idle", "a", 24), cart("old", "a", 1), cart("out", "b", 24), cart("new", "a", 25) | {"CartLastUpdatedDate": at(25, hour=4)})
    for _ in range(2):
        jobs.cart_sweep(store, FIRST)
        assert column(store, "carts", "CartId", "CartStatus") == {"idle": ("Abandoned",), "old": ("Expired",), "out": ("Active",), "new": ("Active",)}


def test_loyalty_night_enrols_once(store):
    put(store, "loyalty", {"SubscriberKey": "m", "LoyaltyMemberId": "LOY-m", "CurrentTier": "Gold", "TrailingTwelveMonthSpend": "3000", "TierEffectiveDate": at(1, 1)})
    order = lambda o, k, total: {"OrderId": o, "SubscriberKey": k, "OrderDate": at(1), "OrderStatus": "Delivered", "OrderTotal": total}
    put(store, "orders", order("1", "m", "600"), order("2", "n", "2500"))
    for night in (FIRST, SECOND):
        jobs.loyalty_night(store, night)
        assert column(store, "loyalty", "SubscriberKey", "CurrentTier") == {"m": ("Silver",), "n": ("Gold",)}
    assert column(store, "loyalty", "SubscriberKey", "TierEffectiveDate")["m"] == (datetime(2026, 7, 25, 4),)


def test_winback_week_logs_each_tier_once(store):
    put(store, "subscribers", person("a"), person("b"))
    events(store, "sent", ("a", at(1, 1, 2025)), ("b", at(1, 1, 2025)))
    events(store, "opens", ("a", at(1, 4)), ("b", at(20)))
    events(store, "clicks")
    put(store, "winback_log")
    jobs.winback_week(store, FIRST)
    assert column(store, "winback_entry", "SubscriberKey", "InactivityTier") == {"a": ("Tier1_90Day",)}
    jobs.winback_week(store, SECOND)
    assert column(store, "winback_entry", "SubscriberKey") == {} and store.read("winback_log").count() == 1
    jobs.winback_week(store, "2026-11-30 04:00:00")
    assert column(store, "winback_entry", "SubscriberKey", "InactivityTier") == {"a": ("Tier2_180Day",), "b": ("Tier1_90Day",)}
    assert store.read("winback_log").count() == 3


def test_fallback_queue_keeps_what_was_processed(store):
    order = lambda o, status, day: {"OrderId": o, "SubscriberKey": "a", "OrderDate": at(1), "OrderStatus": status, "EstimatedDeliveryDate": at(day)}
    put(store, "orders", order("1", "Confirmed", 25), order("2", "Shipped", 20), order("3", "Delivered", 1))
    jobs.order_fallback_hour(store, FIRST)
    assert column(store, "fallback_queue", "OrderId", "FallbackEventType") == {"1": ("APIEvent-OrderShipped",), "2": ("APIEvent-OrderDelivered",)}
    store.replace("fallback_queue", store.read("fallback_queue").withColumn("Processed", F.lit(True)))
    put(store, "orders", order("1", "Confirmed", 25), order("2", "Shipped", 20), order("4", "Shipped", 21))
    jobs.order_fallback_hour(store, FIRST)
    assert column(store, "fallback_queue", "OrderId", "Processed") == {"1": (True,), "2": (True,), "4": (False,)}
