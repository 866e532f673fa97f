"""Cases in which rows, fields or history used to get lost."""

from datetime import datetime

from pyspark.sql import functions as F

from lifeloom.functions import asof
from lifeloom.functions.ranking import positions
from lifeloom.operators import catalog
from lifeloom.sources.tables import TableStore, export_and_clear
from lifeloom.streaming import events as streams

NOW = "2026-07-25 04:00:00"


def test_null_group_keeps_its_rows(make):
    df = make("g STRING, n INT", [(None, 2), (None, 1), ("a", 5)])
    got = {(r.g, r.n, r.Position) for r in positions(df, ["g"], [F.col("n")]).collect()}
    assert got == {(None, 1, 1), (None, 2, 2), ("a", 5, 1)}


def test_null_key_matches_no_fact(make):
    probes = make("k STRING, t timestamp_ntz", [(None, "2026-01-02"), ("a", "2026-01-02")])
    facts = make("k STRING, s timestamp_ntz, v INT", [(None, "2026-01-01", 1), ("a", "2026-01-01", 2)])
    got = {r.k: r.v for r in asof.latest_before(probes, facts, ["k"], "t", "s", ["v"]).collect()}
    assert got == {None: None, "a": 2}


def test_previous_value_of_null_key_crosses_months(make):
    df = make("k STRING, t timestamp_ntz, v INT", [(None, "2026-01-31", 1), (None, "2026-02-01", 2)])
    got = {r.v: r.p for r in asof.previous_value(df, ["k"], "t", "v", "p").collect()}
    assert got == {1: None, 2: 1}


def test_rejects_without_sku_are_all_logged(spark, make, tmp_path):
    staged = make("SKU STRING, Price DOUBLE, InventoryCount INT", [(None, 1.0, 1), (None, 2.0, 1)])
    store = TableStore(spark, str(tmp_path))
    assert store.append("log", catalog.rejected(staged, NOW), ["ErrorLogId"]).count() == 2
    assert store.append("log", catalog.rejected(staged, NOW), ["ErrorLogId"]).count() == 2


def test_rows_after_the_export_stay(spark, make, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", make("k INT, v STRING", [(1, "a")]))
    from lifeloom.sources import tables

    export = tables.export_csv

    def late(df, *args):
        path = export(df, *args)
        store.append("t", make("k INT, v STRING", [(2, "b")]), ["k"])
        return path

    monkeypatch.setattr(tables, "export_csv", late)
    export_and_clear(store, "t", str(tmp_path / "out"), NOW)
    assert [tuple(r) for r in store.read("t").collect()] == [(2, "b")]


def test_guard_compares_with_the_last_value(make):
    products = make("InStock BOOLEAN", [(True,)] * 90)
    history = make("MetricName STRING, MetricValue STRING, RecordedDate timestamp_ntz", [
        (catalog.METRIC, "1000", "2026-01-01"), (catalog.METRIC, "100", "2026-02-01")])
    assert not catalog.row_count_check(products, history).first().Anomaly


def _batch(spark, rows):
    data = ("SubscriberKey EmailAddress FirstName SignupSource SignupDate PromoCodeIssued OrderId OrderDate CaseId "
            "CaseSubject CasePriority EscalatedDate").split()  # fmt: skip
    fields = ", ".join(f"{n}: STRING" for n in [*data, *streams.ORDER_FIELDS])
    schema = f"ContactKey STRING, EventDefinitionKey STRING, ReceivedAt TIMESTAMP, Data STRUCT<{fields}>"
    names = [*data, *streams.ORDER_FIELDS]
    return spark.createDataFrame([("c", k, at, tuple(d.get(n) for n in names)) for k, at, d in rows], schema)


def test_router_sees_known_keys_among_many_unknown_ones_and_keeps_the_newest(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    handle = streams.route_into(store)
    at = lambda day: datetime(2026, 1, day)
    noise = [(f"unknown-{i}", at(1), {}) for i in range(300)]
    handle(_batch(spark, [*noise, ("APIEvent-OrderDelivered", at(5), {"OrderId": "o", "ActualDeliveryDate": "2026-01-05"})]), 0)
    handle(_batch(spark, [("APIEvent-OrderShipped", at(2), {"OrderId": "o", "ShippingCarrier": "X", "TrackingNumber": "7"})]), 1)
    row = store.read("orders").first()
    assert (row.OrderStatus, row.ShippingCarrier, row.TrackingNumber, row.ActualDeliveryDate) == ("Delivered", "X", "7", "2026-01-05")
