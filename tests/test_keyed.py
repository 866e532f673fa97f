"""Tables dealt by key, routed events over them, late rows."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lifeloom.sources import registry
from lifeloom.sources.keyed import KeyedTable
from lifeloom.sources.tables import TableStore
from lifeloom.streaming import events as streams
from tests.test_losses import _batch


def files(table, number):
    return {p for p in Path(table.path).glob(f"_bucket=*/_batch={number}/*.parquet")}


def test_only_touched_buckets_are_written(spark, make, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=16)
    assert table.merge("a", spark.range(4000).select(F.col("id").alias("k"), F.lit("old").alias("v"))) == 16
    assert table.merge("b", make("k BIGINT, v STRING, w INT", [(7, "new", 1)])) == 1
    size = lambda number: sum(p.stat().st_size for p in files(table, number))
    assert len(files(table, 2)) == 1 and size(2) * 8 < size(1)
    got = {r.k: (r.v, r.w) for r in table.read().collect()}
    assert len(got) == 4000 and got[7] == ("new", 1) and got[8] == ("old", None)


def test_a_batch_counts_once_and_a_broken_one_not_at_all(spark, make, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    table.merge("a", make("k BIGINT, n INT", [(1, 1), (2, 1)]))
    add = lambda before, rows: before.unionByName(rows).groupBy("k").agg(F.sum("n").cast("int").alias("n"))
    for _ in range(2):  # the second run of a finished batch does nothing
        table.merge("b", make("k BIGINT, n INT", [(1, 5)]), add)
    # A batch that broke off has folders but no marker.
    broken = make("k BIGINT, n INT", [(1, 100), (2, 100)]).withColumn("_bucket", F.pmod(F.xxhash64("k"), F.lit(4)).cast("int"))
    broken.withColumn("_batch", F.lit(3)).write.mode("append").partitionBy("_bucket", "_batch").parquet(table.path)
    assert {tuple(r) for r in table.read().collect()} == {(1, 6), (2, 1)}
    table.merge("c", make("k BIGINT, n INT", [(2, 7)]), add)
    assert {tuple(r) for r in table.read().collect()} == {(1, 6), (2, 8)}
    assert table.prune() > 0
    assert {tuple(r) for r in table.read().collect()} == {(1, 6), (2, 8)}


def test_empty_batches(spark, make, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.merge("a", make("k BIGINT", [])) == 0 and table.read().count() == 0
    table.merge("b", make("k BIGINT", [(1,)]))
    assert table.merge("c", make("k BIGINT", [])) == 0 and table.read().count() == 1


def test_append_leaves_what_is_there(spark, make, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", make("k INT, v STRING", [(1, "a")]))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert {tuple(r) for r in store.append("t", make("k INT, v STRING", [(1, "x"), (2, "b")]), ["k"]).collect()} == {(1, "a"), (2, "b")}
    assert {tuple(r) for r in store.append("t", make("k INT, v STRING", [(3, "c")]), ["k"]).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    assert all(p.stat().st_mtime_ns == at for p, at in before.items())
    # A folder without its success mark is not read.
    make("k INT, v STRING", [(9, "z")]).write.parquet(f"{store.path('t')}+broken")
    next((Path(store.path("t") + "+broken")).glob("_SUCCESS")).unlink()
    assert store.read("t").count() == 3


def test_events_on_a_loaded_order_table_whatever_their_order(spark, tmp_path):
    at = lambda day: datetime(2026, 1, day)
    order = spark.createDataFrame([("o",)], "OrderId STRING")
    fields = [(F.col(f.name) if f.name == "OrderId" else F.lit("Placed" if f.name == "OrderStatus" else None)).cast(f.dataType).alias(f.name) for f in registry.schema("orders").fields]
    events = [
        ("APIEvent-OrderShipped", at(2), {"OrderId": "o", "ShippingCarrier": "X", "TrackingNumber": "1", "ShippedDate": "2026-01-02"}),
        ("APIEvent-OrderShipped", at(4), {"OrderId": "o", "ShippingCarrier": "X", "TrackingNumber": "2", "ShippedDate": "2026-01-04"}),
        ("APIEvent-OrderDelivered", at(5), {"OrderId": "o", "ActualDeliveryDate": "2026-01-05"}),
        ("APIEvent-OrderReturned", at(9), {"OrderId": "o", "ReturnedDate": "2026-01-09"}),
        ("APIEvent-OrderShipped", at(3), {"OrderId": "p", "ShippingCarrier": "Y"}),
        ("APIEvent-OrderShipped", at(3), {"OrderId": None, "ShippingCarrier": "Y"}),
    ]
    results = set()
    for turn, sequence in enumerate(([0, 1, 2, 3, 4, 5], [3, 2, 5, 1, 0, 4], [2, 0, 4, 3, 1, 5])):
        store = TableStore(spark, str(tmp_path / str(turn)))
        store.replace("orders", order.select(*fields))
        handle = streams.route_into(store)
        for number, i in enumerate(sequence):
            handle(_batch(spark, [events[i]]), number)
        handle(_batch(spark, [events[sequence[-1]]]), 77)  # the same event once more
        rows = store.read("orders").collect()
        results |= {(r.OrderId, r.OrderStatus, r.ShippingCarrier, r.TrackingNumber, str(r.ShippedDate)[:10], str(r.ActualDeliveryDate)[:10], str(r.ReturnedDate)[:10]) for r in rows}
        assert {"OrderDate", "OrderTotal", "ReviewRequestSent"} <= set(store.read("orders").columns)
    assert results == {("o", "Returned", "X", "2", "2026-01-04", "2026-01-05", "2026-01-09"), ("p", "Shipped", "Y", None, "None", "None", "None")}


def test_late_rows_are_kept_and_replayed_once(spark, tmp_path):
    late = streams.LateRows(spark, str(tmp_path), "at", "1 day")
    batch = lambda *days: spark.createDataFrame([(d, datetime(2026, 1, d)) for d in days], "n INT, at TIMESTAMP")
    seen = []
    handle = late.aside(lambda rows, number: seen.append((number, sorted(r.n for r in rows.collect()))))
    handle(batch(1, 5), 0)
    handle(batch(3, 4, 6), 1)
    handle(batch(3, 4, 6), 1)  # run again: the same split
    handle(spark.createDataFrame([], "n INT, at TIMESTAMP"), 2)
    handle(batch(2, 8), 3)
    assert seen == [(0, [1, 5]), (1, [4, 6]), (1, [4, 6]), (2, []), (3, [8])]
    schema = batch(1).schema
    assert sorted(r.n for r in late.waiting(schema).collect()) == [2, 3]
    again = []
    assert late.replay(schema, lambda rows, tag: again.append((tag, sorted(r.n for r in rows.collect())))) == 2
    assert late.replay(schema, lambda rows, tag: again.append(tag)) == 0
    assert again == [("late-3", [2, 3])]
