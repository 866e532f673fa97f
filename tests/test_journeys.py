"""Journey outcomes against the scenario tables, and streams against their batch form."""

from datetime import datetime

from pyspark.sql import functions as F

from lifeloom.plans import jobs, journeys
from lifeloom.session import scratch
from lifeloom.sources.tables import TableStore
from lifeloom.streaming import events as streams

TS = "timestamp_ntz"
NOW = "2026-12-01 00:00:00"
ENTRY = "2026-07-01 00:00:00"


def by(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}


def test_welcome_matrix(make):
    keys = ["both", "email", "none", "opened", "late_open", "bought", "left"]
    entries = make(f"SubscriberKey STRING, EntryDate {TS}", [(k, ENTRY) for k in keys])
    subs = make("SubscriberKey STRING, EmailOptIn BOOLEAN, SMSOptIn BOOLEAN", [(k, k != "none", k == "both") for k in keys])
    opens = make(f"SubscriberKey STRING, EmailName STRING, EventDate {TS}", [("opened", "EMAIL_WELCOME_01", "2026-07-02 00:00:00"), ("late_open", "EMAIL_WELCOME_01", "2026-07-05 00:00:00"), ("email", "OTHER", "2026-07-02 00:00:00")])
    orders = make(f"SubscriberKey STRING, OrderDate {TS}", [("bought", "2026-07-03 00:00:00"), ("email", "2026-06-01 00:00:00")])
    leaves = make(f"SubscriberKey STRING, LeftDate {TS}", [("left", "2026-07-02 00:00:00")])
    out = by(journeys.welcome(entries, subs, opens, orders, NOW, leaves), "SubscriberKey", "ChannelPath", "SecondEmail", "Outcome")
    assert out["both"] == ("Email+SMS", "Reminder", "EXIT-COMPLETE")
    assert out["email"] == ("EmailOnly", "Reminder", "EXIT-COMPLETE")
    assert out["none"] == (None, None, "EXIT-SUPPRESSED")
    assert out["opened"] == ("EmailOnly", "Browse", "EXIT-COMPLETE")
    assert out["late_open"][1] == "Reminder"
    assert out["bought"] == ("EmailOnly", "Reminder", "EXIT-CONVERTED")
    assert out["left"] == ("EmailOnly", None, "EXIT-CRITERIA")
    waiting = by(journeys.welcome(entries, subs, opens, orders, "2026-07-02 00:00:00"), "SubscriberKey", "Outcome")
    assert waiting["both"] == ("WAITING",)


def test_cart_series(make):
    carts = {"early": 0, "mid": 10, "sms": 25, "late": 50, "never": None, "after_sms_skipped": 25}
    entries = make(f"CartId STRING, SubscriberKey STRING, EntryDate {TS}", [(c, c, ENTRY) for c in carts])
    history = [(c, ENTRY if h != 0 else "2026-06-30 00:00:00", "Abandoned") for c, h in carts.items()]
    history += [(c, f"2026-07-0{1 + h // 24} {h % 24:02}:00:00", "Converted") for c, h in carts.items() if h is not None]
    subs = make("SubscriberKey STRING, SMSOptIn BOOLEAN", [(c, c != "after_sms_skipped") for c in carts])
    out = by(journeys.abandoned_cart(entries, make(f"CartId STRING, StatusDate {TS}, CartStatus STRING", history), subs, NOW), "CartId", "EmailsSent", "SmsSent", "Outcome")
    assert out["early"] == (0, False, "EXIT-CONVERTED-EARLY")
    assert out["mid"] == (1, False, "EXIT-CONVERTED-MID")
    assert out["sms"] == (2, False, "EXIT-CONVERTED-MID")
    assert out["late"] == (2, True, "EXIT-CONVERTED-LATE")
    assert out["never"] == (3, True, "EXIT-SERIES-COMPLETE")
    assert out["after_sms_skipped"] == (2, False, "EXIT-CONVERTED-LATE")


def test_post_purchase_orders_stay_apart(make):
    entries = make(f"SubscriberKey STRING, OrderId STRING, EntryDate {TS}", [("a", o, ENTRY) for o in ("ok", "noship", "nodeliver", "returned")])
    ev = f"OrderId STRING, EventDate {TS}"
    shipped = make(ev, [("ok", "2026-07-03 00:00:00"), ("noship", "2026-07-12 00:00:00"), ("nodeliver", "2026-07-03 00:00:00"), ("returned", "2026-07-03 00:00:00")])
    delivered = make(ev, [("ok", "2026-07-05 00:00:00"), ("nodeliver", "2026-07-20 00:00:00"), ("returned", "2026-07-05 00:00:00")])
    out = by(journeys.post_purchase(entries, shipped, delivered, make(ev, [("returned", "2026-07-08 00:00:00")]), NOW), "OrderId", "Outcome")
    assert out == {"ok": ("EXIT-COMPLETE",), "noship": ("EXIT-SHIP-TIMEOUT",), "nodeliver": ("EXIT-DELIVERY-TIMEOUT",), "returned": ("EXIT-RETURNED",)}


def test_winback_checkpoints(make):
    events = f"SubscriberKey STRING, EventDate {TS}"
    entries = make(f"SubscriberKey STRING, EntryDate {TS}", [(k, ENTRY) for k in ("first", "second", "day29", "silent")])
    opens = make(events, [("first", "2026-07-10 00:00:00"), ("day29", "2026-08-27 00:00:00")])
    clicks = make(events, [("second", "2026-07-20 00:00:00")])
    out = by(journeys.winback(entries, opens, clicks, NOW), "SubscriberKey", "EmailsSent", "Outcome")
    assert out == {"first": (1, "EXIT-REENGAGED"), "second": (2, "EXIT-REENGAGED"), "day29": (3, "EXIT-REENGAGED"), "silent": (3, "EXIT-SUNSET-PENDING")}


def test_entry_guard(make):
    schema = f"SubscriberKey STRING, EntryDate {TS}"
    new = make(schema, [("a", ENTRY), ("a", "2026-07-02 00:00:00"), ("b", ENTRY)])
    out = journeys.new_entries(new, make(schema, [("b", ENTRY)]), ["SubscriberKey"])
    assert [tuple(r) for r in out.collect()] == [("a", datetime(2026, 7, 1))]
    assert journeys.new_entries(new, make(schema, [("b", ENTRY)]), ["SubscriberKey"], reentry=True).count() == 2


def test_birthday_job_twice_a_day(make, spark):
    store = TableStore(spark, scratch(spark, "birthday"))
    store.replace("subscribers", make("SubscriberKey STRING, EmailAddress STRING, FirstName STRING, EmailOptIn BOOLEAN, SubscriberStatus STRING, DateOfBirth DATE", [("a", "a@x.com", "A", True, "Active", "1990-12-01")]))
    store.replace("loyalty", make("SubscriberKey STRING, CurrentTier STRING", []))
    store.replace("birthday_log", make(f"SubscriberKey STRING, BirthdayYear INT, EnteredDate {TS}", []))
    jobs.birthday_day(store, NOW)
    assert store.read("birthday_entry").count() == 1
    jobs.birthday_day(store, NOW)
    assert store.read("birthday_log").count() == 1


def test_stream_deduplicates_across_batches(spark):
    folder = scratch(spark, "two-batches")
    text = '{"ContactKey": "c", "EventDefinitionKey": "APIEvent-OrderShipped", "Data": {"OrderId": "%s"}}'
    for n, ids in enumerate((["1", "2", "1"], ["2", "3"])):
        rows = [(text % i, datetime(2026, 7, 1, n)) for i in ids] + [("not json", datetime(2026, 7, 1, n))]
        spark.createDataFrame(rows, "value STRING, ReceivedAt TIMESTAMP").write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema("value STRING, ReceivedAt TIMESTAMP").parquet(f"{folder}/in")
        for query in streams.run_ingest(source, f"{folder}/out", f"{folder}/checkpoint"):
            query.awaitTermination()
    accepted = spark.read.parquet(f"{folder}/out/accepted")
    assert sorted(r.BusinessKey for r in accepted.collect()) == ["1", "2", "3"]
    assert spark.read.parquet(f"{folder}/out/quarantine").filter(F.col("Reason").isNotNull()).count() == 2
