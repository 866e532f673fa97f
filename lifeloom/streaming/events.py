"""Event streams: ingest, route, cart state, timeouts, guards and rates.

Builders take and return (streaming) DataFrames, so that the same code runs on a batch
of history; ``run_*`` functions start a query with a checkpoint and a sink.  Event time
must be TIMESTAMP for watermarks.

Late rows: a watermark of an hour for carts and a day for order status; what comes later is put aside
(``LateRows``) and replayed by a batch job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import LongType, Row, StructField, StructType

from lifeloom.functions.times import Moment
from lifeloom.operators.carts import detect_abandoned
from lifeloom.operators.quality import validated_events
from lifeloom.sources.files import parse_events
from lifeloom.sources.keyed import batch_tag
from lifeloom.sources.tables import TableStore, latest_rows, upserted

CART_LATENESS = "1 hour"
ORDER_LATENESS = "1 day"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# -- ingest ----------------------------------------------------------------------------
def checked_events(raw: DataFrame) -> DataFrame:
    """``value`` JSON text and ``ReceivedAt`` to typed events with a quarantine Reason."""
    return validated_events(parse_events(raw)).withColumn(
        "BusinessKey",
        F.coalesce("Data.OrderId", "Data.CaseId", F.col("Data.SignupDate").cast("string"), F.lit("")),
    )


def accepted_events(raw: DataFrame, lateness: str = ORDER_LATENESS) -> DataFrame:
    """Valid events, each business event once within the lateness bound.

    The delivery id is minted per call and says nothing about duplicates, so the key is
    contact, event and the order, case or signup it is about.
    """
    return (
        checked_events(raw)
        .filter(F.col("Reason").isNull())
        .withWatermark("ReceivedAt", lateness)
        .dropDuplicatesWithinWatermark(["ContactKey", "EventDefinitionKey", "BusinessKey"])
    )


def quarantined_events(raw: DataFrame) -> DataFrame:
    return checked_events(raw).filter(F.col("Reason").isNotNull())


def run_append(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to parquet with exactly-once file commits; default: everything available, then stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_ingest(raw: DataFrame, folder: str, checkpoint: str, **trigger) -> list[StreamingQuery]:
    """Two queries: accepted events and quarantine."""
    return [
        run_append(accepted_events(raw), f"{folder}/accepted", f"{checkpoint}/accepted", **trigger),
        run_append(quarantined_events(raw), f"{folder}/quarantine", f"{checkpoint}/quarantine", **trigger),
    ]


# -- route -----------------------------------------------------------------------------
# Order events, the status each sets, and the fields they carry.
ORDER_STATUS = {
    "APIEvent-OrderShipped": "Shipped",
    "APIEvent-OrderDelivered": "Delivered",
    "APIEvent-OrderReturned": "Returned",
}
ORDER_FIELDS = ["ShippingCarrier", "TrackingNumber", "ShippedDate", "EstimatedDeliveryDate", "ActualDeliveryDate", "ReturnedDate"]
#: Column of routed tables that says how new a row is, so that an older event of a later batch does not win.
EVENT_TIME = "LastEventAt"


#: Of each field of an order the time of the event that set it.
FIELD_TIMES = "FieldTimes"


def merged_orders(changes: DataFrame) -> DataFrame:
    """One row per order: of the status and of each field the value of the newest event that had one.

    Every field keeps its own time, because an event that comes late may be newer than what set one field and older than what
    set another.  Values that no event has set are older than any.
    """
    fields = ["OrderStatus", *ORDER_FIELDS]
    at = {n: F.when(F.col(n).isNotNull(), F.col(FIELD_TIMES)[n]) for n in fields}
    newest = [F.max_by(n, F.when(F.col(n).isNotNull(), F.struct(at[n], n))).alias(n) for n in fields]
    merged = changes.groupBy("OrderId").agg(*newest, *[F.max(at[n]).alias(f"_{n}") for n in fields], F.max(EVENT_TIME).alias(EVENT_TIME))
    times = F.create_map(*[c for n in fields for c in (F.lit(n), F.col(f"_{n}"))])
    return merged.withColumn(FIELD_TIMES, F.map_filter(times, lambda _, t: t.isNotNull())).select("OrderId", *fields, EVENT_TIME, FIELD_TIMES)


def routed(events: DataFrame) -> dict[str, DataFrame]:
    """Rows per target table of a batch of accepted events."""

    def of(name: str) -> DataFrame:
        return events.filter(F.col("EventDefinitionKey") == name)

    def data(df: DataFrame, *names: str) -> DataFrame:
        return df.select(*[F.col(f"Data.{n}").alias(n) for n in names], F.col("ReceivedAt").alias(EVENT_TIME))

    changes = events.filter(F.col("EventDefinitionKey").isin(*ORDER_STATUS)).select(
        F.col("Data.OrderId").alias("OrderId"),
        F.create_map(*[F.lit(x) for pair in ORDER_STATUS.items() for x in pair])[F.col("EventDefinitionKey")].alias("OrderStatus"),
        *[F.col(f"Data.{n}").alias(n) for n in ORDER_FIELDS],
        F.col("ReceivedAt").alias(EVENT_TIME),
        F.create_map(*[c for n in ["OrderStatus", *ORDER_FIELDS] for c in (F.lit(n), F.col("ReceivedAt"))]).alias(FIELD_TIMES),
    )
    return {
        "welcome_entry": latest_rows(
            data(of("APIEvent-Welcome-Signup"), "SubscriberKey", "EmailAddress", "FirstName", "SignupSource", "SignupDate", "PromoCodeIssued"),
            ["SubscriberKey"],
            EVENT_TIME,
        ),
        "post_purchase_entry": latest_rows(
            data(of("APIEvent-OrderPlaced"), "SubscriberKey", "OrderId", "OrderDate"), ["SubscriberKey", "OrderId"], EVENT_TIME
        ),
        "case_entry": latest_rows(
            data(of("APIEvent-CaseEscalated"), "CaseId", "SubscriberKey", "CaseSubject", "CasePriority", "EscalatedDate"),
            ["CaseId"],
            EVENT_TIME,
        ),
        "orders": merged_orders(changes),
    }


ROUTE_KEYS = {
    "welcome_entry": ["SubscriberKey"],
    "post_purchase_entry": ["SubscriberKey", "OrderId"],
    "case_entry": ["CaseId"],
    "orders": ["OrderId"],
}


def route_into(store: TableStore) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: fold a micro-batch into the tables it concerns.

    Only the buckets of keys that occur are written, into folders of the batch's own.  Rows only give way to newer events,
    whatever batch those come in, so a replayed or late batch leaves the same tables.  A target that is there already, with
    more columns or fewer, keeps its own; the event's fields are added.
    """
    wanted = {
        "welcome_entry": ["APIEvent-Welcome-Signup"],
        "post_purchase_entry": ["APIEvent-OrderPlaced"],
        "case_entry": ["APIEvent-CaseEscalated"],
        "orders": list(ORDER_STATUS),
    }

    def folded(name: str, key: list[str]):
        def combine(before: DataFrame, rows: DataFrame) -> DataFrame:
            touched = before.join(rows.select(*key), key, "left_semi").select(*rows.columns)
            newest = merged_orders(rows.unionByName(touched)) if name == "orders" else latest_rows(rows.unionByName(touched), key, EVENT_TIME)
            return upserted(before, newest, key)

        return combine

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            flags = [F.bool_or(F.col("EventDefinitionKey").isin(*keys)).alias(name) for name, keys in wanted.items()]
            present = batch.agg(*flags).first()
            for name, rows in routed(batch).items():
                if present[name]:
                    key = ROUTE_KEYS[name]
                    store.keyed(name, key).merge(batch_tag(store.spark, batch_id), rows.dropna(subset=key), folded(name, key))
        finally:
            batch.unpersist()

    return handle


# -- late rows ---------------------------------------------------------------------------
class LateRows:
    """Rows behind the watermark, put aside batch by batch instead of dropped, until they are replayed.

    The watermark of a batch is the newest event time of the batches before it less ``lateness``.  Every batch writes
    its newest time, its late rows, and a replay its mark into folders of its own number, so a batch may run again.
    """

    def __init__(self, spark, path: str, event_time: str, lateness: str = ORDER_LATENESS):
        self.spark, self.path, self.event_time, self.lateness = spark, path.rstrip("/"), event_time, lateness

    def _known(self, part: str, schema: str | StructType) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def split(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of the batch that are in time; the others are written."""
        at = F.col(self.event_time)
        seen = self._known("newest", "at TIMESTAMP, batch BIGINT").filter(F.col("batch") < batch_id)
        edge = seen.agg(F.max("at").alias("at")).select((F.col("at") - F.expr(f"INTERVAL {self.lateness}")).alias("at")).first().at
        newest = batch.agg(F.max(at).cast("timestamp").alias("at"))
        newest.write.mode("overwrite").parquet(f"{self.path}/newest/batch={batch_id}")
        if edge is None:
            return batch
        late = F.coalesce(at < F.lit(edge), F.lit(False))
        batch.filter(late).write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        return batch.filter(~late)

    def aside(self, handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """``handle`` for the rows in time."""

        def split_then(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                handle(self.split(batch, batch_id), batch_id)
            finally:
                batch.unpersist()

        return split_then

    def waiting(self, schema: StructType) -> DataFrame:
        """Late rows that no replay has taken yet, with the ``batch`` they came in."""
        rows = self._known("rows", StructType([*schema.fields, StructField("batch", LongType())]))
        done = self._known("replayed", "upto BIGINT, run BIGINT").agg(F.coalesce(F.max("upto"), F.lit(-1).cast("bigint")).alias("upto"))
        return rows.join(F.broadcast(done), F.col("batch") > F.col("upto")).drop("upto")

    def replay(self, schema: StructType, handle: Callable[[DataFrame, str], None]) -> int:
        """The batch job: hand all waiting rows to ``handle``, then mark them as taken.  Returns their number."""
        rows = self.waiting(schema)
        upto, count = rows.agg(F.max("batch"), F.count(F.lit(1))).first()
        if count:
            handle(rows.filter(F.col("batch") <= upto).drop("batch"), f"late-{upto}")
            done = self.spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"))
            done.write.mode("overwrite").parquet(f"{self.path}/replayed/run={upto}")
        return count


def run_foreach(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def upsert_carts_into(store: TableStore, name: str = "carts", key: str = "CartId", latest: str = "CartLastUpdatedDate"):
    """``foreachBatch`` function: latest row per key wins within and across batches; a known row keeps fields that are not sent."""

    def newer(before: DataFrame, rows: DataFrame) -> DataFrame:
        known = before.select(key, F.col(latest).alias("_known"))
        fresh = rows.join(known, key, "left").filter(F.col("_known").isNull() | (F.col(latest) >= F.col("_known")))
        return upserted(before, fresh.drop("_known"), [key])

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = latest_rows(batch.filter(F.col(key).isNotNull()), [key], latest)
        store.keyed(name, [key]).merge(batch_tag(store.spark, batch_id), rows, newer)

    return handle


def poll_abandonment(store: TableStore, as_of_of: Callable[[int], Moment]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: the batch abandonment job after every micro-batch; only carts that change are written."""

    def handle(_batch: DataFrame, batch_id: int) -> None:
        carts = store.keyed("carts", ["CartId"])
        before = carts.read().select("CartId", F.col("CartStatus").alias("_was"))
        after = detect_abandoned(carts.read(), store.read("subscribers"), as_of_of(batch_id)).select("CartId", "CartStatus")
        changed = after.join(before, "CartId").filter(~F.col("CartStatus").eqNullSafe(F.col("_was"))).drop("_was")
        carts.merge(batch_tag(store.spark, batch_id), changed)

    return handle


# -- windows ---------------------------------------------------------------------------
def abandoned_sessions(updates: DataFrame, idle: str = "30 minutes", lateness: str = CART_LATENESS) -> DataFrame:
    """Carts without an update for ``idle``: one row per closed session that did not convert.

    ``updates``: CartId, SubscriberKey, CartStatus, UpdatedAt (TIMESTAMP).
    """
    return (
        updates.withWatermark("UpdatedAt", lateness)
        .groupBy("CartId", F.session_window("UpdatedAt", idle).alias("_w"))
        .agg(
            F.max_by("SubscriberKey", "UpdatedAt").alias("SubscriberKey"),
            F.max_by("CartStatus", "UpdatedAt").alias("_status"),
            F.max("UpdatedAt").alias("CartLastUpdatedDate"),
            F.count(F.lit(1)).alias("Updates"),
        )
        .filter(F.col("_status") == "Active")
        .select("CartId", "SubscriberKey", "CartLastUpdatedDate", F.col("_w.end").alias("AbandonedAt"), "Updates")
    )


def sends_once(sends: DataFrame, within: str = "60 seconds") -> DataFrame:
    """Same message to the same contact within the window: the first is kept."""
    return sends.withWatermark("RequestedAt", within).dropDuplicatesWithinWatermark(["MessageKey", "ContactKey"])


def rate_windows(calls: DataFrame, limit: int, width: str = "1 minute", lateness: str = "5 minutes") -> DataFrame:
    """Calls per unit and window, and whether the platform limit is exceeded."""
    return (
        calls.withWatermark("ReceivedAt", lateness)
        .groupBy(F.window("ReceivedAt", width).alias("_w"), "BusinessUnitMID")
        .agg(F.count(F.lit(1)).alias("Calls"))
        .select(
            "BusinessUnitMID",
            F.col("_w.start").alias("WindowStart"),
            "Calls",
            (F.col("Calls") > limit).alias("OverLimit"),
        )
    )


# Platform ceilings (calls, window).
EVENT_LIMIT = (10_000, "1 minute")
ROWSET_LIMIT = (2_500, "10 seconds")


def debounced(updates: DataFrame, quiet: str = "400 milliseconds", lateness: str = "10 seconds") -> DataFrame:
    """Bursts of quantity changes of a cart line collapsed to their last value."""
    return (
        updates.withWatermark("UpdatedAt", lateness)
        .groupBy("CartId", "SKU", F.session_window("UpdatedAt", quiet).alias("_w"))
        .agg(
            F.max_by("Quantity", "UpdatedAt").alias("Quantity"),
            F.max("UpdatedAt").alias("UpdatedAt"),
            F.count(F.lit(1)).alias("Changes"),
        )
        .drop("_w")
    )


def engagement_rollup(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Opens and clicks per job and day, final once the day has passed the watermark."""
    return (
        events.withWatermark("EventDate", lateness)
        .groupBy(F.window("EventDate", "1 day").alias("_w"), "JobID")
        .agg(F.count_if(F.col("Kind") == "open").alias("Opens"), F.count_if(F.col("Kind") == "click").alias("Clicks"))
        .select(F.to_date("_w.start").alias("EventDay"), "JobID", "Opens", "Clicks")
    )


def event_or_timeout(
    placed: DataFrame, shipped: DataFrame, days: int = 10, lateness: str = ORDER_LATENESS
) -> DataFrame:
    """Placed orders with their shipped event within ``days``; NULL once that can no longer come.

    A left outer stream-stream join on OrderId with both sides watermarked: state is kept
    for the interval only.
    """
    left = placed.withWatermark("PlacedAt", lateness)
    right = shipped.select(F.col("OrderId").alias("_order"), "ShippedAt").withWatermark("ShippedAt", lateness)
    inside = (
        (F.col("OrderId") == F.col("_order"))
        & (F.col("ShippedAt") >= F.col("PlacedAt"))
        & (F.col("ShippedAt") <= F.col("PlacedAt") + F.expr(f"INTERVAL {days} DAYS"))
    )
    return left.join(right, inside, "left_outer").drop("_order")


# -- keyed state -------------------------------------------------------------------------
def use_rocksdb(spark) -> None:
    """Keyed-state operators need the RocksDB state store (state beyond the heap, changelog checkpoints)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _ms(micros: int) -> int:
    """The first millisecond at or after a time: timers have milliseconds."""
    return -(-micros // 1000)


def _micros(at) -> int:
    return round(at.timestamp() * 1_000_000)


#: So many items of a key wait in its one row of state; the later ones of more go into rows by hour.
NEAR = 4096
HOUR_US = 3_600_000_000


def _ordered_processor():
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class InOrder(StatefulProcessor):
        """Takes a key's items in order once the watermark has passed them, whatever order they came in.

        An item is a tuple of longs, first its time.  What is remembered of a key, its one timer and its waiting items are one
        row of state, so that a batch costs a key a few calls to the state store, not a few per item.
        """

        #: Longs of an item.
        width = 1

        def init(self, handle) -> None:
            self.handle = handle
            # ``far`` has the hour, the first time and the number of parts of the rows in ``later``.
            self.held = handle.getValueState("held", "memory BIGINT, timer BIGINT, waiting ARRAY<BIGINT>, far ARRAY<BIGINT>")
            self.later = handle.getMapState("later", "hour BIGINT, part BIGINT", "waiting ARRAY<BIGINT>")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            memory, timer, items, far = self._load()
            for row in rows:
                items.append(self.item(row))
                if len(items) >= 2 * NEAR:
                    items = self._spilt(items, far)
            self._store(memory, timer, items, far)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            edge = timerValues.getCurrentWatermarkInMs() * 1000
            memory, _, items, far = self._load()
            for hour in [*sorted(h for h, (first, _) in far.items() if first <= edge), None]:
                border = edge if hour is None else min(edge, (hour + 1) * HOUR_US - 1)
                for part in range(far.pop(hour)[1] if hour is not None else 0):
                    items.extend(self._items(self.later.getValue((hour, part))[0]))
                    self.later.removeKey((hour, part))
                due = self.thinned(sorted(i for i in items if i[0] <= border))
                items = [i for i in items if i[0] > border]
                memory, times = self.take(memory, due)
                for at in times:
                    yield self.row(key[0], datetime.fromtimestamp(at / 1_000_000))
            self._store(self.kept(memory, edge), None, items, far)

        def thinned(self, items: list[tuple]) -> list[tuple]:
            """Sorted items without those that can never matter."""
            return items

        def kept(self, memory: int | None, edge: int) -> int | None:
            """What is still remembered once the watermark has reached ``edge``."""
            return memory

        def ends(self, memory: int | None) -> int | None:
            """The time at which ``memory`` can go."""
            return None

        def _items(self, flat) -> list[tuple]:
            return list(zip(*[iter(flat)] * self.width))

        def _load(self):
            held = self.held.get()
            if held is None:
                return None, None, [], {}
            memory, timer, waiting, far = held
            return memory, timer, self._items(waiting), {h: (first, parts) for h, first, parts in zip(*[iter(far)] * 3)}

        def _spilt(self, items: list[tuple], far: dict) -> list[tuple]:
            """The first ``NEAR`` items; the others go into new parts of their hours."""
            items = self.thinned(sorted(items))
            hours: dict[int, list[tuple]] = {}
            for item in items[NEAR:]:
                hours.setdefault(item[0] // HOUR_US, []).append(item)
            for hour, rest in hours.items():
                first, parts = far.get(hour, (rest[0][0], 0))
                self.later.updateValue((hour, parts), ([x for item in rest for x in item],))
                far[hour] = min(first, rest[0][0]), parts + 1
            return items[:NEAR]

        def _store(self, memory: int | None, timer: int | None, items: list[tuple], far: dict) -> None:
            if len(items) > NEAR:
                items = self._spilt(items, far)
            times = [*(i[0] for i in items), *(first for first, _ in far.values()), self.ends(memory)]
            due = min((_ms(t) for t in times if t is not None), default=None)
            if due != timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                if due is not None:
                    self.handle.registerTimer(due)
            if memory is None and due is None:
                self.held.clear()
            else:
                flat = [x for h, (first, parts) in far.items() for x in (h, first, parts)]
                self.held.update((memory, due, [x for item in items for x in item], flat))

        def close(self) -> None:
            pass

    return InOrder


def _guard_processor():
    class ReentryGuard(_ordered_processor()):
        """One live instance per contact: entries while one is inside are dropped.

        Remembered is the end of the stay; a timer at that time removes the contact's state.
        """

        def __init__(self, stay_us: int):
            self.stay_us = stay_us

        def item(self, row) -> tuple:
            return (_micros(row.EntryDate),)

        def thinned(self, items: list[tuple]) -> list[tuple]:
            # Of one millisecond only the first entry can get in.
            return [i for k, i in enumerate(items) if not k or _ms(items[k - 1][0]) != _ms(i[0])]

        def take(self, until: int | None, items: list[tuple]) -> tuple[int | None, list[int]]:
            entered = []
            for (at,) in items:
                if until is None or at >= until:
                    until = at + self.stay_us
                    entered.append(at)
            return until, entered

        def kept(self, until: int | None, edge: int) -> int | None:
            return None if until is not None and until <= edge else until

        def ends(self, until: int | None) -> int | None:
            return until

        def row(self, key, at) -> Row:
            return Row(SubscriberKey=key, EntryDate=at)

    return ReentryGuard


def entries_once(entries: DataFrame, stay_days: int, lateness: str = ORDER_LATENESS) -> DataFrame:
    """Entries (SubscriberKey, EntryDate) of contacts that are not inside already, once the watermark has passed them.

    A contact stays inside for ``stay_days``.  State is what waits for the watermark, and one number per contact inside.
    """
    processor = _guard_processor()(stay_days * 86_400_000_000)
    return entries.withWatermark("EntryDate", lateness).groupBy("SubscriberKey").transformWithState(
        statefulProcessor=processor,
        outputStructType="SubscriberKey STRING, EntryDate TIMESTAMP",
        outputMode="Append",
        timeMode="EventTime",
    )


def _change_processor():
    class Escalation(_ordered_processor()):
        """Emits a case when Escalated turns from false (or unknown) to true.

        Only of escalated cases something is remembered: false and unknown are the same.
        """

        width = 3

        def item(self, row) -> tuple:
            return _micros(row.ChangedAt), int(row.ChangeId), int(bool(row.Escalated))

        def take(self, escalated: int | None, items: list[tuple]) -> tuple[int | None, list[int]]:
            turned = []
            for at, _, now in items:
                if now and not escalated:
                    turned.append(at)
                escalated = now or None
            return escalated, turned

        def row(self, key, at) -> Row:
            return Row(CaseId=key, ChangedAt=at)

    return Escalation


def escalation_changes(changes: DataFrame, lateness: str = ORDER_LATENESS) -> DataFrame:
    """Changes (CaseId, ChangeId, Escalated, ChangedAt) that escalate a case, once the watermark has passed them."""
    return changes.withWatermark("ChangedAt", lateness).groupBy("CaseId").transformWithState(
        statefulProcessor=_change_processor()(),
        outputStructType="CaseId STRING, ChangedAt TIMESTAMP",
        outputMode="Append",
        timeMode="EventTime",
    )
