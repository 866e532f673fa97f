"""Keyed stream state that goes away again, and components that grow batch by batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import Row

from lifeloom.operators import identity
from lifeloom.sources.keyed import KeyedTable
from lifeloom.streaming import events as streams

START = datetime(2026, 1, 1)


def run(spark, tmp_path, schema, batches, build):
    """Rows that a builder emits over the batches, and its state rows after each progress."""
    streams.use_rocksdb(spark)
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = streams.run_append(build(source), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: p if isinstance(p, dict) else __import__("json").loads(p.json), query.recentProgress) if p["stateOperators"]]
    return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())), totals


def test_guard_takes_entries_in_order_and_forgets(spark, tmp_path):
    at = lambda d, s=0: START + timedelta(days=d, seconds=s)
    rng = random.Random(4)
    entries = [(f"c{i}", at(0, i)) for i in range(200)] + [("c0", at(3)), ("c0", at(7, 0)), ("c0", at(6.5)), ("c1", at(8)), ("c1", at(7, 1)), ("c1", at(7, 1))]
    rng.shuffle(entries)  # order inside a batch does not matter
    batches = [entries, [("z", at(30))], [("z", at(60))], [("z", at(90))]]
    got, totals = run(spark, tmp_path, "SubscriberKey STRING, EntryDate TIMESTAMP", batches, lambda s: streams.entries_once(s, 7))
    want = [(f"c{i}", at(0, i)) for i in range(200)] + [("c0", at(7)), ("c1", at(7, 1)), ("z", at(30)), ("z", at(60))]
    assert got == sorted(want)
    assert max(totals) > 200 and totals[-1] < 10


def test_cases_in_order_over_batches_and_only_escalated_ones_stay(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    changes = [(f"k{i}", i, i % 2 == 0, at(1)) for i in range(100)]
    first = [*changes, ("a", 500, True, at(9)), ("a", 501, False, at(5)), ("b", 502, True, at(4)), ("b", 503, True, at(4))]
    # Later in arrival, earlier in time: still in time for the watermark of a day.
    second = [("a", 504, True, at(4)), ("b", 505, False, at(2)), ("k0", 506, False, at(3)), ("k0", 507, True, at(6))]
    third = [(f"k{i}", 600 + i, False, at(100)) for i in range(100)]
    schema = "CaseId STRING, ChangeId BIGINT, Escalated BOOLEAN, ChangedAt TIMESTAMP"
    batches = [first, second, third, [("y", 900, False, at(300))], [("y", 901, False, at(400))]]
    got, totals = run(spark, tmp_path, schema, batches, streams.escalation_changes)
    want = [(f"k{i}", at(1)) for i in range(0, 100, 2)] + [("a", at(4)), ("a", at(9)), ("b", at(4)), ("k0", at(6))]
    assert got == sorted(want)
    # Left over: a and b, which stay escalated, and the last change of y that waits.
    assert max(totals) > 90 and totals[-1] <= 4


class Calls:
    """A state store in memory that counts what it is asked."""

    def __init__(self):
        self.n, self.values, self.maps, self.timers = 0, {}, {}, set()

    def getValueState(self, name, _):
        return Var(self, name)

    def getMapState(self, name, *_):
        return Var(self, name)

    def registerTimer(self, ms):
        self.n += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.n += 1
        self.timers.remove(ms)


class Var:
    def __init__(self, calls, name):
        self.calls, self.name = calls, name

    def get(self):
        self.calls.n += 1
        return self.calls.values.get(self.name)

    def update(self, value):
        self.calls.n += 1
        self.calls.values[self.name] = value

    def clear(self):
        self.calls.n += 1
        self.calls.values.pop(self.name, None)

    def getValue(self, key):
        self.calls.n += 1
        return self.calls.maps.get((self.name, key))

    def updateValue(self, key, value):
        self.calls.n += 1
        self.calls.maps[self.name, key] = value

    def removeKey(self, key):
        self.calls.n += 1
        del self.calls.maps[self.name, key]


class Now:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def fed(processor, batches):
    """What a processor emits for one key over (rows, watermark in ms), and its store."""
    store, got = Calls(), []
    processor.init(store)
    for rows, edge in batches:
        got += processor.handleInputRows(("k",), iter(rows), Now(edge))
        for ms in sorted(t for t in store.timers if t <= edge):
            got += processor.handleExpiredTimer(("k",), Now(edge), Now(ms))
            store.timers.remove(ms)
    return [r[1] for r in got], store


def shuffled_batches(rng, times, row):
    """Rows in batches, each row before the watermark has passed it."""
    start = round(START.timestamp() * 1000)
    batches = []
    for number in range(6):
        now = [t for k, t in enumerate(times) if max(0, min(int((t - START) / timedelta(days=2)), 5) - k % 2) == number]
        rng.shuffle(now)
        batches.append(([row(t) for t in now], start + (number * 2) * 86_400_000 - 86_400_000))
    return [*batches, ([], start + 90 * 86_400_000)]


@pytest.mark.parametrize("near", [4096, 5])
def test_guard_calls_per_batch_and_order_beyond_the_row(monkeypatch, near):
    monkeypatch.setattr(streams, "NEAR", near)
    rng = random.Random(near)
    times = [START + timedelta(seconds=rng.randrange(10 * 86_400), microseconds=rng.choice([0, 1, 250])) for _ in range(700)]
    got, store = fed(streams._guard_processor()(3_600_000_000 * 5), shuffled_batches(rng, times, lambda t: Row(SubscriberKey="k", EntryDate=t)))
    want = []
    for t in sorted(times):
        if not want or t >= want[-1] + timedelta(hours=5):
            want.append(t)
    assert got == want
    assert not store.values and not store.maps and not store.timers
    assert near < 4096 or store.n < 60


@pytest.mark.parametrize("near", [4096, 5])
def test_case_calls_per_batch_and_order_beyond_the_row(monkeypatch, near):
    monkeypatch.setattr(streams, "NEAR", near)
    rng = random.Random(near)
    times = [START + timedelta(seconds=rng.randrange(10 * 86_400) // 900 * 900) for _ in range(700)]
    ids = iter(range(10_000))
    made = []

    def row(t):
        made.append((t, next(ids), rng.random() < 0.4))
        return Row(CaseId="k", ChangeId=made[-1][1], Escalated=made[-1][2] or rng.choice([None, False]), ChangedAt=t)

    got, store = fed(streams._change_processor()(), shuffled_batches(rng, times, row))
    made.sort()
    assert got == [t for k, (t, _, now) in enumerate(made) if now and not (k and made[k - 1][2])]
    assert len(store.values) == made[-1][2] and not store.maps and not store.timers
    assert near < 4096 or store.n < 60


def plain_components(nodes, links):
    root = {n: n for n in nodes}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_grow_batch_by_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    nodes = [f"r{i:03}" for i in range(120)]
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(70)] + [(f"r{i:03}", f"r{i + 1:03}") for i in range(20, 60)] + [("r005", "r005"), ("x1", "x0")]
    rng.shuffle(links)
    table = KeyedTable(spark, str(tmp_path / "t"), ["RecordId"], buckets=3)
    for batch in range(3):
        records = spark.createDataFrame([(n,) for n in nodes[batch::3]], "RecordId STRING")
        own = spark.createDataFrame(links[batch::3], "Left STRING, Right STRING")
        moved = identity.fold_links(table, f"b{batch}", records, own)
        known = nodes[0::3] + (nodes[1::3] if batch else []) + (nodes[2::3] if batch > 1 else [])
        want = plain_components(known, [x for b in range(batch + 1) for x in links[b::3]])
        assert {r.RecordId: r.UnifiedIndividualId for r in table.read().collect()} == want
        assert moved.count() == moved.distinct().count()
    # Nothing new: nothing moves.
    assert identity.advance(table.read(), records, own).count() == 0
    full = identity.components(spark.createDataFrame([(n,) for n in want], "RecordId STRING"), spark.createDataFrame(links, "Left STRING, Right STRING"))
    assert {r.RecordId: r.UnifiedIndividualId for r in full.collect()} == want


def test_components_without_links(spark):
    records = spark.createDataFrame([("a",), ("b",)], "RecordId STRING")
    none = spark.createDataFrame([], "Left STRING, Right STRING")
    assert {tuple(r) for r in identity.components(records, none).collect()} == {("a", "a"), ("b", "b")}
    known = records.select("RecordId", F.col("RecordId").alias("UnifiedIndividualId"))
    assert identity.advance(known, records, none).count() == 0
