"""Work that must not grow faster than its results."""

import itertools
import random
from collections import defaultdict

import pytest

from lifeloom.functions.similarity import PREFIX_LIMIT, jaro_winkler_text, length_plan, pairs_within, paired_keys


def made_names(number, seed):
    rng = random.Random(seed)
    names = {"".join(rng.choice("aeioulnrst") for _ in range(rng.choice([4, 5, 6, 6, 6, 7]))) for _ in range(number)}
    names |= {"mc" + n for n in sorted(names)[::5]} | {n + "s" for n in sorted(names)[::7]}
    return sorted(names)


def common(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y or i == PREFIX_LIMIT), min(len(a), len(b), PREFIX_LIMIT))


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.95])
def test_near_names_share_a_key_of_their_lengths(threshold):
    names = made_names(500, 1)
    lengths = sorted({len(n) for n in names})
    cells = [defaultdict(set) for _ in range(PREFIX_LIMIT + 1)]
    for n in names:
        for p in range(min(len(n), PREFIX_LIMIT) + 1):
            for key in paired_keys(n, p, length_plan(len(n), lengths, p, threshold)):
                other, letters = key.split("|", 1)
                cells[p][n].add((n[:p], letters, min(len(n), int(other)), max(len(n), int(other)), len(n)))
    near = [(a, b) for a, b in itertools.combinations(names, 2) if jaro_winkler_text(a, b) >= threshold]
    assert near
    for a, b in near:
        p = common(a, b)
        assert {k[:4] for k in cells[p][a] if k[4] == len(a)} & {k[:4] for k in cells[p][b] if k[4] == len(b)}, (a, b)


def test_names_that_meet_are_few(spark):
    """In one block of names that all begin alike, what meets under keys stays near what is alike."""
    names = ["mc" + n for n in made_names(3000, 2) if not n.startswith("mc")]
    lengths = sorted({len(n) for n in names})
    here, met = defaultdict(list), set()
    for n in names:
        for key in paired_keys(n, 2, length_plan(len(n), lengths, 2, 0.9)):
            other, letters = key.split("|", 1)
            here[letters, len(n), int(other)].append(n)
    for (letters, own, other), some in here.items():
        met |= {(a, b) for a in some for b in here.get((letters, other, own), ()) if a < b}
    alike = sum(jaro_winkler_text(a, b) >= 0.9 for a, b in met)
    assert alike and len(met) < len(names) ** 2 / 2 / 15


@pytest.mark.parametrize("tile", [1, 4, 500])
def test_pairs_within_a_table_are_all_pairs(spark, tile):
    names = made_names(60, 3) + ["annette", "annetta", "anette", "a", "ab", "abc"]
    rows = [(f"{g}{i}", n, g, i % 4 != 1, i % 5 != 2) for g in "xy" for i, n in enumerate(names)] + [("z", None, "x", True, True), ("e", "", "x", True, True)]
    df = spark.createDataFrame(rows, "k STRING, n STRING, g STRING, _left BOOLEAN, _right BOOLEAN")
    got = [tuple(r) for r in pairs_within(df, ["g"], "n", "k", 0.9, tile, once=True).collect()]
    want = {(a[0], b[0]) for a in rows for b in rows if a[1] and b[1] and a[2] == b[2] and a[3] and b[4] and a[0] < b[0] and jaro_winkler_text(a[1], b[1]) >= 0.9}
    assert want and sorted(got) == sorted(want)


def test_a_run_looks_at_the_events_once(spark, make, tmp_path, monkeypatch):
    from lifeloom.plans import due

    calls, plain = [], due.exists_since
    monkeypatch.setattr(due, "exists_since", lambda *args: calls.append(1) or plain(*args))
    entries = make("SubscriberKey STRING, EntryDate TIMESTAMP_NTZ", [("a", "2026-01-01"), ("b", "2026-01-01"), ("c", "2026-01-01"), ("d", "2026-02-27")])
    events = make("SubscriberKey STRING, EventDate TIMESTAMP_NTZ", [("a", "2026-01-05"), ("b", "2026-01-20")])
    table = due.DueTable(spark, str(tmp_path / "d"))
    due.advance_winback(table, 0, entries, events, events.limit(0), "2025-12-31 00:00:00", "2026-03-01 00:00:00")
    got = sorted((r.SubscriberKey, r.EmailsSent, r.Outcome) for r in due.winback_rows(table, 1, "2026-03-01 00:00:00").collect())
    assert got == [("a", 1, "EXIT-REENGAGED"), ("b", 2, "EXIT-REENGAGED"), ("c", 3, "EXIT-SUNSET-PENDING"), ("d", 1, "WAITING")]
    assert len(calls) == 1


def test_a_part_is_one_batch_of_several_tasks(spark, tmp_path):
    from lifeloom.streaming.events import run_foreach
    from lifeloom.workload.base import Tables
    from lifeloom.workload.streams import in_batches

    rows = spark.range(40, numPartitions=4).selectExpr("id AS event_id", "timestamp_ntz '2026-01-01' AS ts")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    seen = []
    handle = lambda df, number: seen.append((number, sorted(r.event_id % 2 for r in df.collect()), df.rdd.getNumPartitions()))
    in_batches(Tables(spark, str(tmp_path)), 2, "event_id % 2", lambda source: run_foreach(source, handle, str(tmp_path / "c")))
    assert [(n, kinds) for n, kinds, _ in seen] == [(0, [0] * 20), (1, [1] * 20)]
    assert all(tasks > 1 for *_, tasks in seen)
