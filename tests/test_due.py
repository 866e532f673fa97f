"""The win-back series run by run against the cohort as a whole."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from lifeloom.plans import journeys
from lifeloom.plans.due import DueTable, advance_winback, winback_rows

START = datetime(2026, 1, 1)


def made(make, seed):
    rng = random.Random(seed)
    text = lambda t: t.isoformat(sep=" ")
    when = lambda span: START + timedelta(hours=rng.randrange(24 * span))
    entries = [(f"s{i}", text(when(60))) for i in range(150)]
    event = "SubscriberKey STRING, EventDate timestamp_ntz"
    opens = [(f"s{rng.randrange(200)}", text(when(130) - timedelta(days=10))) for _ in range(160)]
    # On the very hour of a check, and of an entry.
    opens += [(k, text(datetime.fromisoformat(t) + timedelta(days=d))) for k, t in entries[:9] for d in (14,)] + [entries[9]]
    clicks = [(f"s{rng.randrange(200)}", text(when(130))) for _ in range(40)]
    leaves = [(f"s{i}", text(when(120))) for i in range(0, 150, 6)] + [(entries[10][0], entries[10][1])]
    return (
        make("SubscriberKey STRING, EntryDate timestamp_ntz", entries), make(event, opens), make(event, clicks),
        make("SubscriberKey STRING, LeftDate timestamp_ntz", leaves),
    )


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("SubscriberKey", "EntryDate", "EmailsSent", "Outcome").collect())))


@pytest.mark.parametrize("step", [12, 60])
def test_replay_gives_the_cohort(spark, make, tmp_path, step):
    entries, opens, clicks, leaves = made(make, 2)
    due = DueTable(spark, str(tmp_path / "d"))
    day, run = -1, 0
    while day < 119:
        until = min(day + step, 119)
        span = [str(START + timedelta(days=d)) for d in (day, until)]
        advance_winback(due, run, entries, opens, clicks, *span, leaves=leaves)
        day, run = until, run + 1
        if step > 12 or until in (35, 71, 119):
            now = str(START + timedelta(days=until))
            whole = journeys.winback(entries.filter(f"EntryDate <= '{now}'"), opens, clicks, now, leaves)
            assert rows(winback_rows(due, run, now)) == rows(whole)
    # The last run once more: the same result, not twice.
    before = rows(winback_rows(due, run, now))
    advance_winback(due, run - 1, entries, opens, clicks, *span, leaves=leaves)
    assert rows(winback_rows(due, run, now)) == before
    assert {p.name for p in Path(due.path).glob("due/_run=0/*")} >= {"_due=2026-01-15"}


def test_a_run_reads_the_folders_of_its_days(spark, make, tmp_path):
    entries, opens, clicks, _ = made(make, 3)
    due = DueTable(spark, str(tmp_path / "d"))
    advance_winback(due, 0, entries, opens, clicks, "2025-12-31 00:00:00", "2026-03-02 00:00:00")
    plan = due.take(1, "2026-03-02 00:00:00", "2026-03-04 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_due" in plan.split("PartitionFilters: [")[1].split("]")[0]
