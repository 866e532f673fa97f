"""As-of lookups and lags against plain loops, with one key that holds most rows of one day."""

import bisect
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lifeloom.functions import asof

START = datetime(2026, 3, 5)


def made(seed):
    rng = random.Random(seed)
    when = lambda: START + timedelta(seconds=rng.randrange(86_400))
    far = lambda: START + timedelta(days=rng.randrange(-90, 90), seconds=rng.randrange(86_400))
    facts = [("hot", when(), i) for i in range(900)] + [(rng.choice(["a", "b", None]), far(), i) for i in range(900, 1300)]
    probes = [("hot", when(), i) for i in range(900)] + [(rng.choice(["a", "b", "hot", None]), far(), i) for i in range(900, 1300)]
    probes += [("hot", facts[i][1], 2000 + i) for i in range(40)] + [("hot", None, 3000), ("none", when(), 3001)]
    return facts, probes


@pytest.fixture
def hot(monkeypatch):
    monkeypatch.setattr(asof, "FLOOR", 200)


@pytest.mark.parametrize("seed", [1, 2])
def test_lookups_both_ways(spark, make, hot, seed):
    facts, probes = made(seed)
    text = lambda rows: [(k, t and t.isoformat(sep=" "), n) for k, t, n in rows]
    f, p = make("k STRING, s timestamp_ntz, v INT", text(facts)), make("k STRING, t timestamp_ntz, n INT", text(probes))
    lines = {}
    for k, t, v in facts:
        if k is not None:
            lines.setdefault(k, []).append((t, v))
    lines = {k: sorted(x) for k, x in lines.items()}
    want_before, want_after = {}, {}
    for k, t, n in probes:
        line = lines.get(k, []) if t is not None else []
        i = bisect.bisect_right(line, (t, 10**9)) if line else 0
        want_before[n] = line[i - 1][1] if i else None
        j = bisect.bisect_left(line, (t, -1)) if line else 0
        want_after[n] = line[j][1] if j < len(line) else None
    before = asof.latest_before(p, f, ["k"], "t", "s", ["v"])
    assert {r.n: r.v for r in before.collect()} == want_before
    assert {r.n: r.v for r in asof.earliest_after(p, f, ["k"], "t", "s", ["v"]).collect()} == want_after


def test_lag_over_hot_and_cold_keys(make, hot):
    facts, _ = made(3)
    df = make("k STRING, t timestamp_ntz, v INT", [(k, t.isoformat(sep=" "), v) for k, t, v in facts])
    want, last = {}, {}
    for k, t, v in sorted(facts, key=lambda r: (str(r[0]), r[1], r[2])):
        want[v] = last.get(k)
        last[k] = v
    assert {r.v: r.p for r in asof.previous_value(df, ["k"], "t", "v", "p", ["v"]).collect()} == want


def test_a_hot_day_spreads_over_many_slices(make, hot):
    facts, _ = made(4)
    df = make("k STRING, t timestamp_ntz, v INT", [(k, t.isoformat(sep=" "), v) for k, t, v in facts])
    sizes = {tuple(r.asDict().values()): r.n for r in asof.sliced(df, ["k"], "t", "month").groupBy("k", F.col("_slice.unit"), F.col("_slice.piece")).agg(F.count("*").alias("n")).collect()}
    own = [n for (k, *_), n in sizes.items() if k == "hot"]
    assert len(own) >= 8 and max(own) < sum(own) / 8
    assert len([1 for (k, *_), _ in sizes.items() if k == "a"]) <= 7  # months only


def test_no_hot_key(make):
    facts, probes = made(5)
    df = make("k STRING, t timestamp_ntz, v INT", [(k, t.isoformat(sep=" "), v) for k, t, v in facts])
    assert asof.sliced(df, ["k"], "t", "month").filter("_slice.piece <> 0").count() == 0
