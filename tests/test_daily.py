"""Daily bitmaps against the reports over the event history."""

from pyspark.sql import functions as F

from lifeloom.operators import daily, reports

DAYS = [f"2026-01-{d:02}" for d in range(1, 5)]


def views(make, rng):
    def some(n, *more):
        rows = [(rng.randrange(3), f"s{rng.randrange(40)}", f"{rng.choice(DAYS)} {rng.randrange(24):02}:00:00") for _ in range(n)]
        return [(*r, *(rng.choice(m) for m in more)) for r in rows]

    plain = "JobID BIGINT, SubscriberKey STRING, EventDate timestamp_ntz"
    named = ["EMAIL_CART_01", "EMAIL_VIP_1", "x"]
    mail = lambda n: make(f"{plain}, EmailName STRING", some(n, named) + [(1, None, "2026-01-02 00:00:00", "x")])
    return (mail(300), mail(200), mail(90), make(f"{plain}, BounceCategory STRING", some(60, ["Hard", "Soft", None])), make(plain, some(9)), make(plain, some(9)))


def rows(df):
    return sorted(str(tuple(r.asDict()[c] for c in sorted(r.asDict()))) for r in df.collect())


def test_same_counts_and_a_day_needs_only_its_events(spark, make, tmp_path):
    import random

    sent, *rest = views(make, random.Random(6))
    sent = sent.filter("SubscriberKey IS NOT NULL")  # the history counts a send to nobody, the bitmaps do not
    every = (sent, *rest)
    reach = daily.DailyReach(spark, str(tmp_path / "r"))
    for day in DAYS:
        # A night sees the events of its own day alone.
        own = [v.filter(F.to_date("EventDate") == day) for v in every]
        reach.fold(daily.event_kinds(*own), day, day)
    now = "2026-01-05 00:00:00"
    since = F.lit("2026-01-02").cast("date")
    assert rows(daily.campaign_performance(reach.reach(since))) == rows(reports.campaign_performance(*every, as_of=now, days=3))
    assert rows(daily.click_rate_by_journey(reach.reach(since))) == rows(reports.click_rate_by_journey(*every, as_of=now, days=3))
    assert rows(daily.deliverability(reach.reach(since), "u")) == rows(reports.deliverability(every[0], every[3], every[5], now, "u", days=3))
    numbers = [r.Number for r in reach.numbers.read().collect()]
    assert sorted(numbers) == list(range(len(numbers)))
    # A day that is folded again replaces itself.
    before = rows(daily.campaign_performance(reach.reach(since)))
    reach.fold(daily.event_kinds(*every), DAYS[2], DAYS[2])
    assert rows(daily.campaign_performance(reach.reach(since))) == before


def test_days_without_events(spark, make, tmp_path):
    import random

    every = [v.filter("false") for v in views(make, random.Random(1))]
    reach = daily.DailyReach(spark, str(tmp_path / "r"))
    reach.fold(daily.event_kinds(*every), DAYS[0], DAYS[-1])
    assert daily.campaign_performance(reach.reach(F.lit(DAYS[0]).cast("date"))).count() == 0
