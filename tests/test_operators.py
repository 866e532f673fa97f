"""Golden cases of the scenario tables, and invariants."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lifeloom.functions.asof import earliest_after, latest_before, previous_value
from lifeloom.functions.columns import norm_phone, split_path
from lifeloom.functions.ranking import positions
from lifeloom.functions.similarity import jaro_winkler_text, may_reach, letter_mask, prefix_keys, similar_pairs
from lifeloom.functions.times import days_between
from lifeloom.operators import carts, catalog, crm, forms, hygiene, identity, loyalty, monitors, orders, quality, recommend, winback
from lifeloom.session import scratch
from lifeloom.sources.registry import REGISTRY, TableDef, schema
from lifeloom.sources.tables import TableStore, upserted

NOW = "2026-07-25 12:00:00"
TS = "timestamp_ntz"


def pairs(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


SUBS = f"SubscriberKey STRING, EmailAddress STRING, FirstName STRING, EmailOptIn BOOLEAN, SubscriberStatus STRING, DateOfBirth DATE, LastModifiedDate {TS}"


def sub(key, opt_in=True, status="Active", dob=None, email=None):
    return (key, email or f"{key}@x.com", "N", opt_in, status, dob, None)


# -- carts --------------------------------------------------------------------------------
CARTS = f"CartId STRING, SubscriberKey STRING, CartStatus STRING, ItemCount BIGINT, CartLastUpdatedDate {TS}, RecoveredDate {TS}"


def test_cart_abandonment_cases(make):
    subs = make(SUBS, [sub("a"), sub("b", opt_in=False)])
    rows = [
        ("exact30", "a", "Active", 1, "2026-07-25 11:30:00", None),
        ("fresh", "a", "Active", 1, "2026-07-25 11:30:01", None),
        ("empty", "a", "Active", 0, "2026-07-25 10:00:00", None),
        ("optout", "b", "Active", 1, "2026-07-25 10:00:00", None),
        ("old", "a", "Active", 1, "2026-07-01 10:00:00", None),  # Abandoned, then Expired in one run
        ("stale", "b", "Abandoned", 1, "2026-07-11 12:00:00", None),
        ("paid", "a", "Converted", 1, "2026-07-01 10:00:00", None),
    ]
    once = carts.detect_abandoned(make(CARTS, rows), subs, NOW)
    want = [
        ("empty", "Active"), ("exact30", "Abandoned"), ("fresh", "Active"), ("old", "Expired"),
        ("optout", "Active"), ("paid", "Converted"), ("stale", "Expired"),
    ]
    assert pairs(once, "CartId", "CartStatus") == want
    assert pairs(carts.detect_abandoned(once, subs, NOW), "CartId", "CartStatus") == want


def test_cart_recovery_stamps_only_abandoned(make):
    df = make(CARTS, [("x", "a", "Abandoned", 1, NOW, None), ("y", "a", "Active", 1, NOW, None)])
    out = {r.CartId: r for r in carts.recover(df, make("CartId STRING", [("x",), ("y",)]), NOW).collect()}
    assert out["x"].CartStatus == out["y"].CartStatus == "Converted"
    assert out["x"].RecoveredDate is not None and out["y"].RecoveredDate is None


def test_fifty_requests_ten_codes(make):
    requests = make(
        f"RequestId STRING, SubscriberKey STRING, CampaignType STRING, RequestedDate {TS}",
        [(f"r{i:02}", f"s{i}", "AbandonedCart10", NOW) for i in range(50)],
    )
    pool = make(
        f"DiscountCode STRING, CampaignType STRING, IsUsed BOOLEAN, AllocatedToSubscriberKey STRING, AllocatedDate {TS}, ExpirationDate {TS}",
        [(f"C{i}", "AbandonedCart10", False, None, None, None) for i in range(10)] + [("USED", "AbandonedCart10", True, "z", None, None)],
    )
    out = carts.allocate_codes(requests, pool, NOW)
    given = [r.DiscountCode for r in out.collect() if r.Allocated]
    assert len(given) == len(set(given)) == 10
    assert out.filter("DiscountCode = 'CARTSAVE10' AND NOT Allocated").count() == 40
    marked = carts.mark_allocated(pool, out, NOW)
    assert marked.filter("IsUsed").count() == 11
    assert {r[0] for r in marked.filter("DiscountCode <> 'USED'").select("ExpirationDate").collect()} == {datetime(2026, 8, 1, 12)}


# -- loyalty, birthdays -----------------------------------------------------------------------
def test_loyalty_cases(make):
    members = make(
        f"SubscriberKey STRING, CurrentTier STRING, TrailingTwelveMonthSpend DECIMAL(18,2), PointsToNextTier DECIMAL(18,2), TierEffectiveDate {TS}, TierExpirationDate {TS}, LastRecalculatedDate {TS}",
        [("none", "Bronze", "9", None, None, None, None), ("gold", "Silver", "9", None, None, None, None), ("top", "Platinum", "9", None, None, None, None)],
    )
    bought = make(
        f"SubscriberKey STRING, OrderStatus STRING, OrderDate {TS}, OrderTotal DECIMAL(18,2)",
        [
            ("gold", "Delivered", "2026-07-01 00:00:00", "2400"),
            ("gold", "Returned", "2026-07-01 00:00:00", "9000"),
            ("gold", "Delivered", "2025-07-01 00:00:00", "9000"),
            ("top", "Delivered", "2026-07-01 00:00:00", "6000"),
            ("new", "Delivered", "2026-07-01 00:00:00", "500"),
        ],
    )
    out = {r.SubscriberKey: r for r in loyalty.recalculate_tiers(members, bought, NOW).collect()}
    assert (out["none"].CurrentTier, out["none"].PointsToNextTier) == ("Bronze", 500)
    assert (out["gold"].CurrentTier, out["gold"].PointsToNextTier) == ("Gold", 2600)
    assert out["gold"].TierEffectiveDate == datetime(2026, 7, 25, 12) and out["gold"].TierExpirationDate == datetime(2027, 7, 25, 12)
    assert out["top"].PointsToNextTier is None and out["top"].TierEffectiveDate is None
    assert pairs(loyalty.enroll(members, bought, NOW), "LoyaltyMemberId", "CurrentTier") == [("LOY-new", "Silver")]


def test_birthdays_once_a_year(make, spark):
    subs = make(SUBS, [sub("a", dob="1990-07-25"), sub("b", dob="1990-07-26"), sub("c", opt_in=False, dob="1990-07-25"), sub("d")])
    none = make("SubscriberKey STRING, CurrentTier STRING", [])
    log = make(f"SubscriberKey STRING, BirthdayYear INT, EnteredDate {TS}", [("a", 2025, NOW)])
    entries = loyalty.birthday_entries(subs, none, log, NOW)
    assert pairs(entries, "SubscriberKey", "CurrentTier", "BirthdayYear") == [("a", "Bronze", 2026)]
    again = log.unionByName(loyalty.birthday_log_rows(entries, NOW))
    assert loyalty.birthday_entries(subs, none, again, NOW).count() == 0
    # Late evening of the 24th in New York is already the 25th in UTC.
    assert loyalty.birthday_entries(subs, none, log, "2026-07-25 02:00:00", "America/New_York").count() == 0


# -- win-back -----------------------------------------------------------------------------------
EVENTS = f"SubscriberKey STRING, EventDate {TS}"


def test_inactivity_cases(make):
    subs = make(SUBS, [sub(k) for k in ("d90", "d45", "logged", "never")] + [sub("held", status="Held")])
    sent = make(EVENTS, [(k, "2025-01-01 00:00:00") for k in ("d90", "d45", "logged", "never", "held")])
    opens = make(EVENTS, [("d90", "2026-04-26 23:59:00"), ("d45", "2026-06-10 00:00:00"), ("logged", "2026-04-26 00:00:00"), ("held", "2026-01-01 00:00:00")])
    log = make(f"SubscriberKey STRING, InactivityTier STRING, EnteredDate {TS}", [("logged", "Tier1_90Day", NOW)])
    none = make(EVENTS, [])
    out = winback.inactive_entries(subs, sent, opens, none, log, NOW)
    assert pairs(out, "SubscriberKey", "InactivityTier", "DaysSinceEngagement") == [("d90", "Tier1_90Day", 90)]
    since_send = winback.inactive_entries(subs, sent, opens, none, log, NOW, never_engaged_from="first_send")
    assert ("never", "Sunset") in pairs(since_send, "SubscriberKey", "InactivityTier")


def test_sunset_needs_silence_and_the_series(make):
    subs = make(SUBS, [sub("quiet"), sub("back"), sub("unfinished")])
    log = make(f"SubscriberKey STRING, InactivityTier STRING, EnteredDate {TS}", [(k, "Sunset", "2026-07-01 00:00:00") for k in ("quiet", "back", "unfinished")])
    opens = make(EVENTS, [("back", "2026-07-02 00:00:00"), ("quiet", "2026-06-01 00:00:00")])
    done = make("SubscriberKey STRING", [("quiet",), ("back",)])
    updated, consent = winback.sunset(subs, log, opens, make(EVENTS, []), NOW, series_done=done)
    assert pairs(updated.filter("SubscriberStatus = 'Sunset' AND NOT EmailOptIn"), "SubscriberKey") == [("quiet",)]
    assert pairs(consent, "SubscriberKey", "ConsentSource") == [("quiet", "WinbackSunsetPolicy")]
    with pytest.raises(ValueError):
        winback.sunset(subs, log, opens, opens, NOW)


def test_final_winback_step_keeps_one_row(make):
    log = make(f"SubscriberKey STRING, InactivityTier STRING, EnteredDate {TS}", [("a", "Tier1_90Day", "2026-01-01 00:00:00"), ("a", "Tier2_180Day", "2026-04-01 00:00:00"), ("b", "Tier1_90Day", NOW)])
    out = winback.log_sunset(log, make("SubscriberKey STRING", [("a",)]))
    assert pairs(out, "SubscriberKey", "InactivityTier", "EnteredDate")[0] == ("a", "Sunset", datetime(2026, 1, 1))
    assert out.count() == 2


# -- catalog ----------------------------------------------------------------------------------------
PRODUCT = f"SKU STRING, ProductName STRING, Price DECIMAL(18,2), InStock BOOLEAN, InventoryCount BIGINT, LastSyncedDate {TS}"
STAGED = "SKU STRING, ProductName STRING, Price DECIMAL(18,2), InStock BOOLEAN, InventoryCount BIGINT"


def test_catalog_reject_promote_guard(make):
    live = make(PRODUCT, [("keep", "Old", "5", True, 3, None), ("gone", "Gone", "5", True, 3, None), ("bad", "Bad", "5", True, 3, None)])
    feed = make(STAGED, [("keep", "New", "6", True, 9), ("bad", "X", None, True, 1), ("fresh", "F", "1", True, 1), (None, "?", "1", True, 1), ("nul", "N", "1", True, None)])
    log = catalog.rejected(feed, NOW)
    out = catalog.promoted(live, feed, NOW)
    assert log.count() == 3 and log.count() + feed.filter(catalog.valid_row()).count() == feed.count()
    assert pairs(out, "SKU", "ProductName", "InStock") == [("bad", "Bad", True), ("fresh", "F", True), ("gone", "Gone", False), ("keep", "New", True)]
    history = make("MetricName STRING, MetricValue STRING", [(catalog.METRIC, "10")])
    with pytest.raises(catalog.AnomalyError):
        catalog.guard(out, history, NOW)
    assert catalog.guard(out, history.filter("false"), NOW).first().MetricValue == "3"
    assert catalog.guard_log(catalog.row_count_check(out, history), NOW).first().Severity == "Critical"


# -- CRM, suppression, erasure --------------------------------------------------------------------------
def test_crm_suppression_round_trip(make):
    prefs = make(f"SubscriberKey STRING, PromotionalOptIn BOOLEAN, LastUpdated {TS}, UpdateSource STRING", [("a", True, None, "P"), ("own", False, None, "P")])
    bridge = make("UnifiedIndividualId STRING, SubscriberKey STRING", [("1", "a"), ("2", "own")])
    contacts = make("Id STRING, DoNotMarket BOOLEAN", [("1", False), ("2", False)])
    case = "ContactId STRING, Escalated BOOLEAN, Status STRING"
    off = crm.promotional_suppression(prefs, bridge, contacts, make(case, [("1", True, "Open")]), NOW)
    assert pairs(off, "SubscriberKey", "PromotionalOptIn") == [("a", False), ("own", False)]
    on = crm.promotional_suppression(off, bridge, contacts, make(case, [("1", True, "Closed")]), NOW)
    assert pairs(on, "SubscriberKey", "PromotionalOptIn") == [("a", True), ("own", False)]


def test_suppression_ignores_case_and_takes_strongest_reason(make):
    subs = make(SUBS, [sub("a", email="Jane@X.com"), sub("b", email="other@x.com")])
    listed = make("EmailAddress STRING, SuppressionReason STRING", [(" jane@x.COM", "HardBounce"), ("JANE@x.com", "LegalOptOut")])
    out = hygiene.apply_suppression(subs, listed, NOW)
    assert pairs(out, "SubscriberKey", "SubscriberStatus", "EmailOptIn") == [("a", "Unsubscribed", False), ("b", "Active", True)]
    assert hygiene.apply_suppression(out, listed, NOW).exceptAll(out).count() == 0


def test_erasure_covers_linked_keys(make):
    subs = make(SUBS, [sub("a"), sub("a2"), sub("b")])
    bridge = make("UnifiedIndividualId STRING, SubscriberKey STRING", [("u", "a"), ("u", "a2"), ("v", "b")])
    prefs = make("SubscriberKey STRING", [("a",), ("a2",), ("b",)])
    log = make(f"ConsentLogId STRING, SubscriberKey STRING, IPAddress STRING, Timestamp {TS}", [("1", "a", "10.0.0.1", NOW), ("2", "b", "10.0.0.2", NOW)])
    listed = make("EmailAddress STRING, SuppressionReason STRING", [])
    out = hygiene.erase({"subscribers": subs, "preferences": prefs, "consent_log": log, "suppression": listed}, make("SubscriberKey STRING", [("a",)]), NOW, bridge)
    assert pairs(out["preferences"], "SubscriberKey") == [("b",)]
    assert out["subscribers"].filter("EmailAddress LIKE 'erased-%'").count() == 2
    assert out["consent_log"].filter("IPAddress IS NOT NULL").count() == 1
    assert out["suppression"].filter("EmailAddress LIKE 'sha256:%'").count() == 2


# -- monitors, quality, forms, recommendations -------------------------------------------------------------
def test_guardrail_actions(make):
    days = make(
        "IpPool STRING, SendDate DATE, SentCount BIGINT, BounceCount BIGINT, ComplaintCount BIGINT",
        [
            ("hold", "2026-07-01", 1000, 8, 0), ("hold", "2026-07-02", 5000, 55, 2), ("hold", "2026-07-03", 5000, 120, 6),
            ("roll", "2026-07-01", 1000, 30, 0), ("roll", "2026-07-02", 2000, 60, 0), ("roll", "2026-07-03", 4000, 0, 0),
            ("calm", "2026-07-01", 0, 0, 0),
        ],
    )
    out = {r.IpPool: r for r in monitors.next_action(days).collect()}
    assert out["hold"].Action == "HOLD_FLAT" and out["hold"].Reason == "latest day over a limit: bounces 2.40%, complaints 0.120%"
    assert (out["roll"].Action, out["roll"].RollbackToVolume) == ("ROLLBACK", 2000)
    assert out["calm"].Action == "PROCEED"


def test_signup_batch(make):
    subs = make(SUBS, [sub("a", email="known@x.com")])
    batch = make("SubmissionId STRING, EmailAddress STRING, FirstName STRING", [("1", "New@x.com", "A"), ("2", "new@x.com ", "B"), ("3", "KNOWN@x.com", "C"), ("4", "broken", "D")])
    out = forms.apply_signups(subs, batch, NOW, "5000011")
    assert pairs(out["subscribers"], "EmailAddress", "FirstName") == [("New@x.com", "A")]
    assert out["consent_log"].count() == out["events"].count() == 1


def test_cross_sell_never_offers_what_was_bought(make):
    products = make("SKU STRING, ProductName STRING, Category STRING, Price DECIMAL(18,2), SalePrice DECIMAL(18,2), InStock BOOLEAN, AvgRating DECIMAL(18,1)", [(f"w{i}", "n", "Womens", "1", "0", i != 3, "4.0") for i in range(6)])
    lines = make("OrderId STRING, LineItemId STRING, SKU STRING, Category STRING", [("o", "1", "w0", "Womens"), ("o", "2", "w1", "Womens")] + [("all", str(i), f"w{i}", "Womens") for i in range(6)])
    out = recommend.cross_sell(lines, make("OrderId STRING", [("o",), ("all",), ("bare",)]), products)
    assert pairs(out, "OrderId", "SKU") == [("bare", "w0"), ("bare", "w1"), ("bare", "w2"), ("bare", "w4"), ("o", "w2"), ("o", "w4"), ("o", "w5")]


def test_overdue_orders(make):
    df = make(f"OrderId STRING, SubscriberKey STRING, OrderStatus STRING, EstimatedDeliveryDate {TS}", [("1", "a", "Confirmed", "2026-07-26 12:00:00"), ("2", "a", "Confirmed", "2026-07-26 12:00:01"), ("3", "a", "Shipped", "2026-07-24 12:00:00"), ("4", "a", "Shipped", NOW), ("5", "a", "Confirmed", None)])
    assert pairs(orders.overdue_events(df, NOW), "OrderId", "FallbackEventType") == [("1", "APIEvent-OrderShipped"), ("3", "APIEvent-OrderDelivered")]


# -- building blocks -----------------------------------------------------------------------------------------
def test_store_versions_and_upsert(make, spark):
    store = TableStore(spark, scratch(spark, "test"))
    store.upsert("t", make("K STRING, A STRING, B INT", [("x", "1", 1), ("y", "2", 2)]), ["K"])
    out = store.upsert("t", make("K STRING, A STRING", [("x", "9"), ("z", None)]), ["K"])
    assert sorted(map(tuple, out.collect())) == [("x", "9", 1), ("y", "2", 2), ("z", None, None)]
    assert store.version("t") == 2
    store.append("log", make("K STRING", [("a",)]), ["K"])
    assert store.append("log", make("K STRING", [("a",), ("b",)]), ["K"]).count() == 2
    later = upserted(make("K STRING, N INT", [("x", 1)]), make("K STRING, N INT, T INT", [("x", 2, 1), ("x", 3, 2)]), ["K"], latest="T")
    assert pairs(later, "K", "N") == [("x", 3)]


def test_positions_are_gap_free_for_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    out = positions(df, ["g"], [F.col("id").desc()]).filter("g = 'hot'").select("Position", "id").orderBy("Position").collect()
    assert [r.Position for r in out] == list(range(1, len(out) + 1))
    assert [r.id for r in out] == sorted((r.id for r in out), reverse=True)


def test_asof_lookups_match_brute_force(make, spark):
    import random

    rng = random.Random(7)
    stamp = lambda: datetime(2026, rng.randint(1, 6), rng.randint(1, 28), rng.randint(0, 23))
    facts = [(rng.choice("aab"), stamp(), i) for i in range(300)]
    probes = [(rng.choice("aabc"), stamp(), i) for i in range(200)] + [("a", None, 999)]
    f = spark.createDataFrame(facts, "k STRING, at timestamp_ntz, v INT")
    p = spark.createDataFrame(probes, "k STRING, t timestamp_ntz, id INT")
    back = {r.id: r.v for r in latest_before(p, f, ["k"], "t", "at", ["v"]).collect()}
    ahead = {r.id: r.v for r in earliest_after(p, f, ["k"], "t", "at", ["v"]).collect()}
    for k, t, i in probes:
        before = [(at, v) for fk, at, v in facts if t is not None and fk == k and at <= t]
        after = [(at, v) for fk, at, v in facts if t is not None and fk == k and at >= t]
        assert back[i] == (max(before)[1] if before else None)
        assert ahead[i] == (min(after)[1] if after else None)
    lagged = previous_value(f, ["k"], "at", "v", "before", ["v"])
    for k in "ab":
        rows = [r for r in lagged.filter(F.col("k") == k).orderBy("at", "v").collect()]
        assert [r.before for r in rows] == [None] + [r.v for r in rows[:-1]]


def test_days_count_midnights(spark):
    a, b = F.lit("2026-01-01 23:59:00").cast(TS), F.lit("2026-01-02 00:01:00").cast(TS)
    assert spark.range(1).select(days_between(a, b)).first()[0] == 1


def test_split_is_even_and_stable(spark):
    df = spark.range(1000).select(split_path(F.col("id"), F.lit("s")).alias("a"))
    assert abs(df.filter("a").count() - 500) <= 45


def test_phone_forms(make):
    df = make("P STRING", [("(555) 123-4567",), ("+1 555 123 4567",), ("",), (None,), ("+44 20 7946 0958",)])
    got = {r[0] for r in df.select(norm_phone("P")).collect()}
    assert got == {"+15551234567", None, "+442079460958"}


def _names(seed):
    import random

    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdestz") for _ in range(rng.randint(1, 7))) for _ in range(260)]
    names += [n[1:] for n in names[:60] if len(n) > 4] + [n[1] + n[0] + n[2:] for n in names[:60] if len(n) > 1]
    names += ["".join(rng.choice("ab") for _ in range(rng.randint(8, 14))) for _ in range(40)] + ["Jörg", "jörg", "müller", "mülller"]
    return sorted(set(names))


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.95])
def test_similar_names_share_a_key(threshold):
    import itertools

    names = _names(3)
    keys = {n: set(prefix_keys(n, threshold)) for n in names}
    near = [(a, b) for a, b in itertools.combinations(names, 2) if jaro_winkler_text(a, b) >= threshold]
    assert any(a[0] != b[0] for a, b in near)
    for a, b in near:
        common = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(len(a), len(b), 4))
        assert any(p == common for p, _ in keys[a] & keys[b]), (a, b)


@pytest.mark.parametrize("tile", [3, 500])
def test_similar_pairs_are_all_pairs_above_the_threshold(spark, tile):
    names = _names(5)
    df = spark.createDataFrame([(n, i, g) for g in "xy" for i, n in enumerate(names) if g == "x" or i % 3] + [(None, 900, "x"), ("", 901, "x")], "n STRING, i INT, g STRING")
    df = df.withColumn("k", F.concat_ws("-", "g", "i"))
    got = {tuple(r) for r in similar_pairs(df, df, ["g"], "n", "k", 0.9, tile).collect()}
    want = {(f"{g}-{i}", f"{g}-{j}") for g in "xy" for i, a in enumerate(names) for j, b in enumerate(names)
            if (g == "x" or (i % 3 and j % 3)) and jaro_winkler_text(a, b) >= 0.9}
    assert got == want


def test_letter_bound_never_cuts_a_pair(spark):
    names = _names(7)
    df = spark.createDataFrame([(n, letter_mask(n)) for n in names], "n STRING, m LONG")
    pairs = df.join(df.selectExpr("n AS o", "m AS p"), F.col("n") < F.col("o"))
    cut = pairs.filter(~may_reach(F.col("n"), F.col("o"), F.col("m"), F.col("p"), 0.9)).select("n", "o").collect()
    assert cut and all(jaro_winkler_text(a, b) < 0.9 for a, b in cut)


def test_jaro_winkler_known_values():
    assert jaro_winkler_text("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert jaro_winkler_text("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert jaro_winkler_text("abc", "xyz") == 0.0


RECORD = "RecordId STRING, Source STRING, SourceKey STRING, EmailAddress STRING, MobileNumber STRING, FirstName STRING, LastName STRING, PostalCode STRING, MailingAddress STRING, UpdatedAt DATE, BusinessUnitMID STRING"


def test_identity_chain_and_survivors(make):
    rows = [
        ("M1", "MC_Subscribers", "1", "a@x.com", "555 123 4567", "Jonathan", "Smithson", "1", None, "2020-01-01", "5"),
        ("S1", "SF_Contacts", "u1", "A@X.com", None, "Jon", "S", "2", "Street", "2021-01-01", "5"),
        ("P1", "POS_Customers", "p1", None, "+15551234567", "Jon", "S", "3", "Shop", "2022-01-01", "5"),
        ("P2", "POS_Customers", "p2", None, None, "Jonathon", "Smithson", "1", "Shop", "2019-01-01", "5"),
        ("M2", "MC_Subscribers", "2", "b@x.com", None, "Zoe", "Quill", "1", None, "2020-01-01", "5"),
    ] + [(f"H{i:03}", "POS_Customers", f"h{i}", "shared@x.com", None, None, None, None, None, "2020-01-01", "5") for i in range(200)]
    records = make(RECORD, rows)
    links, people = identity.resolve(records)
    found = {r.RecordId: r.UnifiedIndividualId for r in people.collect()}
    assert found["M1"] == found["S1"] == found["P1"] == found["P2"] == "M1"
    assert found["M2"] == "M2" and {found[f"H{i:03}"] for i in range(200)} == {"H000"}
    assert links.count() == 199 + 3
    gold = {r.UnifiedIndividualId: r for r in identity.survivors(records, people).collect()}
    assert (gold["M1"].EmailAddress, gold["M1"].MailingAddress, gold["M1"].PostalCode) == ("a@x.com", "Street", "3")
    bridge = identity.bridge_rows(records, people, links, NOW)
    assert pairs(bridge, "UnifiedIndividualId", "SubscriberKey") == [("M1", "1")]


def test_hot_name_block_is_tiled_without_loss(make, monkeypatch):
    monkeypatch.setattr(identity, "TILE", 7)
    rows = [(f"R{i:03}", "POS_Customers", str(i), None, None, "Maria", "Gar" + "".join("abcde"[int(d)] for d in f"{i % 5}{i // 5 % 5}{i // 25 % 5}"), "1", None, "2020-01-01", "5") for i in range(60)]
    got = {(r.Left, r.Right) for r in identity.name_links(make(RECORD, rows)).collect()}
    want = {(a[0], b[0]) for i, a in enumerate(rows) for b in rows[i + 1:] if jaro_winkler_text(a[6].lower(), b[6].lower()) >= 0.9}
    assert got == want


def test_registry_shapes():
    assert len(REGISTRY) >= 35 and schema("orders")["OrderTotal"].dataType.simpleString() == "decimal(18,2)"
    assert REGISTRY["identity_bridge"].key == ["UnifiedIndividualId", "BusinessUnitMID"]
    assert schema("subscribers")["DateOfBirth"].dataType.simpleString() == "date"
    assert schema("preferences")["CategoryMens"].dataType.simpleString() == "boolean"
    assert schema("order_lines")["Category"].dataType.simpleString() == "string"
    doc = {"name": "t", "fields": [{"name": "A", "type": "Decimal", "scale": 4, "isPrimaryKey": True}, {"name": "B", "type": "Odd"}]}
    parsed = TableDef.from_definition(doc)
    assert parsed.schema()["A"].dataType.simpleString() == "decimal(18,4)" and parsed.schema()["B"].dataType.simpleString() == "string"


def test_checks_are_empty_on_clean_tables(make):
    subs = make(SUBS, [sub("a")])
    tables = {"subscribers": subs, "preferences": make("SubscriberKey STRING", [("a",)]), "suppression": make("EmailAddress STRING", [("z@x.com",)])}
    assert quality.all_checks(tables, NOW).count() == 0
