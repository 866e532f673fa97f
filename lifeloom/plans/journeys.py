"""Journeys as cohort-outcome queries.

A journey is a fixed tree of waits and checks, so the outcome of a whole cohort is one
query: derive every checkpoint time from the entry time, look up each check as of its
checkpoint, and take the first exit.  A checkpoint later than ``as_of`` is not due yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lifeloom.functions.asof import earliest_after, latest_before
from lifeloom.functions.columns import joined, split_path
from lifeloom.functions.times import Moment, as_ts, stamp

WAITING = "WAITING"
LEFT = "EXIT-CRITERIA"


def after(moment: Column, amount: int, unit: str) -> Column:
    return moment + F.expr(f"INTERVAL '{amount}' {unit.upper()}")


# -- shared parts ---------------------------------------------------------------------
def new_entries(candidates: DataFrame, in_flight: DataFrame, key: list[str], reentry: bool = False) -> DataFrame:
    """Candidates that may enter: one per key, and (unless re-entry is allowed) none already inside."""
    rest = [c for c in candidates.columns if c not in key]
    first = candidates.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct("EntryDate", *rest)).alias("_c"))
    unique = first.select(*key, "_c.*").select(*candidates.columns)
    if reentry:
        return unique
    return unique.join(in_flight.select(*key), key, "left_anti")


def wait_due(rows: DataFrame, start: str, amount: int, unit: str, as_of: Moment) -> DataFrame:
    """Rows whose wait is over, with the time it ended."""
    due = after(F.col(start), amount, unit)
    return rows.withColumn("DueDate", due).filter(F.col("DueDate") <= as_ts(as_of))


def decision(branches: list[tuple[Column, str]], otherwise: str) -> Column:
    """Name of the first branch that holds, else the last one."""
    expr = None
    for condition, name in branches:
        condition = F.coalesce(condition, F.lit(False))
        expr = F.when(condition, name) if expr is None else expr.when(condition, name)
    return expr.otherwise(otherwise)


def exists_since(probes: DataFrame, events: DataFrame, start: str, until: str, event_ts: str, name: str) -> DataFrame:
    """Probes with a flag: some event of the subscriber in [start, until]."""
    found = earliest_after(probes, events.select("SubscriberKey", event_ts), ["SubscriberKey"], start, event_ts)
    return found.withColumn(name, F.coalesce(F.col(event_ts) <= F.col(until), F.lit(False))).drop(event_ts)


def event_or_timeout(
    waiting: DataFrame, events: DataFrame, key: str, start: str, days: int, name: str
) -> DataFrame:
    """First matching event at or after ``start`` if it came within ``days``, else NULL."""
    hits = events.select(key, F.col("EventDate").alias(name))
    found = earliest_after(waiting, hits, [key], start, name)
    return found.withColumn(name, F.when(F.col(name) <= after(F.col(start), days, "day"), F.col(name)))


def random_split(entries: DataFrame, journey: str, share: int = 50) -> DataFrame:
    """Variant A or B, fixed for a contact, journey and entry."""
    salt = joined(journey, "|", F.date_format("EntryDate", "yyyyMMddHHmmss"))
    return entries.withColumn("Variant", F.when(split_path(F.col("SubscriberKey"), salt, share), "A").otherwise("B"))


def holdout(df: DataFrame, key: str, salt: str, share: int = 10) -> DataFrame:
    """About ``share`` percent of keys become the holdout, the rest the treatment."""
    return df.withColumn(
        "Path", F.when(split_path(F.col(key), F.lit(salt), share), "Holdout").otherwise("Treatment")
    )


def assignment_rows(
    split: DataFrame, journey: str, test_name: str, emails: dict[str, str], as_of: Moment
) -> DataFrame:
    """Assignment log rows, to be written before any message goes out."""
    email = F.when(F.col("Variant") == "A", emails["A"]).otherwise(emails["B"])
    return split.select(
        joined(journey, "-", F.col("SubscriberKey"), "-", stamp(as_of)).alias("TestId"),
        F.lit(journey).alias("JourneyKey"),
        "SubscriberKey",
        F.lit(test_name).alias("TestName"),
        "Variant",
        as_ts(as_of).alias("EntryDate"),
        email.alias("EmailNameSent"),
    )


def leave_times(consent_log: DataFrame) -> DataFrame:
    """When each subscriber first opted out: from then on no journey continues."""
    return (
        consent_log.filter(F.col("ConsentAction") == "OptOut")
        .groupBy("SubscriberKey")
        .agg(F.min("Timestamp").alias("LeftDate"))
    )


def exit_sweep(in_flight: DataFrame, leaves: DataFrame, checkpoint: str) -> DataFrame:
    """In-flight rows that have not left by the checkpoint."""
    gone = leaves.select("SubscriberKey", "LeftDate")
    return (
        in_flight.join(gone, "SubscriberKey", "left")
        .filter(F.col("LeftDate").isNull() | (F.col("LeftDate") > F.col(checkpoint)))
        .drop("LeftDate")
    )


def goal_reached(entries: DataFrame, orders: DataFrame, days: int = 14) -> DataFrame:
    """Entries with a first purchase within ``days``."""
    probes = entries.withColumn("_until", after(F.col("EntryDate"), days, "day"))
    return exists_since(probes, orders, "EntryDate", "_until", "OrderDate", "GoalReached").drop("_until")


def _send(kind: str, key: str, at: Column, sent: Column) -> Column:
    row = F.struct(F.lit(kind).alias("Channel"), F.lit(key).alias("TemplateKey"), at.alias("SendDate"))
    return F.when(F.coalesce(sent, F.lit(False)), row)


def _sends(*sends: Column) -> Column:
    return F.filter(F.array(*sends), lambda s: s.isNotNull()).alias("Sends")


def send_rows(outcome: DataFrame, key: list[str], classification: str = "Promotional") -> DataFrame:
    """One outbox row per message of an outcome."""
    return outcome.select(*key, F.explode("Sends").alias("_s")).select(
        *key, "_s.*", F.lit(classification).alias("Classification")
    )


def _with_leave(entries: DataFrame, leaves: DataFrame | None) -> DataFrame:
    if leaves is None:
        return entries.withColumn("LeftDate", F.lit(None).cast("timestamp_ntz"))
    return entries.join(leaves.select("SubscriberKey", "LeftDate"), "SubscriberKey", "left")


class _Steps:
    """First exit along a series of checkpoints."""

    def __init__(self, as_of: Moment):
        self.now = as_ts(as_of)
        self.expr: Column | None = None

    def exit(self, condition: Column, name: str) -> "_Steps":
        condition = F.coalesce(condition, F.lit(False))
        self.expr = F.when(condition, name) if self.expr is None else self.expr.when(condition, name)
        return self

    def checkpoint(self, at: Column) -> "_Steps":
        return self.exit(self.now < at, WAITING).exit(F.col("LeftDate") <= at, LEFT)

    def end(self, name: str) -> Column:
        return self.expr.otherwise(name)


# -- outcomes --------------------------------------------------------------------------
def welcome(
    entries: DataFrame,
    subscribers: DataFrame,
    opens: DataFrame,
    orders: DataFrame,
    as_of: Moment,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """+1 h channel, +73 h opened, +169 h purchased."""
    flags = subscribers.select("SubscriberKey", "EmailOptIn", "SMSOptIn")
    opened = (
        opens.filter(F.col("EmailName") == "EMAIL_WELCOME_01")
        .groupBy("SubscriberKey")
        .agg(F.min("EventDate").alias("_opened"))
    )
    base = _with_leave(entries.select("SubscriberKey", "EntryDate"), leaves)
    base = base.join(flags, "SubscriberKey", "left").join(opened, "SubscriberKey", "left")
    base = earliest_after(base, orders.select("SubscriberKey", "OrderDate"), ["SubscriberKey"], "EntryDate", "OrderDate")
    entry = F.col("EntryDate")
    first, second, third = after(entry, 1, "hour"), after(entry, 73, "hour"), after(entry, 169, "hour")
    steps = _Steps(as_of)
    steps.exit(steps.now < first, WAITING)
    steps.exit(~F.coalesce("EmailOptIn", F.lit(False)) | (F.col("LeftDate") <= first), "EXIT-SUPPRESSED")
    steps.checkpoint(second).checkpoint(third)
    steps.exit(F.col("OrderDate") <= third, "EXIT-CONVERTED")
    done = base.withColumn("Outcome", steps.end("EXIT-COMPLETE"))
    now = as_ts(as_of)
    got1 = (now >= first) & (F.col("Outcome") != "EXIT-SUPPRESSED")
    got2 = got1 & (now >= second) & (F.col("LeftDate").isNull() | (F.col("LeftDate") > second))
    got3 = F.col("Outcome") == "EXIT-COMPLETE"
    engaged = F.coalesce(F.col("_opened") <= second, F.lit(False))
    return done.select(
        "SubscriberKey",
        "EntryDate",
        F.when(got1, F.when(F.col("SMSOptIn"), "Email+SMS").otherwise("EmailOnly")).alias("ChannelPath"),
        F.when(got2, F.when(engaged, "Browse").otherwise("Reminder")).alias("SecondEmail"),
        "Outcome",
        _sends(
            _send("Email", "EMAIL_WELCOME_01", first, got1),
            _send("SMS", "SMS_WELCOME_01", first, got1 & F.col("SMSOptIn")),
            _send("Email", "EMAIL_WELCOME_02_BROWSE", second, got2 & engaged),
            _send("Email", "EMAIL_WELCOME_02_REMINDER", second, got2 & ~engaged),
            _send("Email", "EMAIL_WELCOME_03_LOYALTY", third, got3),
        ),
    )


def _states_at(
    entries: DataFrame, key: str, history: DataFrame, ts: str, status: str, hours: list[int]
) -> DataFrame:
    """Entries plus the status at each checkpoint: one as-of pass for all of them."""
    points = F.explode(F.array(*[F.struct(F.lit(h).alias("_h"), after(F.col("EntryDate"), h, "hour").alias("_at")) for h in hours]))
    probes = entries.select("*", points.alias("_p")).select(*entries.columns, "_p._h", "_p._at")
    found = latest_before(probes, history.select(key, ts, status), [key], "_at", ts, [status])
    return found.groupBy(*entries.columns).agg(
        *[F.max(F.when(F.col("_h") == h, F.col(status))).alias(f"_at{h}") for h in hours]
    )


def abandoned_cart(
    entries: DataFrame,
    cart_history: DataFrame,
    subscribers: DataFrame,
    as_of: Moment,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """Checks at 0, +24 h, +26 h (SMS only) and +72 h; any status but Abandoned ends the series."""
    hours = [0, 24, 26, 72]
    base = _states_at(entries.select("CartId", "SubscriberKey", "EntryDate"), "CartId", cart_history, "StatusDate", "CartStatus", hours)
    base = _with_leave(base, leaves).join(subscribers.select("SubscriberKey", "SMSOptIn"), "SubscriberKey", "left")
    at = {h: after(F.col("EntryDate"), h, "hour") for h in hours}
    open_ = {h: F.coalesce(F.col(f"_at{h}") == "Abandoned", F.lit(False)) for h in hours}
    sms = F.coalesce("SMSOptIn", F.lit(False))
    steps = _Steps(as_of)
    steps.checkpoint(at[0]).exit(~open_[0], "EXIT-CONVERTED-EARLY")
    steps.checkpoint(at[24]).exit(~open_[24], "EXIT-CONVERTED-MID")
    steps.exit(sms & (steps.now < at[26]), WAITING).exit(sms & (F.col("LeftDate") <= at[26]), LEFT)
    steps.exit(sms & ~open_[26], "EXIT-CONVERTED-MID")
    steps.checkpoint(at[72]).exit(~open_[72], "EXIT-CONVERTED-LATE")
    done = base.withColumn("Outcome", steps.end("EXIT-SERIES-COMPLETE"))
    now = as_ts(as_of)

    def here(h: int) -> Column:
        return open_[h] & (now >= at[h]) & (F.col("LeftDate").isNull() | (F.col("LeftDate") > at[h]))

    got1 = here(0)
    got2 = got1 & here(24)
    texted = got2 & sms & here(26)
    got3 = got2 & (~sms | texted) & here(72)
    return done.select(
        "CartId",
        "SubscriberKey",
        "EntryDate",
        (got1.cast("int") + got2.cast("int") + got3.cast("int")).cast("bigint").alias("EmailsSent"),
        texted.alias("SmsSent"),
        "Outcome",
        _sends(
            _send("Email", "EMAIL_CART_01_REMINDER", at[0], got1),
            _send("Email", "EMAIL_CART_02_DISCOUNT10", at[24], got2),
            _send("SMS", "SMS_CART_RECOVERY", at[26], texted),
            _send("Email", "EMAIL_CART_03_DISCOUNT15", at[72], got3),
        ),
    )


def _order_dates(base: DataFrame, events: dict[str, DataFrame]) -> DataFrame:
    """``base`` with ShippedDate, DeliveredDate and the first return of its order.

    Entries and events meet in one exchange by order; windows and groups below keep that partitioning.
    """
    tagged = None
    for kind, df in events.items():
        rows = df.filter(F.col("OrderId").isNotNull()).select(F.col("OrderId").alias("_order"), "EventDate", F.lit(kind).alias("_kind"))
        tagged = rows if tagged is None else tagged.unionByName(rows)

    def first(kind: str, since: Column | None = None, days: int = 0) -> Column:
        fits = F.col("_kind") == kind
        if since is not None:
            fits = fits & (F.col("EventDate") >= since) & (F.col("EventDate") <= after(since, days, "day"))
        return F.min(F.when(fits, F.col("EventDate")))

    kept = base.columns
    # Equal entries are one row with their number, so that each of them comes out again.
    counted = base.repartition("OrderId").groupBy(*kept).agg(F.count(F.lit(1)).alias("_copies"))
    key = [*kept, "_copies"]
    lines = counted.join(tagged, F.col("OrderId") == F.col("_order"), "left")
    lines = lines.withColumn("ShippedDate", first("shipped", F.col("EntryDate"), 10).over(W.partitionBy(*key)))
    dated = lines.groupBy(*key, "ShippedDate").agg(
        first("delivered", F.col("ShippedDate"), 14).alias("DeliveredDate"), first("returned").alias("_returned")
    )
    return dated.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).drop("_copies", "_copy")


def post_purchase(
    entries: DataFrame,
    shipped: DataFrame,
    delivered: DataFrame,
    returned: DataFrame,
    as_of: Moment,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """Shipped within 10 d, delivered within 14 d of that, not returned 5 d later, cross-sell 2 d later.

    Keyed by (SubscriberKey, OrderId): two orders of one contact never mix.
    """
    base = _with_leave(entries.select("SubscriberKey", "OrderId", "EntryDate"), leaves)
    base = _order_dates(base, {"shipped": shipped, "delivered": delivered, "returned": returned})
    review = after(F.col("DeliveredDate"), 5, "day")
    cross = after(F.col("DeliveredDate"), 7, "day")
    gone = F.col("LeftDate")
    steps = _Steps(as_of)
    ship, deliver, now = F.col("ShippedDate"), F.col("DeliveredDate"), steps.now
    known_ship = ship.isNotNull() & (ship <= now)
    known_deliver = deliver.isNotNull() & (deliver <= now)
    ship_limit, deliver_limit = after(F.col("EntryDate"), 10, "day"), after(ship, 14, "day")
    steps.exit(gone <= F.when(known_ship, ship).otherwise(F.least(now, ship_limit)), LEFT)
    steps.exit(~known_ship & (now < ship_limit), WAITING).exit(~known_ship, "EXIT-SHIP-TIMEOUT")
    steps.exit(gone <= F.when(known_deliver, deliver).otherwise(F.least(now, deliver_limit)), LEFT)
    steps.exit(~known_deliver & (now < deliver_limit), WAITING).exit(~known_deliver, "EXIT-DELIVERY-TIMEOUT")
    steps.checkpoint(review).exit(F.col("_returned") <= review, "EXIT-RETURNED")
    steps.checkpoint(cross)
    done = base.withColumn("Outcome", steps.end("EXIT-COMPLETE"))

    def reached(at: Column) -> Column:
        return (now >= at) & (gone.isNull() | (gone > at))

    kept = F.col("_returned").isNull() | (F.col("_returned") > review)
    return done.select(
        "SubscriberKey",
        "OrderId",
        "EntryDate",
        "ShippedDate",
        "DeliveredDate",
        "Outcome",
        _sends(
            _send("Email", "EMAIL_PP_02_SHIPPING", ship, reached(ship)),
            _send("Email", "EMAIL_PP_03_DELIVERED", deliver, reached(deliver)),
            _send("Email", "EMAIL_PP_04_REVIEW", review, reached(review) & kept),
            _send("Email", "EMAIL_PP_05_CROSSSELL", cross, F.col("Outcome") == "EXIT-COMPLETE"),
        ),
    )


BIRTHDAY_JOURNEY = "JOURNEY_BIRTHDAY_LOYALTY"
BIRTHDAY_TEST = "Birthday Creative Test"
BIRTHDAY_EMAILS = {"A": "EMAIL_BIRTHDAY_VARIANT_A", "B": "EMAIL_BIRTHDAY_VARIANT_B"}


def birthday(split: DataFrame, as_of: Moment, leaves: DataFrame | None = None) -> DataFrame:
    """Entries with their variant to a single message."""
    base = _with_leave(split, leaves)
    entry = F.col("EntryDate")
    done = base.withColumn("Outcome", _Steps(as_of).checkpoint(entry).end("EXIT-COMPLETE"))
    sent = F.col("Outcome") == "EXIT-COMPLETE"
    return done.select(
        "SubscriberKey",
        "EntryDate",
        "Variant",
        "Outcome",
        _sends(
            _send("Email", BIRTHDAY_EMAILS["A"], entry, sent & (F.col("Variant") == "A")),
            _send("Email", BIRTHDAY_EMAILS["B"], entry, sent & (F.col("Variant") == "B")),
        ),
    )


def winback(
    entries: DataFrame,
    opens: DataFrame,
    clicks: DataFrame,
    as_of: Moment,
    leaves: DataFrame | None = None,
) -> DataFrame:
    """Messages at 0, +14 and +28 d; each check looks from its own message to its checkpoint (+14, +28, +58 d)."""
    starts, ends = [0, 14, 28], [14, 28, 58]
    events = opens.select("SubscriberKey", "EventDate").unionByName(clicks.select("SubscriberKey", "EventDate"))
    base = entries.select("SubscriberKey", "EntryDate")
    points = F.explode(
        F.array(*[F.struct(F.lit(d).alias("_d"), after(F.col("EntryDate"), d, "day").alias("_from")) for d in starts])
    )
    probes = base.select("*", points.alias("_p")).select(*base.columns, "_p._d", "_p._from")
    found = earliest_after(probes, events, ["SubscriberKey"], "_from", "EventDate")
    wide = found.groupBy(*base.columns).agg(
        *[F.min(F.when(F.col("_d") == d, F.col("EventDate"))).alias(f"_next{d}") for d in starts]
    )
    wide = _with_leave(wide, leaves)
    steps = _Steps(as_of)
    due = [after(F.col("EntryDate"), d, "day") for d in ends]
    for start, at in zip(starts, due):
        steps.checkpoint(at).exit(F.col(f"_next{start}") <= at, "EXIT-REENGAGED")
    done = wide.withColumn("Outcome", steps.end("EXIT-SUNSET-PENDING"))
    now = as_ts(as_of)

    def present(at: Column) -> Column:
        return (now >= at) & (F.col("LeftDate").isNull() | (F.col("LeftDate") > at))

    quiet = [F.col(f"_next{s}").isNull() | (F.col(f"_next{s}") > at) for s, at in zip(starts, due)]
    got1 = present(F.col("EntryDate"))
    got2 = got1 & present(due[0]) & quiet[0]
    got3 = got2 & present(due[1]) & quiet[1]
    return done.select(
        "SubscriberKey",
        "EntryDate",
        (got1.cast("int") + got2.cast("int") + got3.cast("int")).cast("bigint").alias("EmailsSent"),
        "Outcome",
        _sends(
            _send("Email", "EMAIL_WINBACK_01", F.col("EntryDate"), got1),
            _send("Email", "EMAIL_WINBACK_02_INCENTIVE", due[0], got2),
            _send("Email", "EMAIL_WINBACK_03_SUNSET", due[1], got3),
        ),
    )


def vip(entries: DataFrame, orders: DataFrame, as_of: Moment, leaves: DataFrame | None = None) -> DataFrame:
    """One message; purchased within 14 d = retained, else concierge."""
    base = _with_leave(entries.select("SubscriberKey", "EntryDate"), leaves)
    base = earliest_after(base, orders.select("SubscriberKey", "OrderDate"), ["SubscriberKey"], "EntryDate", "OrderDate")
    due = after(F.col("EntryDate"), 14, "day")
    steps = _Steps(as_of).checkpoint(due).exit(F.col("OrderDate") <= due, "EXIT-RETAINED")
    here = (as_ts(as_of) >= F.col("EntryDate")) & (F.col("LeftDate").isNull() | (F.col("LeftDate") > F.col("EntryDate")))
    return base.select(
        "SubscriberKey",
        "EntryDate",
        steps.end("EXIT-ESCALATE-CONCIERGE").alias("Outcome"),
        _sends(_send("Email", "EMAIL_VIP_RETENTION", F.col("EntryDate"), here)),
    )


def case_escalation(entries: DataFrame, case_history: DataFrame, as_of: Moment) -> DataFrame:
    """Acknowledged at once; after 48 h a survey if closed, else an internal alert.  Transactional: no opt-out check."""
    base = _states_at(
        entries.select("CaseId", "SubscriberKey", "EntryDate"), "CaseId", case_history, "StatusDate", "Status", [48]
    ).withColumn("LeftDate", F.lit(None).cast("timestamp_ntz"))
    due = after(F.col("EntryDate"), 48, "hour")
    closed = F.coalesce(F.col("_at48") == "Closed", F.lit(False))
    steps = _Steps(as_of).checkpoint(due).exit(closed, "EXIT-COMPLETE")
    return base.select(
        "CaseId",
        "SubscriberKey",
        "EntryDate",
        steps.end("EXIT-ESCALATED-INTERNAL").alias("Outcome"),
        _sends(
            _send("Email", "EMAIL_CASE_ACK", F.col("EntryDate"), as_ts(as_of) >= F.col("EntryDate")),
            _send("Email", "EMAIL_CASE_SURVEY", due, (as_ts(as_of) >= due) & closed),
        ),
    )


def internal_alerts(case_outcome: DataFrame) -> DataFrame:
    """Alert row for every case still open after 48 h."""
    return case_outcome.filter(F.col("Outcome") == "EXIT-ESCALATED-INTERNAL").select(
        F.lit("support-manager").alias("Channel"),
        "CaseId",
        F.lit("Case escalated 48h ago, still open").alias("Message"),
    )
