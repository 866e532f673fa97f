"""Queries for journey parts and journey outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lifeloom.functions.times import as_ts
from lifeloom.plans import journeys
from lifeloom.plans.due import DueTable, advance_winback, winback_rows
from lifeloom.session import scratch
from lifeloom.workload.base import query
from lifeloom.workload.jobs import E_TS, O_TS
from lifeloom.workload.views import EVENTS_NOW, ORDERS_NOW

# -- shared parts ------------------------------------------------------------------------


@query(
    "jny_entry_guard",
    """SELECT SubscriberKey, min(EntryDate) AS EntryDate FROM {signup_entries}
       WHERE SubscriberKey NOT IN (SELECT SubscriberKey FROM {carts} WHERE CartStatus = 'Active' AND ItemCount >= 9) GROUP BY 1""",
)
def _(t):
    inside = t.carts.filter("CartStatus = 'Active' AND ItemCount >= 9")
    return journeys.new_entries(t.signup_entries, inside, ["SubscriberKey"])


@query(
    "jny_wait_due",
    f"SELECT SubscriberKey, EntryDate, EntryDate + INTERVAL 73 HOUR AS DueDate FROM {{signup_entries}} WHERE EntryDate + INTERVAL 73 HOUR <= {E_TS}",
)
def _(t):
    return journeys.wait_due(t.signup_entries, "EntryDate", 73, "hour", EVENTS_NOW)


@query(
    "jny_decision_split",
    """SELECT SubscriberKey, CASE WHEN EmailOptIn AND SMSOptIn THEN 'Email+SMS' WHEN EmailOptIn AND NOT SMSOptIn THEN 'EmailOnly' ELSE 'Suppressed' END AS Branch
       FROM {subscribers}""",
)
def _(t):
    email, sms = F.col("EmailOptIn"), F.col("SMSOptIn")
    branch = journeys.decision([(email & sms, "Email+SMS"), (email & ~sms, "EmailOnly")], "Suppressed")
    return t.subscribers.select("SubscriberKey", branch.alias("Branch"))


@query(
    "jny_exists_check",
    """SELECT e.SubscriberKey, e.EntryDate, EXISTS (SELECT 1 FROM {opens} o WHERE o.SubscriberKey = e.SubscriberKey
              AND o.EventDate BETWEEN e.EntryDate AND e.EntryDate + INTERVAL 3 DAY) AS Opened FROM {signup_entries} e""",
)
def _(t):
    probes = t.signup_entries.withColumn("_until", F.col("EntryDate") + F.expr("INTERVAL 3 DAY"))
    return journeys.exists_since(probes, t.opens, "EntryDate", "_until", "EventDate", "Opened").drop("_until")


SHIP_SQL = """SELECT e.SubscriberKey, e.OrderId, e.EntryDate, CASE WHEN s <= e.EntryDate + INTERVAL 10 DAY THEN s END AS ShippedDate FROM (
    SELECT e.SubscriberKey, e.OrderId, e.EntryDate, min(s.EventDate) AS s FROM {order_entries} e
    LEFT JOIN {shipped} s ON s.OrderId = e.OrderId AND s.EventDate >= e.EntryDate GROUP BY 1, 2, 3) e"""


@query("jny_event_or_timeout", SHIP_SQL)
def _(t):
    return journeys.event_or_timeout(t.order_entries, t.shipped, "OrderId", "EntryDate", 10, "ShippedDate")


def md5_split(salt: str, share: int) -> str:
    return f"CAST('0x' || substring(md5(SubscriberKey || '|' || {salt}), 1, 8) AS BIGINT) % 100 < {share}"


SPLIT = f"CASE WHEN {md5_split(chr(39) + journeys.BIRTHDAY_JOURNEY + '|' + chr(39) + ' || strftime(EntryDate, ' + chr(39) + '%Y%m%d%H%M%S' + chr(39) + ')', 50)} THEN 'A' ELSE 'B' END"


def split(t):
    return journeys.random_split(t.signup_entries, journeys.BIRTHDAY_JOURNEY)


@query("jny_random_split", f"SELECT SubscriberKey, EntryDate, {SPLIT} AS Variant FROM {{signup_entries}}")
def _(t):
    return split(t)


@query(
    "jny_log_assignment",
    f"""SELECT '{journeys.BIRTHDAY_JOURNEY}-' || SubscriberKey || '-20240131000000' AS TestId, SubscriberKey, v AS Variant,
               CASE WHEN v = 'A' THEN 'EMAIL_BIRTHDAY_VARIANT_A' ELSE 'EMAIL_BIRTHDAY_VARIANT_B' END AS EmailNameSent
        FROM (SELECT SubscriberKey, {SPLIT} AS v FROM {{signups}}) x""",
)
def _(t):
    chosen = journeys.random_split(t.signups, journeys.BIRTHDAY_JOURNEY)
    rows = journeys.assignment_rows(
        chosen, journeys.BIRTHDAY_JOURNEY, journeys.BIRTHDAY_TEST, journeys.BIRTHDAY_EMAILS, EVENTS_NOW
    )
    return rows.select("TestId", "SubscriberKey", "Variant", "EmailNameSent")


@query(
    "jny_exit_sweep",
    """SELECT e.SubscriberKey, e.EntryDate, e.EntryDate + INTERVAL 7 DAY AS CheckDate FROM {signup_entries} e
       LEFT JOIN (SELECT SubscriberKey, min(Timestamp) AS x FROM {consent_log} WHERE ConsentAction = 'OptOut' GROUP BY 1) l ON l.SubscriberKey = e.SubscriberKey
       WHERE x IS NULL OR x > e.EntryDate + INTERVAL 7 DAY""",
)
def _(t):
    rows = t.signup_entries.withColumn("CheckDate", F.col("EntryDate") + F.expr("INTERVAL 7 DAY"))
    return journeys.exit_sweep(rows, journeys.leave_times(t.consent_log), "CheckDate")


@query(
    "jny_goal",
    """SELECT e.SubscriberKey, e.EntryDate, EXISTS (SELECT 1 FROM {event_orders} o WHERE o.SubscriberKey = e.SubscriberKey
              AND o.OrderDate BETWEEN e.EntryDate AND e.EntryDate + INTERVAL 14 DAY) AS GoalReached FROM {signup_entries} e""",
)
def _(t):
    return journeys.goal_reached(t.signup_entries, t.event_orders)


# -- outcomes ----------------------------------------------------------------------------
WELCOME_SQL = f"""SELECT SubscriberKey, EntryDate, CASE WHEN g1 THEN CASE WHEN SMSOptIn THEN 'Email+SMS' ELSE 'EmailOnly' END END AS ChannelPath,
      CASE WHEN g1 AND {E_TS} >= t2 AND (x IS NULL OR x > t2) THEN CASE WHEN coalesce(op <= t2, FALSE) THEN 'Browse' ELSE 'Reminder' END END AS SecondEmail, Outcome
    FROM (SELECT *, {E_TS} >= t1 AND Outcome <> 'EXIT-SUPPRESSED' AS g1 FROM (
      SELECT *, CASE WHEN {E_TS} < t1 THEN 'WAITING' WHEN NOT EmailOptIn OR x <= t1 THEN 'EXIT-SUPPRESSED' WHEN {E_TS} < t2 THEN 'WAITING' WHEN x <= t2 THEN 'EXIT-CRITERIA'
               WHEN {E_TS} < t3 THEN 'WAITING' WHEN x <= t3 THEN 'EXIT-CRITERIA' WHEN ord <= t3 THEN 'EXIT-CONVERTED' ELSE 'EXIT-COMPLETE' END AS Outcome FROM (
        SELECT e.SubscriberKey, e.EntryDate, s.EmailOptIn, s.SMSOptIn, l.LeftDate AS x, o.op, e.EntryDate + INTERVAL 1 HOUR AS t1, e.EntryDate + INTERVAL 73 HOUR AS t2,
               e.EntryDate + INTERVAL 169 HOUR AS t3, (SELECT min(OrderDate) FROM {{event_orders}} p WHERE p.SubscriberKey = e.SubscriberKey AND p.OrderDate >= e.EntryDate) AS ord
        FROM {{signup_entries}} e LEFT JOIN {{subscribers}} s ON s.SubscriberKey = e.SubscriberKey LEFT JOIN {{leaves}} l ON l.SubscriberKey = e.SubscriberKey
        LEFT JOIN (SELECT SubscriberKey, min(EventDate) AS op FROM {{opens}} WHERE EmailName = 'EMAIL_WELCOME_01' GROUP BY 1) o ON o.SubscriberKey = e.SubscriberKey) a) b) c"""


def welcome(t):
    return journeys.welcome(t.signup_entries, t.subscribers, t.opens, t.event_orders, EVENTS_NOW, t.leaves)


@query("out_welcome", WELCOME_SQL)
def _(t):
    return welcome(t).drop("Sends")


@query(
    "jny_send_emit",
    f"""SELECT SubscriberKey, EntryDate, Channel, TemplateKey, SendDate, 'Promotional' AS Classification FROM (
          SELECT SubscriberKey, EntryDate, 'Email' AS Channel, 'EMAIL_WELCOME_01' AS TemplateKey, EntryDate + INTERVAL 1 HOUR AS SendDate FROM ({WELCOME_SQL}) w WHERE ChannelPath IS NOT NULL
          UNION ALL SELECT SubscriberKey, EntryDate, 'SMS', 'SMS_WELCOME_01', EntryDate + INTERVAL 1 HOUR FROM ({WELCOME_SQL}) w WHERE ChannelPath = 'Email+SMS'
          UNION ALL SELECT SubscriberKey, EntryDate, 'Email', 'EMAIL_WELCOME_02_' || upper(SecondEmail), EntryDate + INTERVAL 73 HOUR FROM ({WELCOME_SQL}) w WHERE SecondEmail IS NOT NULL
          UNION ALL SELECT SubscriberKey, EntryDate, 'Email', 'EMAIL_WELCOME_03_LOYALTY', EntryDate + INTERVAL 169 HOUR FROM ({WELCOME_SQL}) w WHERE Outcome = 'EXIT-COMPLETE') s""",
)
def _(t):
    return journeys.send_rows(welcome(t), ["SubscriberKey", "EntryDate"])


def cart_state(h: int) -> str:
    return (
        f"coalesce((SELECT arg_max(CartStatus, (StatusDate, CartStatus)) FROM {{user_history}} h WHERE h.CartId = e.CartId "
        f"AND h.StatusDate <= e.EntryDate + INTERVAL {h} HOUR) = 'Abandoned', FALSE) AS s{h}"
    )


@query(
    "out_abandoned_cart",
    f"""SELECT CartId, SubscriberKey, EntryDate, Outcome, CAST(g1 AS BIGINT) + CAST(g2 AS BIGINT) + CAST(g2 AND (NOT sms OR tx) AND s72 AND n >= t72 AND (x IS NULL OR x > t72) AS BIGINT) AS EmailsSent,
               tx AS SmsSent FROM (
          SELECT *, g2 AND sms AND s26 AND n >= t26 AND (x IS NULL OR x > t26) AS tx FROM (
            SELECT *, g1 AND s24 AND n >= t24 AND (x IS NULL OR x > t24) AS g2 FROM (
              SELECT *, s0 AND n >= EntryDate AND (x IS NULL OR x > EntryDate) AS g1,
                CASE WHEN n < EntryDate THEN 'WAITING' WHEN x <= EntryDate THEN 'EXIT-CRITERIA' WHEN NOT s0 THEN 'EXIT-CONVERTED-EARLY'
                     WHEN n < t24 THEN 'WAITING' WHEN x <= t24 THEN 'EXIT-CRITERIA' WHEN NOT s24 THEN 'EXIT-CONVERTED-MID'
                     WHEN sms AND n < t26 THEN 'WAITING' WHEN sms AND x <= t26 THEN 'EXIT-CRITERIA' WHEN sms AND NOT s26 THEN 'EXIT-CONVERTED-MID'
                     WHEN n < t72 THEN 'WAITING' WHEN x <= t72 THEN 'EXIT-CRITERIA' WHEN NOT s72 THEN 'EXIT-CONVERTED-LATE' ELSE 'EXIT-SERIES-COMPLETE' END AS Outcome
              FROM (SELECT e.*, {cart_state(0)}, {cart_state(24)}, {cart_state(26)}, {cart_state(72)}, coalesce(p.SMSOptIn, FALSE) AS sms, l.LeftDate AS x, {E_TS} AS n,
                           e.EntryDate + INTERVAL 24 HOUR AS t24, e.EntryDate + INTERVAL 26 HOUR AS t26, e.EntryDate + INTERVAL 72 HOUR AS t72
                    FROM {{cart_entries}} e LEFT JOIN {{subscribers}} p ON p.SubscriberKey = e.SubscriberKey LEFT JOIN {{leaves}} l ON l.SubscriberKey = e.SubscriberKey) a) b) c) d""",
)
def _(t):
    out = journeys.abandoned_cart(t.cart_entries, t.user_history, t.subscribers, EVENTS_NOW, t.leaves)
    return out.drop("Sends")


@query(
    "out_post_purchase",
    f"""SELECT SubscriberKey, OrderId, EntryDate, ShippedDate, DeliveredDate,
          CASE WHEN ShippedDate IS NULL AND {O_TS} < EntryDate + INTERVAL 10 DAY THEN 'WAITING' WHEN ShippedDate > {O_TS} THEN 'WAITING' WHEN ShippedDate IS NULL THEN 'EXIT-SHIP-TIMEOUT'
               WHEN DeliveredDate IS NULL AND {O_TS} < ShippedDate + INTERVAL 14 DAY THEN 'WAITING' WHEN DeliveredDate > {O_TS} THEN 'WAITING' WHEN DeliveredDate IS NULL THEN 'EXIT-DELIVERY-TIMEOUT'
               WHEN {O_TS} < DeliveredDate + INTERVAL 5 DAY THEN 'WAITING' WHEN r <= DeliveredDate + INTERVAL 5 DAY THEN 'EXIT-RETURNED'
               WHEN {O_TS} < DeliveredDate + INTERVAL 7 DAY THEN 'WAITING' ELSE 'EXIT-COMPLETE' END AS Outcome
        FROM (SELECT s.*, r.r, CASE WHEN d.d <= ShippedDate + INTERVAL 14 DAY THEN d.d END AS DeliveredDate FROM ({SHIP_SQL}) s
          LEFT JOIN (SELECT s.OrderId AS o, s.EntryDate AS e, min(v.EventDate) AS d FROM ({SHIP_SQL}) s JOIN {{delivered}} v ON v.OrderId = s.OrderId AND v.EventDate >= s.ShippedDate GROUP BY 1, 2) d
            ON d.o = s.OrderId AND d.e = s.EntryDate
          LEFT JOIN (SELECT OrderId, min(EventDate) AS r FROM {{returned}} GROUP BY 1) r ON r.OrderId = s.OrderId) x""",
)
def _(t):
    return journeys.post_purchase(t.order_entries, t.shipped, t.delivered, t.returned, ORDERS_NOW).drop("Sends")


@query(
    "out_birthday",
    f"""SELECT e.SubscriberKey, e.EntryDate, Variant, CASE WHEN x.LeftDate <= e.EntryDate THEN 'EXIT-CRITERIA' ELSE 'EXIT-COMPLETE' END AS Outcome
        FROM (SELECT SubscriberKey, EntryDate, {SPLIT} AS Variant FROM {{signup_entries}}) e LEFT JOIN {{leaves}} x ON x.SubscriberKey = e.SubscriberKey""",
)
def _(t):
    return journeys.birthday(split(t), EVENTS_NOW, t.leaves).drop("Sends")


def next_event(a: int, b: int) -> str:
    return (
        f"EXISTS (SELECT 1 FROM ev WHERE ev.SubscriberKey = e.SubscriberKey AND ev.EventDate >= e.EntryDate + INTERVAL {a} DAY "
        f"AND ev.EventDate <= e.EntryDate + INTERVAL {b} DAY) AS r{b}"
    )


WINBACK_SQL = f"""WITH ev AS (SELECT * FROM {{old_opens}} UNION ALL SELECT * FROM {{old_clicks}}),
          c AS (SELECT e.*, {next_event(0, 14)}, {next_event(14, 28)}, {next_event(28, 58)}, {O_TS} AS n FROM {{old_entries}} e)
        SELECT SubscriberKey, EntryDate, CAST(n >= EntryDate AS BIGINT) + CAST(n >= EntryDate + INTERVAL 14 DAY AND NOT r14 AS BIGINT)
                 + CAST(n >= EntryDate + INTERVAL 28 DAY AND NOT r14 AND NOT r28 AS BIGINT) AS EmailsSent,
          CASE WHEN n < EntryDate + INTERVAL 14 DAY THEN 'WAITING' WHEN r14 THEN 'EXIT-REENGAGED' WHEN n < EntryDate + INTERVAL 28 DAY THEN 'WAITING' WHEN r28 THEN 'EXIT-REENGAGED'
               WHEN n < EntryDate + INTERVAL 58 DAY THEN 'WAITING' WHEN r58 THEN 'EXIT-REENGAGED' ELSE 'EXIT-SUNSET-PENDING' END AS Outcome FROM c"""


@query(
    "out_winback",
    WINBACK_SQL,
)
def _(t):
    return journeys.winback(t.old_entries, t.old_opens, t.old_clicks, ORDERS_NOW).drop("Sends")


@query("out_winback_due", WINBACK_SQL)
def _(t):
    # What was before, then 60 days in four runs; each reads the rows that fell due in it and a month of events.
    due = DueTable(t.spark, scratch(t.spark, "due"))
    days = ["1900-01-01", "2001-06-03", "2001-06-18", "2001-07-03", "2001-07-18", "2001-08-02"]
    for run, (since, until) in enumerate(zip(days, days[1:])):
        advance_winback(due, run, t.old_entries, t.old_opens, t.old_clicks, f"{since} 00:00:00", f"{until} 00:00:00")
    later = t.old_entries.filter(F.col("EntryDate") > as_ts(ORDERS_NOW))
    not_yet = later.select("SubscriberKey", "EntryDate", F.lit(0).cast("bigint").alias("EmailsSent"), F.lit(journeys.WAITING).alias("Outcome"))
    return winback_rows(due, len(days), ORDERS_NOW).unionByName(not_yet)


@query(
    "out_vip",
    f"""SELECT SubscriberKey, EntryDate, CASE WHEN {O_TS} < EntryDate + INTERVAL 14 DAY THEN 'WAITING'
          WHEN EXISTS (SELECT 1 FROM {{old_orders}} o WHERE o.SubscriberKey = e.SubscriberKey AND o.OrderDate BETWEEN e.EntryDate AND e.EntryDate + INTERVAL 14 DAY)
          THEN 'EXIT-RETAINED' ELSE 'EXIT-ESCALATE-CONCIERGE' END AS Outcome FROM {{old_entries}} e""",
)
def _(t):
    return journeys.vip(t.old_entries, t.old_orders, ORDERS_NOW).drop("Sends")


CASE_SQL = f"""SELECT CaseId, SubscriberKey, EntryDate, CASE WHEN {E_TS} < EntryDate + INTERVAL 48 HOUR THEN 'WAITING' WHEN st = 'Closed' THEN 'EXIT-COMPLETE' ELSE 'EXIT-ESCALATED-INTERNAL' END AS Outcome
    FROM (SELECT e.*, (SELECT arg_max(Status, (StatusDate, Status)) FROM {{case_states}} h WHERE h.CaseId = e.CaseId AND h.StatusDate <= e.EntryDate + INTERVAL 48 HOUR) AS st FROM {{case_entries}} e) x"""


def cases(t):
    return journeys.case_escalation(t.case_entries, t.case_states, EVENTS_NOW)


@query("out_case", CASE_SQL)
def _(t):
    return cases(t).drop("Sends")


@query(
    "jny_internal_alert",
    f"""SELECT 'support-manager' AS Channel, CaseId, 'Case escalated 48h ago, still open' AS Message FROM ({CASE_SQL}) c WHERE Outcome = 'EXIT-ESCALATED-INTERNAL'""",
)
def _(t):
    return journeys.internal_alerts(cases(t))
