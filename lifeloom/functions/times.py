"""Arithmetic relative to an explicit ``as_of``.

Timestamps are UTC wall-clock values (``TIMESTAMP_NTZ``) so that results do not
depend on the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = Union[str, date, datetime, Column]


def as_ts(as_of: Moment) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_day(as_of: Moment) -> Column:
    return F.to_date(as_ts(as_of))


def shift(moment: Moment, amount: int, unit: str) -> Column:
    """``moment`` moved by ``amount`` units; month ends clamp as in SQL DATEADD."""
    base = moment if isinstance(moment, Column) else as_ts(moment)
    return base + F.expr(f"INTERVAL '{int(amount)}' {unit.upper()}")


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end`` (not elapsed 24-hour periods)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def local_day(as_of: Moment, zone: str) -> Column:
    """Calendar day of ``as_of`` (UTC) in a business unit's time zone."""
    utc = F.convert_timezone(F.lit("UTC"), F.lit(zone), as_ts(as_of))
    return F.to_date(utc)


def stamp(as_of: Moment) -> Column:
    """Compact text form used inside generated identifiers."""
    return F.date_format(as_ts(as_of), "yyyyMMddHHmmss")
