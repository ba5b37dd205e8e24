"""Time buckets, zones and spans over TIMESTAMP_NTZ columns.

None of these depend on the session time zone when given NTZ input.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event time in the zone it is stored in, which spans and order are taken from where
# ``timestamp`` has been moved to another zone, whose clock may be put back.
INSTANT = "instant"


def ten_minutes(ts: Column) -> Column:
    return F.window(ts, "10 minutes").start


def hour(ts: Column) -> Column:
    return F.window(ts, "1 hour").start


def day(ts: Column) -> Column:
    return ts.cast("date")


def in_zone(ts: Column, source: str, target: str) -> Column:
    """Wall-clock time of ``ts`` in ``target``, given as wall-clock time in ``source``."""
    if source == target:
        return ts
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def zone_day(ts: Column, source: str, target: str) -> Column:
    return day(in_zone(ts, source, target))


def week_of(day_col: Column, anchor: date) -> Column:
    """First day of the seven-day block counted from ``anchor`` that holds the day."""
    start = F.lit(anchor)
    return F.date_add(start, (F.floor(F.date_diff(day_col, start) / F.lit(7)) * 7).cast("int"))


def instant(events: DataFrame) -> Column:
    return F.col(INSTANT if INSTANT in events.columns else "timestamp")


def epoch_second(ts: Column) -> Column:
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(first: Column, last: Column) -> Column:
    """Second boundaries crossed, so .9 s to 2.1 s is two, not one."""
    return epoch_second(last) - epoch_second(first)


def at(moment) -> Column:
    """A NTZ literal; folds to a constant, so filters on it reach the Parquet scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def half_open(ts: Column, start, end) -> Column:
    return (ts >= at(start)) & (ts < at(end))


def closed(ts: Column, start, end) -> Column:
    return ts.between(at(start), at(end))
