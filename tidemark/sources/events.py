"""Event reads limited to a period, with the limit pushed into the scan."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.plans.periods import Period
from tidemark.schema import EVENTS


def read_events(spark: SparkSession, path: str, period: Period | None = None) -> DataFrame:
    """Events under ``path``: Parquet, optionally partitioned by ``dt`` (date of
    ``timestamp``). Without a period ``dt`` is kept, for a later limit to use."""
    events = spark.read.parquet(path)
    return events if period is None else limit_events(events, period)


def limit_events(events: DataFrame, period: Period, zone: str = "UTC") -> DataFrame:
    """Half-open range on ``timestamp``, and on ``dt`` where the table has it so
    that whole partitions are skipped. The period is wall-clock time of ``zone``."""
    ts = F.col("timestamp")
    if _is_instant(events):
        limit = (ts >= _instant(period.start, zone)) & (ts < _instant(period.end, zone))
    else:
        limit = times.half_open(ts, period.start, period.end)
    events = events.where(limit)
    if "dt" in events.columns:
        first, last = period.days()
        events = events.where(F.col("dt").between(F.lit(first), F.lit(last)))
    return as_events(events, zone)


def events_before(events: DataFrame, end: datetime, zone: str = "UTC") -> DataFrame:
    """History up to ``end``, which is left out."""
    last = _instant(end, zone) if _is_instant(events) else times.at(end)
    events = events.where(F.col("timestamp") < last)
    if "dt" in events.columns:
        events = events.where(F.col("dt") <= F.lit(end.date()))
    return as_events(events, zone)


def as_events(events: DataFrame, zone: str = "UTC") -> DataFrame:
    """The columns of ``EVENTS``. Instants become wall-clock time of ``zone``, whatever
    the session's zone. ``event_id`` is null where there is none: views at one moment are
    then ordered by what else they hold, the same way every time."""
    if "event_id" not in events.columns:
        events = events.withColumn("event_id", F.lit(None).cast("long"))
    if _is_instant(events):
        micros = F.unix_micros("timestamp")
        second = F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))
        utc = F.lit("1970-01-01").cast("timestamp_ntz") + second
        events = events.withColumn("timestamp", times.in_zone(utc, "UTC", zone))
    return events.select(*EVENTS.fieldNames())


def identity() -> Column:
    """What tells an event again: its id, else all it holds. Wall-clock times are those of one
    zone by then, whatever zone it came in."""
    others = [c for c in EVENTS.fieldNames() if c != "event_id"]
    return F.coalesce(F.col("event_id"), F.xxhash64(*others))


def _is_instant(events: DataFrame) -> bool:
    return events.schema["timestamp"].dataType.typeName() == "timestamp"


def _instant(moment: datetime, zone: str) -> Column:
    return F.lit(moment.replace(tzinfo=ZoneInfo(zone)))


def rebase(events: DataFrame, source_zone: str, base_zone: str) -> DataFrame:
    """Events with ``timestamp`` moved from the zone it is stored in to the zone
    the rollups bucket in. Limit the period before this, so the scan sees it. The
    stored time stays as ``instant``."""
    if source_zone == base_zone:
        return events
    moved = times.in_zone(F.col("timestamp"), source_zone, base_zone)
    return events.withColumns({times.INSTANT: F.col("timestamp"), "timestamp": moved})
