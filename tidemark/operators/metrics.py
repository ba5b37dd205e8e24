"""Clicks, visitors and session length per site.

Every form first cuts events to one row per visitor and bucket. That makes all
distinct counts plain counts, and it takes the weight out of busy visitors and
sites before anything is grouped by site.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import dimensions, numbers, times

RUN_GRAINS = {"10m": times.ten_minutes, "1h": times.hour, "1d": times.day}


def _visits(events: DataFrame, keys: dict[str, Column]) -> DataFrame:
    return events.groupBy(
        *[c.alias(n) for n, c in keys.items()], "sdk_key", "client_id"
    ).agg(
        F.count_if(dimensions.is_click()).alias("clicks"),
        F.count("*").alias("n"),
        F.min(times.instant(events)).alias("first_at"),
        F.max(times.instant(events)).alias("last_at"),
    )


def client_sessions(events: DataFrame) -> DataFrame:
    """Session length of each visitor in each ten-minute run."""
    visits = _visits(events, {"date_time": times.ten_minutes(F.col("timestamp"))})
    return visits.select(
        "date_time",
        "sdk_key",
        "client_id",
        times.seconds_between(F.col("first_at"), F.col("last_at")).alias("session_duration"),
    )


def _summed(rows: DataFrame, key: str) -> DataFrame:
    """Rows of (clicks, visitor, is_new, seconds, n) added up per bucket and site.

    The mean session is per event, so a visitor weighs by their event count;
    sessions of zero length are left out of it.
    """
    lasting = F.col("seconds") > 0
    return (
        rows.groupBy(key, "sdk_key")
        .agg(
            F.sum("clicks").alias("clicks"),
            F.sum("visitor").alias("visitors"),
            F.sum("is_new").alias("new_visitors"),
            F.sum(F.when(lasting, F.col("seconds") * F.col("n"))).alias("seconds"),
            F.sum(F.when(lasting, F.col("n"))).alias("n"),
            F.sum("n").alias("events"),
        )
        .where(F.col("events") > 0)
        .select(
            key,
            "clicks",
            "visitors",
            "new_visitors",
            (F.col("visitors") - F.col("new_visitors")).alias("existing_visitors"),
            numbers.mean_whole(F.col("seconds"), F.col("n")).alias("avg_session_seconds"),
            "sdk_key",
        )
    )


def minute_visits(events: DataFrame) -> DataFrame:
    """One row per ten minutes, site and visitor: what the metrics of a bucket need to know,
    and the first time of day in ``seen_at``. Rows of the same key add up (``merged_visits``)."""
    return events.groupBy(
        times.ten_minutes(F.col("timestamp")).alias("date_time"), "sdk_key", "client_id"
    ).agg(
        F.count_if(dimensions.is_click()).alias("clicks"),
        F.count("*").alias("n"),
        F.min(times.instant(events)).alias("first_at"),
        F.max(times.instant(events)).alias("last_at"),
        F.min("timestamp").alias("seen_at"),
    )


def merged_visits(parts: DataFrame) -> DataFrame:
    """Visits of the same bucket, site and visitor from several lots of events as one."""
    return parts.groupBy("date_time", "sdk_key", "client_id").agg(
        F.sum("clicks").alias("clicks"),
        F.sum("n").alias("n"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min("seen_at").alias("seen_at"),
    )


def metrics_of_visits(visits: DataFrame, seen: DataFrame) -> DataFrame:
    """Ten-minute metrics from visits, one row per bucket, site and visitor."""
    return _of_visits(visits, seen, "date_time", times.ten_minutes)


def _bucket_is_run(
    events: DataFrame, seen: DataFrame, key: str, bucket: Callable[[Column], Column]
) -> DataFrame:
    return _of_visits(_visits(events, {key: bucket(F.col("timestamp"))}), seen, key, bucket)


def _of_visits(
    visits: DataFrame, seen: DataFrame, key: str, bucket: Callable[[Column], Column]
) -> DataFrame:
    """Where bucket and run are the same span, a visitor is new in exactly one
    bucket: the one holding their first event. So new visitors are counted from
    ``seen`` alone, and no event row is joined to history.
    """
    long = lambda v: F.lit(v).cast("long")
    rows = visits.select(
        key,
        "sdk_key",
        "clicks",
        F.col("client_id").isNotNull().cast("long").alias("visitor"),
        long(0).alias("is_new"),
        times.seconds_between(F.col("first_at"), F.col("last_at")).alias("seconds"),
        "n",
    )
    arrivals = seen.select(
        bucket(F.col("first_seen")).alias(key),
        "sdk_key",
        long(0).alias("clicks"),
        long(0).alias("visitor"),
        long(1).alias("is_new"),
        long(0).alias("seconds"),
        long(0).alias("n"),
    )
    return _summed(rows.unionByName(arrivals), key)


def minutes_metrics(events: DataFrame, seen: DataFrame, run_grain: str = "10m") -> DataFrame:
    """Ten-minute metrics.

    ``seen`` is ``first_seen`` over the whole history up to the last event given.
    ``run_grain`` is the span one run looks at (``10m``, ``1h``, ``1d``): rows stay
    ten minutes wide, while session length and "new" are judged over the run.
    """
    if run_grain == "10m":
        return _bucket_is_run(events, seen, "date_time", times.ten_minutes)
    run_of = RUN_GRAINS[run_grain]
    visits = (
        _visits(events, {"date_time": times.ten_minutes(F.col("timestamp"))})
        .withColumn("run", run_of(F.col("date_time")))
    )
    # At most one row per bucket of the run in each of these partitions.
    visitor_run = Window.partitionBy("run", "sdk_key", "client_id")
    timed = visits.withColumns(
        {
            "run_first": F.min("first_at").over(visitor_run),
            "run_last": F.max("last_at").over(visitor_run),
        }
    )
    arrivals = seen.select(
        run_of(F.col("first_seen")).alias("run"),
        "sdk_key",
        "client_id",
        F.lit(1).cast("long").alias("arrived"),
    )
    rows = timed.join(arrivals, ["run", "sdk_key", "client_id"], "left").select(
        "date_time",
        "sdk_key",
        "clicks",
        F.col("client_id").isNotNull().cast("long").alias("visitor"),
        F.coalesce("arrived", F.lit(0).cast("long")).alias("is_new"),
        times.seconds_between(F.col("run_first"), F.col("run_last")).alias("seconds"),
        "n",
    )
    return _summed(rows, "date_time")


def daily_metrics_exact(events: DataFrame, seen: DataFrame) -> DataFrame:
    """True distinct visitors per day, beside the additive ``daily_metrics``."""
    return _bucket_is_run(events, seen, "date", times.day)


def _roll(lower: DataFrame, key: str, period: Column) -> DataFrame:
    """Counts add up; the session mean is the unweighted mean of the lower rows."""
    return (
        lower.groupBy(period.alias(key), "sdk_key")
        .agg(
            F.sum("clicks").alias("clicks"),
            F.sum("visitors").alias("visitors"),
            F.sum("new_visitors").alias("new_visitors"),
            F.sum("existing_visitors").alias("existing_visitors"),
            F.avg("avg_session_seconds").cast("long").alias("avg_session_seconds"),
        )
        .select(
            key,
            "clicks",
            "visitors",
            "new_visitors",
            "existing_visitors",
            "avg_session_seconds",
            "sdk_key",
        )
    )


def hourly_metrics(minutes: DataFrame) -> DataFrame:
    return _roll(minutes, "date_time", times.hour(F.col("date_time")))


def daily_metrics(hourly: DataFrame) -> DataFrame:
    return _roll(hourly, "date", times.day(F.col("date_time")))


def weekly_metrics(daily: DataFrame, anchor) -> DataFrame:
    return _roll(daily, "date", times.week_of(F.col("date"), anchor))
