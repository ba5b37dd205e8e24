"""When each visitor was first seen, and who is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times


def first_seen(events: DataFrame) -> DataFrame:
    """One row per (client_id, sdk_key). Partial minima combine before the shuffle. Events
    without a client are nobody's visit."""
    known = events.where(F.col("client_id").isNotNull())
    return known.groupBy("client_id", "sdk_key").agg(F.min("timestamp").alias("first_seen"))


def past_visitors(events: DataFrame, start) -> DataFrame:
    """Distinct visitors strictly before ``start``."""
    return events.where(F.col("timestamp") < times.at(start)).select("client_id", "sdk_key").distinct()


def new_and_existing(events: DataFrame, start, end) -> DataFrame:
    """New and existing visitors per ten minutes for one run, by joining to its past.

    The rollups use ``first_seen`` instead, which answers every run in one pass;
    this is the direct form for one run. Visitors are cut to one row per bucket
    before the join, so a busy visitor adds no join rows.
    """
    run = events.where(times.half_open(F.col("timestamp"), start, end))
    present = run.select(
        times.ten_minutes(F.col("timestamp")).alias("date_time"), "client_id", "sdk_key"
    ).distinct()
    past = past_visitors(events, start).withColumn("seen_before", F.lit(True))
    return (
        present.join(past, ["client_id", "sdk_key"], "left")
        .groupBy("date_time", "sdk_key")
        .agg(
            F.count("client_id").alias("visitors"),
            F.count_if(F.col("client_id").isNotNull() & F.col("seen_before").isNull()).alias(
                "new_visitors"
            ),
            F.count_if(F.col("seen_before").isNotNull()).alias("existing_visitors"),
        )
    )


def new_and_existing_of(run: DataFrame, seen: DataFrame, start) -> DataFrame:
    """As ``new_and_existing`` for a run of events that begins at ``start``, by the first times
    of its visitors, as a first-seen state gives them, in place of its past."""
    present = run.select(
        times.ten_minutes(F.col("timestamp")).alias("date_time"), "client_id", "sdk_key"
    ).distinct()
    before = seen.where(F.col("first_seen") < times.at(start)).select(
        F.col("client_id").alias("known"), F.col("sdk_key").alias("site")
    )
    same = (F.col("client_id") == F.col("known")) & (F.col("sdk_key") == F.col("site"))
    return (
        present.join(before, same, "left")
        .groupBy("date_time", "sdk_key")
        .agg(
            F.count("client_id").alias("visitors"),
            F.count_if(F.col("client_id").isNotNull() & F.col("known").isNull()).alias("new_visitors"),
            F.count("known").alias("existing_visitors"),
        )
    )
