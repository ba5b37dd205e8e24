"""Exact distinct visitors that add up: bitmaps over dense visitor numbers.

A sum of daily distinct counts counts a visitor once a day. Here a day keeps, for each site, the
set of its visitors as bitmaps: one row per bucket of 32,768 visitor numbers. Days then merge to
weeks, or to any span, by or-ing bitmaps, at a cost that grows with the visitors of the site and
not with its traffic, and the count is exact. Numbers are dense, so bitmaps are: a visitor takes
a bit a day, not a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import times

VISITOR = ["client_id", "sdk_key"]
# Parts that are numbered apart, each in a range of its own of about the same size.
PARTS = 64
NUMBERS = "client_id string, sdk_key string, number long"


def new_visitors(events: DataFrame, known: DataFrame) -> DataFrame:
    """Visitors (client_id, sdk_key) of the events that have no number yet."""
    seen = events.where(F.col("client_id").isNotNull()).select(*VISITOR).distinct()
    return seen.join(known.select(*VISITOR), VISITOR, "left_anti")


def numbered(visitors: DataFrame, known: DataFrame, parts: int = PARTS) -> DataFrame:
    """(client_id, sdk_key, number) of visitors without a number: the next ones of their part.
    Part p has the numbers p, p + parts, p + 2 * parts and so on, so that parts grow without
    meeting, none is numbered in one task with another, and numbers stay dense."""
    part = F.pmod(F.xxhash64(*VISITOR), F.lit(parts))
    taken = known.groupBy(F.pmod("number", F.lit(parts)).alias("part")).agg(
        (F.floor(F.max("number") / parts) + 1).alias("taken")
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(*VISITOR)) - 1
    rows = visitors.withColumn("part", part).withColumn("place", place)
    at = F.coalesce("taken", F.lit(0)) + F.col("place")
    return rows.join(F.broadcast(taken), "part", "left").select(
        *VISITOR, (at * parts + F.col("part")).cast("long").alias("number")
    )


def visitor_sets(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """(date, sdk_key, bitmap_bucket, visitors) of each day: bitmaps of its visitors' numbers.
    Events are cut to one row per day and visitor before they meet their numbers."""
    present = (
        events.where(F.col("client_id").isNotNull())
        .select(times.day(F.col("timestamp")).alias("date"), *VISITOR)
        .distinct()
        .join(numbers, VISITOR)
    )
    return present.groupBy(
        "date", "sdk_key", F.bitmap_bucket_number("number").alias("bitmap_bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("visitors"))


def merged_sets(sets: DataFrame, key: str, period: Column) -> DataFrame:
    """Sets of longer periods from those of shorter ones."""
    return sets.groupBy(period.alias(key), "sdk_key", "bitmap_bucket").agg(
        F.bitmap_or_agg("visitors").alias("visitors")
    )


def counted_sets(sets: DataFrame, key: str) -> DataFrame:
    """(key, sdk_key, visitors): how many visitors the sets of a period hold."""
    return sets.groupBy(key, "sdk_key").agg(F.sum(F.bitmap_count("visitors")).alias("visitors"))


def weekly_visitors_exact(daily_sets: DataFrame, anchor) -> DataFrame:
    """Distinct visitors per week and site, from the sets of its days."""
    weeks = merged_sets(daily_sets, "date", times.week_of(F.col("date"), anchor))
    return counted_sets(weeks, "date")
