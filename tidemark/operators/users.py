"""Click summaries, top elements and audience distributions per segment.

All of them count clicks and distinct clickers per segment, differing only in
the item they split by, so one operator computes the facts for any of them in
one pass over the clicks and every segment type at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import dimensions, numbers, times

SUMMARY = "summary"
ELEMENT = "element"
AGE = dimensions.AGE_DISTRIBUTION
DEVICE = dimensions.DEVICE_DISTRIBUTION
KINDS = [SUMMARY, ELEMENT, AGE, DEVICE]
TOP = 3
DIMENSIONS = ["user_gender", "traffic_source", "device_type", "user_age"]
SEGMENT = ["segment_type", "segment_value", "sdk_key"]


def _items(kinds: list[str]) -> list[tuple[str, Column]]:
    """What each kind splits a segment by; NULL where the click does not count."""
    known = {
        SUMMARY: F.lit(""),
        ELEMENT: F.when(dimensions.non_empty(F.col("target_text")), F.col("target_text")),
        AGE: F.when(F.col("user_age").isNotNull(), dimensions.age_band(F.col("user_age"))),
        DEVICE: F.when(dimensions.non_empty(F.col("device_type")), F.col("device_type")),
    }
    return [(kind, known[kind]) for kind in kinds]


def _exploded(rows: DataFrame, pairs: list[tuple[str, Column]], label: str, value: str) -> DataFrame:
    """One row per input row and pair whose value is not NULL."""
    return (
        rows.withColumn("pair", F.explode(dimensions.labelled(pairs, label, value)))
        .withColumns({label: F.col(f"pair.{label}"), value: F.col(f"pair.{value}")})
        .where(F.col(value).isNotNull())
        .drop("pair")
    )


def segments_long(events: DataFrame, keep: list[str]) -> DataFrame:
    """One row per event and segment type it has a value for."""
    rows = _exploded(events, dimensions.segments(), "segment_type", "segment_value")
    return rows.select(*keep, "segment_type", "segment_value")


def collapsed(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """One row per clicker, element and set of dimensions, and their number ``n``: all that
    ``segment_facts`` needs to know. Rows of the same key add up."""
    kept = [*keys, "sdk_key", "client_id", "target_text", *DIMENSIONS]
    n = F.sum("n") if "n" in clicks.columns else F.count("*")
    return clicks.groupBy(*kept).agg(n.alias("n"))


def segment_facts(clicks: DataFrame, keys: list[str], kinds: list[str]) -> DataFrame:
    """Clicks and distinct clickers per key, segment, kind and item.

    ``clicks`` carries ``keys`` as columns, and ``n`` where a row stands for several clicks.
    Elements are many per clicker and the other kinds few, so that the two are counted apart.
    """
    plain = [kind for kind in kinds if kind != ELEMENT]
    parts = []
    if plain:
        parts.append(_facts(clicks, keys, plain, []))
    if ELEMENT in kinds:
        [(_, element)] = _items([ELEMENT])
        named = clicks.withColumn("item", element).where(F.col("item").isNotNull())
        parts.append(_facts(named, keys, [ELEMENT], ["item"]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _facts(clicks: DataFrame, keys: list[str], kinds: list[str], item: list[str]) -> DataFrame:
    """The facts of some kinds, as three steps that each combine before a shuffle.

    Clicks first collapse to one row per clicker and set of dimensions, so a busy
    clicker becomes a few rows. These are brought together per clicker, and only
    then spread over segments and kinds: the many rows that makes are counted
    where they are and never shuffled. Counting per clicker first turns distinct
    clickers into a plain count.
    """
    clicker = [*keys, "sdk_key", "client_id", *item]
    n = F.sum("n") if "n" in clicks.columns else F.count("*")
    together = clicks.groupBy(*clicker, *DIMENSIONS).agg(n.alias("n")).repartition(*clicker)
    if item:
        split, by_kind = together, []
    elif len(kinds) == 1:
        [(_, only)] = _items(kinds)
        split, by_kind = together.withColumn("item", only).where(F.col("item").isNotNull()), []
    else:
        split, by_kind = _exploded(together, _items(kinds), "kind", "item"), ["kind"]
    counted = [*keys, "sdk_key", "client_id", *by_kind, "item"]
    per_clicker = (
        segments_long(split, [*counted, "n"])
        .groupBy(*counted, "segment_type", "segment_value")
        .agg(F.sum("n").alias("n"))
    )
    facts = per_clicker.groupBy(*keys, *SEGMENT, *by_kind, "item").agg(
        F.sum("n").alias("clicks"), F.count("client_id").alias("users")
    )
    return facts if by_kind else facts.withColumn("kind", F.lit(kinds[0]))


def minute_clicks(events: DataFrame, closed_end: bool = False) -> DataFrame:
    """Clicks with their ten-minute ``date_time``.

    With ``closed_end`` a run also takes the clicks at exactly its end, under the
    next bucket's ``date_time``; such a click counts in both runs, told apart by
    the added ``run`` column.
    """
    clicks = events.where(dimensions.is_click()).withColumn(
        "date_time", times.ten_minutes(F.col("timestamp"))
    )
    if not closed_end:
        return clicks
    own = F.col("date_time")
    earlier = own - F.expr("INTERVAL 10 MINUTES")
    runs = F.when(F.col("timestamp") == own, F.array(earlier, own)).otherwise(F.array(own))
    return clicks.withColumn("run", F.explode(runs))


def day_clicks(
    events: DataFrame, zone: str = "UTC", report_zone: str = "Asia/Seoul", closed_end: bool = False
) -> DataFrame:
    """Clicks with their ``date`` in the report zone.

    With ``closed_end`` the day ends at 23:59:59 sharp and what follows is lost.
    """
    local = times.in_zone(F.col("timestamp"), zone, report_zone)
    clicks = events.where(dimensions.is_click())
    if closed_end:
        last = times.day(local).cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
        clicks = clicks.where(local <= last)
    return clicks.withColumn("date", times.day(local))


def _with_ratio(totals: DataFrame, keys: list[str]) -> DataFrame:
    ratio = numbers.safe_ratio(F.col("total_clicks"), F.col("total_users"))
    return totals.select(
        *keys,
        "segment_type",
        "segment_value",
        "total_clicks",
        "total_users",
        numbers.round_half_even(ratio, 1).alias("avg_clicks_per_user"),
        "sdk_key",
    )


def _ranked(totals: DataFrame, keys: list[str]) -> DataFrame:
    """Top elements by clicks, then name. The rank filter cuts each input
    partition to three rows per group before the shuffle."""
    best = Window.partitionBy(*keys, *SEGMENT).orderBy(F.desc("total_clicks"), F.asc("element"))
    return (
        totals.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= TOP)
        .select(
            *keys,
            "segment_type",
            "segment_value",
            "element",
            "total_clicks",
            "user_count",
            "rank",
            "sdk_key",
        )
    )


def summary_of(facts: DataFrame, keys: list[str]) -> DataFrame:
    rows = facts.where(F.col("kind") == SUMMARY)
    return _with_ratio(
        rows.withColumnsRenamed({"clicks": "total_clicks", "users": "total_users"}), keys
    )


def top_of(facts: DataFrame, keys: list[str]) -> DataFrame:
    rows = facts.where(F.col("kind") == ELEMENT)
    named = {"item": "element", "clicks": "total_clicks", "users": "user_count"}
    return _ranked(rows.withColumnsRenamed(named), keys)


def distribution_of(facts: DataFrame, keys: list[str]) -> DataFrame:
    return facts.where(F.col("kind").isin(AGE, DEVICE)).select(
        *keys,
        "segment_type",
        "segment_value",
        F.col("kind").alias("dist_type"),
        F.col("item").alias("dist_value"),
        F.col("users").alias("user_count"),
        "sdk_key",
    )


def minute_keys(closed_end: bool = False) -> list[str]:
    return ["run", "date_time"] if closed_end else ["date_time"]


# family -> (kinds it needs, how it reads them from the facts)
FAMILY_FACTS = {
    "click_summary": ([SUMMARY], summary_of),
    "top_elements": ([ELEMENT], top_of),
    "user_distribution": ([AGE, DEVICE], distribution_of),
}


def _minutes(family: str, events: DataFrame, closed_end: bool) -> DataFrame:
    kinds, rows_of = FAMILY_FACTS[family]
    keys = minute_keys(closed_end)
    return rows_of(segment_facts(minute_clicks(events, closed_end), keys, kinds), keys).drop("run")


def _daily(family: str, events: DataFrame, day: dict) -> DataFrame:
    kinds, rows_of = FAMILY_FACTS[family]
    return rows_of(segment_facts(day_clicks(events, **day), ["date"], kinds), ["date"])


def minutes_click_summary(events: DataFrame, closed_end: bool = False) -> DataFrame:
    return _minutes("click_summary", events, closed_end)


def minutes_top_elements(events: DataFrame, closed_end: bool = False) -> DataFrame:
    return _minutes("top_elements", events, closed_end)


def minutes_user_distribution(events: DataFrame, closed_end: bool = False) -> DataFrame:
    return _minutes("user_distribution", events, closed_end)


def daily_click_summary(events: DataFrame, **day) -> DataFrame:
    return _daily("click_summary", events, day)


def daily_top_elements(events: DataFrame, **day) -> DataFrame:
    return _daily("top_elements", events, day)


def daily_user_distribution(events: DataFrame, **day) -> DataFrame:
    return _daily("user_distribution", events, day)


def _roll_summary(lower: DataFrame, key: str, period: Column) -> DataFrame:
    totals = lower.groupBy(period.alias(key), *SEGMENT).agg(
        F.sum("total_clicks").alias("total_clicks"), F.sum("total_users").alias("total_users")
    )
    return _with_ratio(totals, [key])


def _roll_top(lower: DataFrame, key: str, period: Column) -> DataFrame:
    totals = lower.groupBy(period.alias(key), *SEGMENT, "element").agg(
        F.sum("total_clicks").alias("total_clicks"), F.sum("user_count").alias("user_count")
    )
    return _ranked(totals, [key])


def _roll_distribution(lower: DataFrame, key: str, period: Column) -> DataFrame:
    return (
        lower.groupBy(period.alias(key), *SEGMENT, "dist_type", "dist_value")
        .agg(F.sum("user_count").alias("user_count"))
        .select(
            key, "segment_type", "segment_value", "dist_type", "dist_value", "user_count", "sdk_key"
        )
    )


def hourly_click_summary(minutes: DataFrame) -> DataFrame:
    return _roll_summary(minutes, "date_time", times.hour(F.col("date_time")))


def hourly_top_elements(minutes: DataFrame) -> DataFrame:
    return _roll_top(minutes, "date_time", times.hour(F.col("date_time")))


def hourly_user_distribution(minutes: DataFrame) -> DataFrame:
    return _roll_distribution(minutes, "date_time", times.hour(F.col("date_time")))


def weekly_click_summary(daily: DataFrame, anchor) -> DataFrame:
    return _roll_summary(daily, "date", times.week_of(F.col("date"), anchor))


def weekly_top_elements(daily: DataFrame, anchor) -> DataFrame:
    return _roll_top(daily, "date", times.week_of(F.col("date"), anchor))


def weekly_user_distribution(daily: DataFrame, anchor) -> DataFrame:
    return _roll_distribution(daily, "date", times.week_of(F.col("date"), anchor))
