"""Page views, exits and next-page transitions.

Navigation is read within one ten-minute run and one session; it never crosses
the run, so the run is part of every window here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import numbers, times

RUN_SECONDS = 600
SLICES_PER_QUOTA = 4
SESSION = ["date_time", "session_id"]
# Columns a mean time on page is taken from.
TIME = ("time_whole", "time_rest", "time_n")


def page_views(events: DataFrame) -> DataFrame:
    return events.where(F.col("page_path") != "").select(
        times.ten_minutes(F.col("timestamp")).alias("date_time"),
        "timestamp",
        times.instant(events).alias("instant"),
        "event_id",
        "session_id",
        "sdk_key",
        "page_path",
        "time_on_page_seconds",
    )


def hot_sessions(events: DataFrame, quota: int) -> DataFrame:
    """Sessions with more than ``quota`` events in one run, and the number of time
    slices to cut each into. At most (events / quota) rows; reads two columns."""
    return (
        events.groupBy(times.ten_minutes(F.col("timestamp")).alias("date_time"), "session_id")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > quota)
        .select(
            "date_time",
            "session_id",
            (F.ceil(F.col("n") / F.lit(quota)) * SLICES_PER_QUOTA).alias("slices"),
        )
    )


def hot_moments(events: DataFrame, sessions: DataFrame, quota: int) -> DataFrame:
    """Single timestamps that alone hold more than ``quota`` events of a hot session,
    and the width of the ``event_id`` ranges to cut each into. No time slice can
    divide these. At most (events / quota) rows."""
    parts = F.ceil(F.col("n") / F.lit(quota)) * SLICES_PER_QUOTA
    # As doubles: ids may lie further apart than a long can say.
    spread = F.col("last_id").cast("double") - F.col("first_id").cast("double") + 1
    return (
        events.select(
            times.ten_minutes(F.col("timestamp")).alias("date_time"),
            "session_id",
            "timestamp",
            "event_id",
        )
        .join(sessions, SESSION, "left_semi")
        .groupBy(*SESSION, "timestamp")
        .agg(
            F.count("*").alias("n"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        )
        .where(F.col("n") > quota)
        .select(
            *SESSION,
            F.col("timestamp").alias("at"),
            "first_id",
            F.greatest(spread / parts, F.lit(1.0)).alias("width"),
        )
    )


def with_moments(sessions: DataFrame, moments: DataFrame) -> DataFrame:
    """Hot sessions, each with the ordered list of its hot moments."""
    per_session = moments.groupBy(*SESSION).agg(
        F.sort_array(F.collect_list(F.struct("at", "first_id", "width"))).alias("moments")
    )
    return sessions.join(per_session, SESSION, "left")


def _piece() -> Column:
    """The part of its session a view is sorted in. Pieces follow each other in the
    order of the session: where the clock was put back, its two turns; time slices, in
    these what lies between hot moments, and in these ranges of ``event_id``, or pages
    where there is none. Views of other sessions are all in one piece."""
    ts, moments = F.col("timestamp"), F.col("moments")
    offset = (F.minute(ts) % 10) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")
    passed = F.coalesce(F.size(F.filter(moments, lambda m: m["at"] < ts)), F.lit(0))
    moment = F.get(moments, passed)
    distance = F.col("event_id").cast("double") - moment["first_id"].cast("double")
    part = F.when(moment["at"] == ts, F.floor(distance / moment["width"]))
    time_slice = F.floor(offset * F.col("slices") / RUN_SECONDS)
    turn = F.floor(times.epoch_second(F.col("instant")) / RUN_SECONDS)
    return F.struct(
        F.when(F.col("slices").isNotNull(), turn).otherwise(F.lit(0).cast("long")).alias("turn"),
        F.coalesce(time_slice, F.lit(0).cast("long")).alias("slice"),
        F.when(moments.isNotNull(), passed).otherwise(0).alias("passed"),
        F.when(moments.isNotNull(), F.coalesce(part, F.lit(-1).cast("long")))
        .otherwise(F.lit(0).cast("long"))
        .alias("part"),
        F.when((moment["at"] == ts) & F.col("event_id").isNull(), F.col("page_path"))
        .otherwise(F.lit(""))
        .alias("page"),
    )


def next_page(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Every page view with the page that follows it in its run and session.

    Views at one moment follow each other by ``event_id``; without one, by their page, site
    and time on page, which is all of a view that counts here.

    ``hot`` lists sessions too big for one task (``hot_sessions``, with their hot
    moments). Each is cut into pieces that are sorted apart; the last view of a
    piece then takes the first page of the session's next piece. The result is the
    same with or without ``hot``.
    """
    views = page_views(events)
    in_order = [F.col(c) for c in ("instant", "event_id", "page_path", "sdk_key", "time_on_page_seconds")]
    if hot is None:
        session = Window.partitionBy(*SESSION).orderBy(*in_order)
        found = views.withColumn("next_page", F.lead("page_path", 1).over(session))
        return found.drop("instant")

    pieces = (
        views.join(hot, SESSION, "left")
        .withColumns({"is_hot": F.col("slices").isNotNull(), "piece": _piece()})
        .repartition(*SESSION, "piece")
    )
    # ``is_hot`` adds nothing to the partitioning; it lets the filter for piece ends
    # pass below the window, so that only hot sessions are sorted a second time.
    piece = Window.partitionBy("is_hot", *SESSION, "piece").orderBy(*in_order)
    ordered = pieces.withColumns(
        {
            "next_page": F.lead("page_path", 1).over(piece),
            "piece_head": F.first("page_path").over(piece),
        }
    )
    last_of_piece = F.col("next_page").isNull()
    # One row per non-empty piece of a hot session.
    piece_ends = Window.partitionBy(*SESSION).orderBy("piece")
    joined_up = (
        ordered.where(F.col("is_hot"))
        .where(last_of_piece)
        .withColumn("next_page", F.lead("piece_head", 1).over(piece_ends))
    )
    return (
        ordered.where(~(F.col("is_hot") & last_of_piece))
        .unionByName(joined_up)
        .drop("instant", "slices", "moments", "is_hot", "piece", "piece_head")
    )


def page_exits(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Every page view with its exit flag: 1 where the session's run ends."""
    return next_page(events, hot).withColumn(
        "is_exit", F.when(F.col("next_page").isNull(), 1).otherwise(0)
    )


def _transitions(events: DataFrame, hot: DataFrame | None) -> DataFrame:
    return (
        next_page(events, hot)
        .groupBy("date_time", "page_path", "sdk_key", "next_page")
        .agg(
            F.count("*").alias("to_count"),
            *numbers.mean_sums(F.col("time_on_page_seconds"), *TIME),
        )
    )


def page_transitions(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Views per (page, following page); a NULL following page is an exit.

    The long form of ``next_pages``: bounded by pages, whatever the traffic.
    """
    return _transitions(events, hot).select(
        "date_time", "page_path", "sdk_key", "next_page", "to_count"
    )


def roll_transitions(lower: DataFrame, key: str, period: Column) -> DataFrame:
    """Transitions of a longer period, from those of shorter ones or of ten minutes. Stored
    in this form a page's targets are rows, however many; lists are made when read."""
    return lower.groupBy(period.alias(key), "page_path", "sdk_key", "next_page").agg(
        F.sum("to_count").alias("to_count")
    )


def hourly_page_transitions(minutes: DataFrame) -> DataFrame:
    return roll_transitions(minutes, "date_time", times.hour(F.col("date_time")))


def daily_page_transitions(hourly: DataFrame) -> DataFrame:
    return roll_transitions(hourly, "date", times.day(F.col("date_time")))


def weekly_page_transitions(daily: DataFrame, anchor) -> DataFrame:
    return roll_transitions(daily, "date", times.week_of(F.col("date"), anchor))


def _next_pages(to: Column, count: Column) -> Column:
    """Aligned (to, count) list of the non-NULL targets, biggest first, then by name."""
    ranked = F.sort_array(
        F.collect_list(F.when(to.isNotNull(), F.struct((-count).alias("order"), to.alias("to"))))
    )
    return F.transform(
        ranked, lambda x: F.struct(x["to"].alias("to"), (-x["order"]).alias("count"))
    )


def _no_list() -> Column:
    return F.array().cast("array<struct<to: string, count: bigint>>")


def minutes_page_stats(
    events: DataFrame, hot: DataFrame | None = None, next_pages: str = "first"
) -> DataFrame:
    """Ten-minute page statistics.

    Views collapse to one row per transition before the page-level grouping, so a
    page holding most of the traffic reaches its final task as a short list. With
    ``next_pages="view"`` no list is made: it is that of the transitions (``with_next_pages``).
    """
    moves = _next_pages(F.col("next_page"), F.col("to_count"))
    if next_pages == "view":
        moves = F.any_value(_no_list())
    exits = F.sum(F.when(F.col("next_page").isNull(), F.col("to_count")).otherwise(0))
    return (
        _transitions(events, hot)
        .groupBy("date_time", "page_path", "sdk_key")
        .agg(
            F.sum("to_count").alias("page_views"),
            exits.alias("page_exits"),
            moves.alias("next_pages"),
            *[F.sum(part).alias(part) for part in TIME],
        )
        .select(
            "date_time",
            "page_path",
            "page_views",
            "page_exits",
            numbers.ratio_or_zero(F.col("page_exits"), F.col("page_views"), 3).alias("drop_rate"),
            "next_pages",
            numbers.round_half_even(numbers.mean_of(*map(F.col, TIME)), 2).alias(
                "avg_time_on_page_seconds"
            ),
            "sdk_key",
        )
    )


def _finish(grouped: DataFrame, key: str) -> DataFrame:
    return grouped.select(
        key,
        "page_path",
        "page_views",
        "page_exits",
        numbers.ratio_or_zero(F.col("page_exits"), F.col("page_views"), 3).alias("drop_rate"),
        "next_pages",
        numbers.round_half_even(numbers.mean_of(*map(F.col, TIME)), 2).alias(
            "avg_time_on_page_seconds"
        ),
        "sdk_key",
    )


def _roll(lower: DataFrame, source_key: str, key: str, period: Column, next_pages: str) -> DataFrame:
    """Views and exits add up; time on page is the unweighted mean of lower rows.

    ``next_pages="first"`` keeps the list of the earliest lower row (the rollup's
    own definition keeps an arbitrary one); ``"merge"`` adds the lists up; with ``"view"``
    there are none, and ``with_next_pages`` makes those of a merge from the transitions.
    """
    if next_pages in ("first", "view"):
        moves = F.min_by("next_pages", source_key)
        if next_pages == "view":
            moves = F.any_value(_no_list())
        grouped = lower.groupBy(period.alias(key), "page_path", "sdk_key").agg(
            F.sum("page_views").alias("page_views"),
            F.sum("page_exits").alias("page_exits"),
            *numbers.mean_sums(F.col("avg_time_on_page_seconds"), *TIME),
            moves.alias("next_pages"),
        )
        return _finish(grouped, key)
    if next_pages != "merge":
        raise ValueError(f"next_pages must be 'first', 'merge' or 'view', not {next_pages!r}")
    # One row with the sums and one for each target, made from a lower row in one pass.
    whole = F.struct(
        F.lit(None).cast("string").alias("to"),
        F.lit(None).cast("long").alias("to_count"),
        F.col("page_views"),
        F.col("page_exits"),
        F.col("avg_time_on_page_seconds"),
    )
    targets = F.transform(
        "next_pages",
        lambda move: F.struct(
            move["to"].alias("to"),
            move["count"].alias("to_count"),
            F.lit(None).cast("long").alias("page_views"),
            F.lit(None).cast("long").alias("page_exits"),
            F.lit(None).cast("double").alias("avg_time_on_page_seconds"),
        ),
    )
    parts = lower.select(
        period.alias("period"),
        "page_path",
        "sdk_key",
        F.inline(F.concat(F.array(whole), targets)),
    )
    per_target = (
        parts.groupBy("period", "page_path", "sdk_key", "to").agg(
            F.sum("to_count").alias("to_count"),
            F.sum("page_views").alias("page_views"),
            F.sum("page_exits").alias("page_exits"),
            *numbers.mean_sums(F.col("avg_time_on_page_seconds"), *TIME),
        )
    )
    grouped = per_target.groupBy(F.col("period").alias(key), "page_path", "sdk_key").agg(
        F.sum("page_views").alias("page_views"),
        F.sum("page_exits").alias("page_exits"),
        *[F.sum(part).alias(part) for part in TIME],
        _next_pages(F.col("to"), F.col("to_count")).alias("next_pages"),
    )
    return _finish(grouped, key)


def hourly_page_stats(minutes: DataFrame, next_pages: str = "first") -> DataFrame:
    return _roll(minutes, "date_time", "date_time", times.hour(F.col("date_time")), next_pages)


def daily_page_stats(hourly: DataFrame, next_pages: str = "first") -> DataFrame:
    return _roll(hourly, "date_time", "date", times.day(F.col("date_time")), next_pages)


def weekly_page_stats(daily: DataFrame, anchor, next_pages: str = "first") -> DataFrame:
    return _roll(daily, "date", "date", times.week_of(F.col("date"), anchor), next_pages)


def with_next_pages(stats: DataFrame, transitions: DataFrame, most: int | None = None) -> DataFrame:
    """Page statistics with the lists of the transitions stored beside them, or of the ``most``
    frequent targets. That limit is kept on both sides of the shuffle, so that the list of a
    page with any number of targets stays short."""
    key = [stats.columns[0], "page_path", "sdk_key"]
    moves = transitions.where(F.col("next_page").isNotNull())
    if most is not None:
        best = Window.partitionBy(*key).orderBy(F.desc("to_count"), "next_page")
        moves = moves.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    lists = moves.groupBy(*key).agg(_next_pages(F.col("next_page"), F.col("to_count")).alias("made"))
    made = F.coalesce("made", _no_list()).alias("next_pages")
    joined = stats.join(lists, key, "left")
    return joined.select(*(made if c == "next_pages" else F.col(c) for c in stats.columns))
