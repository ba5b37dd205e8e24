"""The registered queries. Each takes (spark, sf_dir) and reads the whole table."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from datetime import date, datetime, timezone

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dimensions, numbers, times
from tidemark.operators import distinct, metrics, pages, users, visitors
from tidemark.plans import periods, skew
from tidemark.plans.ledger import Ledger
from tidemark.plans.periods import DAY, HOUR, TEN_MINUTES, Period
from tidemark.plans.refresh import Refresh
from tidemark.plans.rollup import Rollups
from tidemark.schema import FAMILIES, TABLES
from tidemark.sources.adapter import as_clickstream, sample_events
from tidemark.sources.arrivals import Arrivals
from tidemark.sources.events import as_events, limit_events
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.scratch import scratch_path, written
from tidemark.sources.store import RollupStore
from tidemark.sources.visitor_state import VisitorState
from tidemark.streaming import clicks as click_stream
from tidemark.streaming import minutes as minute_stream

Query = Callable[[SparkSession, str], DataFrame]

# What tasks call travels with them, so that workers need not have it installed.
cloudpickle.register_pickle_by_value(periods)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The first Monday of the generated data; weeks count from it.
WEEK_ANCHOR = date(2024, 1, 1)
FORTNIGHT = Period(datetime(2024, 1, 8), datetime(2024, 1, 22))
REPORT_DAY = Period(datetime(2024, 1, 15), datetime(2024, 1, 16))
RAW_EVENTS = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)

def ts() -> Column:
    return F.col("timestamp")


def over_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(sample_events(spark, sf_dir))


def joined(values: Column) -> Column:
    """A list as text, so that results with lists compare by value."""
    return F.array_join(values.cast("array<string>"), "|")


def lists_as_text(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        key,
        "page_path",
        "sdk_key",
        joined(F.col("next_pages.to")).alias("next_to"),
        joined(F.col("next_pages.count")).alias("next_count"),
    )


# Rollups, each from the one below it.


def minutes_metrics(e: DataFrame, run_grain: str = "10m") -> DataFrame:
    return metrics.minutes_metrics(e, visitors.first_seen(e), run_grain)


def hourly_metrics(e: DataFrame) -> DataFrame:
    return metrics.hourly_metrics(minutes_metrics(e))


def daily_metrics(e: DataFrame) -> DataFrame:
    return metrics.daily_metrics(hourly_metrics(e))


def weekly_metrics(e: DataFrame) -> DataFrame:
    return metrics.weekly_metrics(daily_metrics(e), WEEK_ANCHOR)


def minutes_pages(e: DataFrame) -> DataFrame:
    return pages.minutes_page_stats(e, skew.measured_hot_sessions(e))


def hourly_pages(e: DataFrame, next_pages: str = "first") -> DataFrame:
    return pages.hourly_page_stats(minutes_pages(e), next_pages)


def daily_pages(e: DataFrame, next_pages: str = "first") -> DataFrame:
    return pages.daily_page_stats(hourly_pages(e, next_pages), next_pages)


def weekly_pages(e: DataFrame, next_pages: str = "first") -> DataFrame:
    return pages.weekly_page_stats(daily_pages(e, next_pages), WEEK_ANCHOR, next_pages)


def pages_in_pieces(e: DataFrame) -> DataFrame:
    """Page statistics with every session of two events or more cut into pieces."""
    return pages.minutes_page_stats(e, skew.measured_hot_sessions(e, quota=1)).drop("next_pages")


# Scans, filters, functions and single aggregates.


def transitions(e: DataFrame) -> DataFrame:
    return pages.page_transitions(e, skew.measured_hot_sessions(e))


def weekly_transitions(e: DataFrame) -> DataFrame:
    daily = pages.daily_page_transitions(pages.hourly_page_transitions(transitions(e)))
    return pages.weekly_page_transitions(daily, WEEK_ANCHOR)


def clicks_by(e: DataFrame, key: Column, name: str) -> DataFrame:
    return e.groupBy(key.alias(name)).agg(F.count("*").alias("events"))


def new_vs_existing(e: DataFrame) -> DataFrame:
    """The run of the last day in the data."""
    end = data_days(e).end
    return visitors.new_and_existing(e, end - DAY, end)


def first_seen(e: DataFrame) -> DataFrame:
    return visitors.first_seen(e)


def folded_state(spark: SparkSession, e: DataFrame) -> VisitorState:
    """The later half of the events first, folded; then the earlier half of the visitors' events
    folded into that, and the rest left in the log."""
    state = VisitorState(spark, scratch_path(spark, "visitors"), buckets=8)
    days = data_days(e)
    late = ts() >= F.lit(days.start + (days.end - days.start) / 2)
    some = F.crc32("client_id") % 2 == 0
    for run, part in (("late", late), ("some", ~late & some), ("others", ~late & ~some)):
        state.update(e.where(part), run)
        if run != "others":
            state.fold()
    return state


def first_seen_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded_state(spark, sample_events(spark, sf_dir)).read()


def new_vs_existing_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of the last day in the data, its visitors looked up in the state."""
    e = sample_events(spark, sf_dir)
    end = data_days(e).end
    run = e.where(times.half_open(ts(), end - DAY, end))
    return visitors.new_and_existing_of(run, folded_state(spark, e).read(run), end - DAY)


def segments_long(e: DataFrame) -> DataFrame:
    return users.segments_long(e, ["event_id"])


def count_distinct_if(e: DataFrame) -> DataFrame:
    """Distinct clickers and non-clickers per day and site, one row per visitor first."""
    per_client = e.groupBy(times.day(ts()).alias("date"), "sdk_key", "client_id").agg(
        F.max(dimensions.is_click()).alias("clicked")
    )
    return per_client.groupBy("date", "sdk_key").agg(
        F.count_if("clicked").alias("clickers"), F.count_if(~F.col("clicked")).alias("others")
    )


def count_distinct(e: DataFrame) -> DataFrame:
    visitors_once = e.select("sdk_key", "page_path", "client_id").distinct()
    return visitors_once.groupBy("sdk_key", "page_path").agg(F.count("*").alias("clients"))


def avg_if(e: DataFrame) -> DataFrame:
    sessions = metrics.client_sessions(e)
    return sessions.groupBy(times.day(F.col("date_time")).alias("date"), "sdk_key").agg(
        numbers.avg_positive_whole(F.col("session_duration")).alias("avg_session_seconds")
    )


def safe_ratio(e: DataFrame) -> DataFrame:
    sums = e.groupBy("sdk_key", "page_path", "event_name").agg(
        F.count("*").alias("n"), F.count_if(dimensions.is_click()).alias("clicks")
    )
    ratio = numbers.safe_ratio(F.col("n"), F.col("clicks"))
    return sums.select("sdk_key", "page_path", "event_name", ratio.alias("ratio"))


def nested_fields(e: DataFrame) -> DataFrame:
    """The two parallel lists read apart and paired up again."""
    rows = minutes_pages(e).select(
        "date_time", "page_path", "sdk_key", "next_pages.to", "next_pages.count"
    )
    pair = F.explode(F.arrays_zip("to", "count")).alias("pair")
    return rows.select("date_time", "page_path", "sdk_key", pair).select(
        "date_time", "page_path", "sdk_key", "pair.to", "pair.count"
    )


def page_count_lists(e: DataFrame) -> DataFrame:
    return lists_as_text(minutes_pages(e), "date_time")


def visitor_sets(e: DataFrame) -> DataFrame:
    """Daily sets, the visitors of odd events numbered after the others."""
    known = e.sparkSession.createDataFrame([], distinct.NUMBERS)
    for part in (e.where(F.col("event_id") % 2 == 0), e):
        more = distinct.numbered(distinct.new_visitors(part, known), known)
        known = written(known.unionByName(more), "visitor-numbers")
    return distinct.visitor_sets(e, known)


def weekly_visitors_exact(e: DataFrame) -> DataFrame:
    return distinct.weekly_visitors_exact(visitor_sets(e), WEEK_ANCHOR)


def daily_visitors_exact(e: DataFrame) -> DataFrame:
    return distinct.counted_sets(visitor_sets(e), "date")


# Sinks, backfills and streams. Each works in folders of its own.


def new_store(spark: SparkSession) -> RollupStore:
    return RollupStore(spark, scratch_path(spark, "tables"))


def data_days(e: DataFrame) -> Period:
    """The days the events cover: one row of two dates."""
    first, last = e.agg(F.min(times.day(ts())), F.max(times.day(ts()))).first()
    midnight = datetime.min.time()
    return Period(datetime.combine(first, midnight), datetime.combine(last, midnight) + DAY)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = sample_events(spark, sf_dir)
    store = new_store(spark)
    store.write("hourly_metrics", hourly_metrics(e), data_days(e))
    return store.read("hourly_metrics")


def sink_overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows written wrong, then each half of the range replaced by a rerun."""
    e = sample_events(spark, sf_dir)
    store = new_store(spark)
    days = data_days(e)
    rows = daily_metrics(e)
    store.write("daily_metrics", rows.withColumn("clicks", F.lit(-1).cast("long")), days)
    middle = days.start + (days.end - days.start) // DAY // 2 * DAY
    for half in (Period(days.start, middle), Period(middle, days.end)):
        inside = times.half_open(F.col("date").cast("timestamp_ntz"), half.start, half.end)
        store.write("daily_metrics", rows.where(inside), half)
    return store.read("daily_metrics")


def sink_narrow_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click summaries written wrong, then replaced by runs as short as ten minutes."""
    e = sample_events(spark, sf_dir)
    store, days, name = new_store(spark), data_days(e), "minutes_click_summary"
    rows = users.minutes_click_summary(e)
    store.write(name, rows.withColumn("total_clicks", F.lit(-1).cast("long")), days)
    noon = days.start + DAY / 2
    cuts = [days.start, noon, noon + TEN_MINUTES, noon + 2 * HOUR + TEN_MINUTES, days.end]
    for start, end in zip(cuts, cuts[1:], strict=False):
        run = Period(start, end)
        store.write(name, rows.where(times.half_open(F.col("date_time"), start, end)), run)
    return store.read(name)


def backfilled(table: str) -> Query:
    """A table after a backfill of its family over all days, through every grain."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = sample_events(spark, sf_dir)
        jobs = Rollups(spark, e, new_store(spark))
        jobs.backfill(data_days(e), [TABLES[table].family])
        rows = jobs.store.read(table)
        return rows.drop("next_pages")

    return query


def run_periods(e: DataFrame) -> DataFrame:
    """The periods that runs started at each event's moment would cover, and a backfill of the
    ten days before it that is asked to go on after it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for now in batch.column(0).to_pylist():
                found = {g: periods.run_period(g, None, now) for g in ("minutes", "hourly", "daily", "weekly")}
                first, last = (now + i * DAY for i in (-10, 3))
                days = periods.backfill_days(f"{first:%Y-%m-%d}", f"{last:%Y-%m-%d}", now)
                found |= {"backfill": days, "backfill_weeks": periods.complete_weeks(days)}
                rows += [(now, run, p.start, p.end) for run, p in found.items()]
            kinds = [pa.timestamp("us"), pa.string(), pa.timestamp("us"), pa.timestamp("us")]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["started", "run", "first", "end_before"],
            )

    schema = "started timestamp_ntz, run string, first timestamp_ntz, end_before timestamp_ntz"
    return e.select(F.col("timestamp")).distinct().mapInArrow(each, schema)


def without_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page statistics of the twelve columns alone, ordered in a session by time."""
    e = sample_events(spark, sf_dir).drop("event_id")
    return minutes_pages(as_events(e)).drop("next_pages")


# Streams. Raw events come as files that each hold some of every bucket.


def raw_files(spark: SparkSession, sf_dir: str, batches: int = 3, times_given: int = 1) -> tuple[str, int]:
    """The raw events as files, as many as the table is read in, and how many make a batch."""
    path = scratch_path(spark, "raw-events")
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    each = -(-raw.rdd.getNumPartitions() // batches)
    for _ in range(times_given):
        raw.repartition(each * batches, "event_id").write.mode("append").parquet(path)
    return path, each


def raw_stream(spark: SparkSession, path: str, files_of_a_batch: int = 1000) -> DataFrame:
    files = spark.readStream.schema(RAW_EVENTS).option("maxFilesPerTrigger", files_of_a_batch)
    return as_clickstream(files.parquet(path))


def streamed_minutes(family: str, times_given: int = 1) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = raw_stream(spark, *raw_files(spark, sf_dir, times_given=times_given))
        store = minute_stream.drain(spark, events, (family,))
        rows = store.read(f"minutes_{family}")
        return rows.drop("next_pages")

    return query


def refreshed(table: str) -> Query:
    """A table above ten minutes after a stream of two batches that both touch every period,
    each followed by a refresh of what it changed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        family = TABLES[table].family
        root = scratch_path(spark, "refreshed")
        store, ledger = RollupStore(spark, f"{root}/tables"), Ledger(spark, f"{root}/ledger")
        log = FirstSeenLog(spark, f"{root}/seen")
        stream = minute_stream.MinuteStream(
            spark, f"{root}/state", log, store, (family,), ledger=ledger
        )
        e = sample_events(spark, sf_dir)
        jobs = Rollups(spark, e, store, seen_log=log)
        refresh = Refresh(jobs, ledger, WEEK_ANCHOR, [family], stream.state.day_clicks)
        # The last day of the report zone ends within the day after.
        end = data_days(e).end + DAY
        for i in range(2):
            stream.process(e.where(F.col("event_id") % 2 == i), i)
            refresh.run(end)
        return store.read(table).drop("next_pages")

    return query


def arrived(table: str) -> Query:
    """A table after a refresh of what two waves of files changed, the second a tenth of the
    events, late ones of every day."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        family = TABLES[table].family
        root = scratch_path(spark, "arrived")
        e = sample_events(spark, sf_dir).withColumn("dt", times.day(ts()))
        store, ledger = RollupStore(spark, f"{root}/tables"), Ledger(spark, f"{root}/ledger")
        jobs = Rollups(spark, e, store, seen_log=FirstSeenLog(spark, f"{root}/seen"))
        arrivals = Arrivals(spark, f"{root}/events")
        refresh = Refresh(jobs, ledger, WEEK_ANCHOR, [family], arrivals=arrivals)
        late = F.col("event_id") % 10 == 0
        for wave in (~late, late):
            e.where(wave).write.mode("append").partitionBy("dt").parquet(arrivals.path)
            refresh.pick_up(datetime.now(timezone.utc).replace(tzinfo=None))
            refresh.run(data_days(e).end + DAY)
        return store.read(table).drop("next_pages")

    return query


def new_stream(spark: SparkSession, history=None) -> tuple[minute_stream.MinuteStream, str]:
    root = scratch_path(spark, "stream")
    log = FirstSeenLog(spark, f"{root}/seen")
    store = RollupStore(spark, f"{root}/tables")
    stream = minute_stream.MinuteStream(
        spark, f"{root}/state", log, store, ("metrics",), history=history
    )
    return stream, root


def stream_into_backfilled_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store has buckets of a backfill up to the middle of one after a middle day's noon,
    without a tenth of that day's events, which come late: the stream sees these and all events
    from then on, in one batch of far more buckets than the day has left."""
    e = sample_events(spark, sf_dir)
    days = data_days(e)
    day = days.start + (days.end - days.start) // DAY // 2 * DAY
    noon = day + DAY / 2
    cut = noon + TEN_MINUTES / 2

    def late(at: str):
        return (F.col(at) >= times.at(day)) & (F.col("event_id") % 10 == 0)

    before = e.where((ts() < times.at(cut)) & ~late("timestamp"))
    stream, root = new_stream(spark, lambda: before)
    jobs = Rollups(spark, before, stream.store, seen_log=stream.seen_log)
    jobs.run("minutes_metrics", Period(days.start, noon + TEN_MINUTES), "10m")
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    raw = raw.where((F.col("ts") >= times.at(cut)) | late("ts"))
    raw.write.parquet(f"{root}/raw")
    query = stream.start(raw_stream(spark, f"{root}/raw"), f"{root}/checkpoint", availableNow=True)
    query.awaitTermination()
    return stream.store.read("minutes_metrics")


def stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own, one after the other, into one store."""
    stream, root = new_stream(spark)
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(2):
        part = f"{root}/raw-{i}"
        raw.where(F.col("event_id") % 2 == i).write.parquet(part)
        query = stream.start(raw_stream(spark, part), f"{root}/checkpoint-{i}", availableNow=True)
        query.awaitTermination()
    return stream.store.read("minutes_metrics")


def stream_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch, so that nothing is late."""
    events = raw_stream(spark, raw_files(spark, sf_dir, 1)[0])
    return click_stream.drain(events, scratch_path(spark, "clicks"))


def stream_clicks_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of events of all days, so that most of two of them are late: what came in
    time and what is in the side table are all clicks."""
    root = scratch_path(spark, "kept-clicks")
    kept = click_stream.KeptClicks(spark, f"{root}/tables")
    events = raw_stream(spark, *raw_files(spark, sf_dir))
    kept.start(events, f"{root}/checkpoint", availableNow=True).awaitTermination()
    late = kept.late().groupBy(times.ten_minutes(ts()).alias("date_time"), "sdk_key")
    late = late.agg(F.count_if(dimensions.is_click()).alias("clicks"))
    both = kept.counts().unionByName(late)
    return both.groupBy("date_time", "sdk_key").agg(F.sum("clicks").alias("clicks"))


def all_queries() -> dict[str, Query]:
    e = over_events
    return {
        # 2.1 scans, 2.2 sinks
        "scan_events_range": e(lambda d: limit_events(d, FORTNIGHT)),
        "sink_roundtrip": sink_roundtrip,
        "sink_overwrite_partition": sink_overwrite_partition,
        # 2.3 filters and projections
        "filter_half_open": e(
            lambda d: d.where(times.half_open(ts(), FORTNIGHT.start, FORTNIGHT.end)).select(
                "event_id", "timestamp"
            )
        ),
        "filter_closed": e(
            lambda d: d.where(times.closed(ts(), FORTNIGHT.start, FORTNIGHT.end)).select(
                "event_id", "timestamp"
            )
        ),
        "filter_clicks": e(lambda d: d.where(dimensions.is_click()).select("event_id", "event_name")),
        "filter_nonempty": e(
            lambda d: d.where(
                (F.col("page_path") != "") & dimensions.non_empty(F.col("target_text"))
            ).select("event_id", "page_path", "target_text")
        ),
        "filter_not_null": e(
            lambda d: d.where(F.col("user_age").isNotNull() & F.col("user_gender").isNull()).select(
                "event_id", "user_age"
            )
        ),
        "segments_long": e(segments_long),
        # 2.4 joins
        "new_vs_existing_join": e(new_vs_existing),
        "first_seen": e(first_seen),
        "first_seen_state": first_seen_state,
        "new_vs_existing_state": new_vs_existing_state,
        # 2.5 aggregates
        "agg_count": e(lambda d: d.groupBy("sdk_key", "event_name").agg(F.count("*").alias("n"))),
        "agg_count_if": e(
            lambda d: d.groupBy("sdk_key", times.day(ts()).alias("date")).agg(
                F.count_if(dimensions.is_click()).alias("clicks")
            )
        ),
        "agg_count_distinct": e(count_distinct),
        "agg_count_distinct_if": e(count_distinct_if),
        "agg_avg_of_avg": e(
            lambda d: hourly_metrics(d).select("date_time", "sdk_key", "avg_session_seconds")
        ),
        "agg_avg_if": e(avg_if),
        "agg_any": e(lambda d: lists_as_text(hourly_pages(d), "date_time")),
        "agg_collect": e(lambda d: page_count_lists(d).drop("next_count")),
        # 2.6 windows
        "session_duration": e(metrics.client_sessions),
        "next_page": e(
            lambda d: pages.next_page(d, skew.measured_hot_sessions(d)).select(
                "event_id", "date_time", "session_id", "sdk_key", "page_path", "next_page"
            )
        ),
        "page_exits": e(
            lambda d: pages.page_exits(d, skew.measured_hot_sessions(d)).select(
                "event_id", "date_time", "page_path", "is_exit"
            )
        ),
        "hourly_page_transitions": e(lambda d: pages.hourly_page_transitions(transitions(d))),
        "daily_page_transitions": e(
            lambda d: pages.daily_page_transitions(pages.hourly_page_transitions(transitions(d)))
        ),
        "weekly_page_transitions": e(weekly_transitions),
        "page_transitions": e(lambda d: pages.page_transitions(d, skew.measured_hot_sessions(d))),
        "page_stats_sliced_sessions": e(pages_in_pieces),
        # 2.9 functions
        "fn_ten_minutes": e(lambda d: clicks_by(d, times.ten_minutes(ts()), "date_time")),
        "fn_hour": e(lambda d: clicks_by(d, times.hour(ts()), "date_time")),
        "fn_date": e(lambda d: clicks_by(d, times.day(ts()), "date")),
        "fn_seoul_date": e(lambda d: clicks_by(d, times.zone_day(ts(), "UTC", "Asia/Seoul"), "date")),
        "filter_seoul_day": e(
            lambda d: limit_events(d, REPORT_DAY.in_zone("Asia/Seoul", "UTC")).select(
                "event_id", "timestamp"
            )
        ),
        "fn_age_band": e(lambda d: clicks_by(d, dimensions.age_band(F.col("user_age")), "age_band")),
        "fn_round_half_even": e(
            lambda d: d.select(
                "event_id",
                numbers.round_half_even(F.col("time_on_page_seconds") / 4, 1).alias("one_digit"),
                numbers.round_half_even(F.col("time_on_page_seconds") / 8, 2).alias("two_digits"),
            )
        ),
        "fn_safe_ratio": e(safe_ratio),
        "fn_nested_fields": e(nested_fields),
        # 2.10 jobs
        "minutes_metrics": e(minutes_metrics),
        "minutes_metrics_hour_run": e(lambda d: minutes_metrics(d, "1h")),
        "minutes_metrics_day_run": e(lambda d: minutes_metrics(d, "1d")),
        "minutes_page_stats": e(lambda d: minutes_pages(d).drop("next_pages")),
        "minutes_page_stats_next": e(page_count_lists),
        "minutes_click_summary": e(users.minutes_click_summary),
        "minutes_top_elements": e(users.minutes_top_elements),
        "minutes_user_distribution": e(users.minutes_user_distribution),
        "minutes_click_summary_closed": e(lambda d: users.minutes_click_summary(d, closed_end=True)),
        "minutes_top_elements_closed": e(lambda d: users.minutes_top_elements(d, closed_end=True)),
        "minutes_user_distribution_closed": e(
            lambda d: users.minutes_user_distribution(d, closed_end=True)
        ),
        "hourly_metrics": e(hourly_metrics),
        "hourly_page_stats": e(lambda d: hourly_pages(d).drop("next_pages")),
        "hourly_page_stats_next": e(lambda d: lists_as_text(hourly_pages(d), "date_time")),
        "hourly_page_stats_merged": e(lambda d: lists_as_text(hourly_pages(d, "merge"), "date_time")),
        "hourly_click_summary": e(
            lambda d: users.hourly_click_summary(users.minutes_click_summary(d))
        ),
        "hourly_click_summary_closed": e(
            lambda d: users.hourly_click_summary(users.minutes_click_summary(d, closed_end=True))
        ),
        "hourly_top_elements": e(lambda d: users.hourly_top_elements(users.minutes_top_elements(d))),
        "hourly_user_distribution": e(
            lambda d: users.hourly_user_distribution(users.minutes_user_distribution(d))
        ),
        "daily_metrics": e(daily_metrics),
        "daily_metrics_exact": e(lambda d: metrics.daily_metrics_exact(d, visitors.first_seen(d))),
        "daily_visitors_exact": e(daily_visitors_exact),
        "weekly_visitors_exact": e(weekly_visitors_exact),
        "daily_page_stats": e(lambda d: daily_pages(d).drop("next_pages")),
        "daily_page_stats_next": e(lambda d: lists_as_text(daily_pages(d), "date")),
        "daily_page_stats_merged": e(lambda d: lists_as_text(daily_pages(d, "merge"), "date")),
        "daily_click_summary": e(users.daily_click_summary),
        "daily_click_summary_closed": e(lambda d: users.daily_click_summary(d, closed_end=True)),
        "daily_top_elements": e(users.daily_top_elements),
        "daily_user_distribution": e(users.daily_user_distribution),
        "weekly_metrics": e(weekly_metrics),
        "weekly_page_stats": e(lambda d: weekly_pages(d).drop("next_pages")),
        "weekly_page_stats_next": e(lambda d: lists_as_text(weekly_pages(d), "date")),
        "weekly_page_stats_merged": e(lambda d: lists_as_text(weekly_pages(d, "merge"), "date")),
        "weekly_click_summary": e(
            lambda d: users.weekly_click_summary(users.daily_click_summary(d), WEEK_ANCHOR)
        ),
        "weekly_top_elements": e(
            lambda d: users.weekly_top_elements(users.daily_top_elements(d), WEEK_ANCHOR)
        ),
        "weekly_user_distribution": e(
            lambda d: users.weekly_user_distribution(users.daily_user_distribution(d), WEEK_ANCHOR)
        ),
        "run_periods": e(run_periods),
        "backfill_hourly_page_transitions": backfilled("hourly_page_transitions"),
        "backfill_daily_page_transitions": backfilled("daily_page_transitions"),
        "refreshed_daily_page_transitions": refreshed("daily_page_transitions"),
        **{f"backfill_hourly_{f}": backfilled(f"hourly_{f}") for f in FAMILIES},
        **{f"backfill_daily_{f}": backfilled(f"daily_{f}") for f in FAMILIES},
        "backfill_weekly_metrics": backfilled("weekly_metrics"),
        "backfill_weekly_page_stats": backfilled("weekly_page_stats"),
        "backfill_weekly_click_summary": backfilled("weekly_click_summary"),
        "backfill_weekly_top_elements": backfilled("weekly_top_elements"),
        "backfill_weekly_user_distribution": backfilled("weekly_user_distribution"),
        "sink_narrow_runs": sink_narrow_runs,
        "minutes_page_stats_no_event_id": without_event_ids,
        # 2.12 streaming
        "stream_minutes_metrics": streamed_minutes("metrics"),
        "stream_minutes_page_stats": streamed_minutes("page_stats"),
        "stream_minutes_click_summary": streamed_minutes("click_summary"),
        "stream_minutes_top_elements": streamed_minutes("top_elements"),
        "stream_minutes_user_distribution": streamed_minutes("user_distribution"),
        "stream_into_backfilled_store": stream_into_backfilled_store,
        "stream_restarted": stream_restarted,
        "stream_files_given_twice": streamed_minutes("metrics", times_given=2),
        "refreshed_hourly_metrics": refreshed("hourly_metrics"),
        "refreshed_hourly_page_stats": refreshed("hourly_page_stats"),
        "refreshed_hourly_top_elements": refreshed("hourly_top_elements"),
        "refreshed_daily_page_stats": refreshed("daily_page_stats"),
        "refreshed_daily_click_summary": refreshed("daily_click_summary"),
        "refreshed_weekly_metrics": refreshed("weekly_metrics"),
        "refreshed_weekly_user_distribution": refreshed("weekly_user_distribution"),
        "arrived_daily_metrics": arrived("daily_metrics"),
        "arrived_weekly_top_elements": arrived("weekly_top_elements"),
        "stream_clicks_10m": stream_clicks,
        "stream_clicks_kept": stream_clicks_kept,
    }
