import pytest

from tests.crafted import at, event, events, rows
from tidemark.operators import metrics, pages, users, visitors
from tidemark.plans import periods
from tidemark.plans.rollup import Options
from tidemark.schema import EVENTS, TABLES
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.store import RollupStore
from tidemark.streaming import clicks, minutes


def batch_rows(e, family):
    if family == "metrics":
        return metrics.minutes_metrics(e, visitors.first_seen(e))
    module = pages if family == "page_stats" else users
    return getattr(module, f"minutes_{family}")(e)


def feed(spark, folder, batches):
    """One file per batch, read one per trigger in order of age."""
    for batch in batches:
        events(spark, *batch).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def stream(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "tables"))
    return minutes.MinuteStream(
        spark, str(tmp_path / "state"), FirstSeenLog(spark, str(tmp_path / "seen")), store, session_quota=2
    )


BATCHES = [
    # A bucket split over two batches, a visitor in both halves, and a late first
    # visit that makes another visitor's former first bucket no longer their first.
    [
        event("10:01", page_path="/a"),
        event("10:02", client_id="b", page_path="/b"),
        event("10:15", client_id="z", target_text="x"),
    ],
    [
        event("10:03", page_path="/c"),
        event("10:04", client_id="d", page_path="/a"),
        event("10:21", client_id="b"),
    ],
    [event("09:40", client_id="z"), event("10:09", client_id="e", page_path="/b")],
]


def test_split_and_late_buckets_equal_the_batch_rollups(spark, tmp_path, stream):
    source = feed(spark, str(tmp_path / "in"), BATCHES)
    query = stream.start(source, str(tmp_path / "checkpoint"), availableNow=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= len(BATCHES)
    everything = events(spark, *[row for batch in BATCHES for row in batch])
    for family in minutes.FAMILIES:
        columns = TABLES[f"minutes_{family}"].columns
        got = rows(stream.store.read(f"minutes_{family}"), *columns)
        assert got == rows(batch_rows(everything, family), *columns), family
    late = stream.store.read("minutes_metrics").where("date_time = timestamp_ntz'2024-01-01 10:10:00'")
    assert rows(late, "new_visitors", "existing_visitors") == [(0, 1)]


def test_a_repeated_batch_changes_nothing(spark, stream):
    first, second = events(spark, *BATCHES[0]), events(spark, *BATCHES[1])
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        stream.process(batch, batch_id)
    columns = TABLES["minutes_metrics"].columns
    want = rows(batch_rows(first.union(second), "metrics"), *columns)
    assert rows(stream.store.read("minutes_metrics"), *columns) == want


def test_buckets_of_a_day_written_whole_are_replaced_one_by_one(spark, stream):
    first, second = events(spark, *BATCHES[0]), events(spark, *BATCHES[1])
    stream.process(first, 0)
    for family in minutes.FAMILIES:
        stream.store.compact(f"minutes_{family}", periods.day("2024-01-01"))
    stream.process(second, 1)
    for family in minutes.FAMILIES:
        columns = TABLES[f"minutes_{family}"].columns
        want = rows(batch_rows(first.union(second), family), *columns)
        assert rows(stream.store.read(f"minutes_{family}"), *columns) == want


@pytest.mark.parametrize("buckets", [24, 25, 60])
def test_rows_no_stream_saw_outlive_a_backlog(spark, stream, buckets):
    """However many buckets of a day a batch touches, the others keep their rows."""
    day = periods.day("2024-01-01")
    morning = events(spark, *[event(f"00:{m:02d}") for m in (0, 10, 20, 30)])
    for family in minutes.FAMILIES:
        stream.store.write(f"minutes_{family}", batch_rows(morning, family), day)
    stream.seen_log.update(morning, "base")
    times = [f"{10 + i // 6:02d}:{i % 6}5" for i in range(buckets)]
    batch = events(spark, *[event(t, client_id="n") for t in times])
    stream.process(batch, 0)
    for family in minutes.FAMILIES:
        columns = TABLES[f"minutes_{family}"].columns
        want = rows(batch_rows(morning.union(batch), family), *columns)
        assert rows(stream.store.read(f"minutes_{family}"), *columns) == want, family


def test_a_late_first_visit_leaves_rows_no_stream_saw(spark, stream):
    """Visitor z was new in a backfilled bucket; the stream now sees them earlier."""
    later = events(spark, event("12:01", client_id="z"))
    stream.store.write("minutes_click_summary", users.minutes_click_summary(later), periods.day("2024-01-01"))
    stream.seen_log.update(later, "base")
    stream.process(events(spark, event("09:01", client_id="z")), 0)
    kept = stream.store.read("minutes_click_summary").select("date_time").distinct()
    assert rows(kept, "date_time") == [(at("09:00"),), (at("12:00"),)]


def test_backfilled_buckets_keep_their_events(spark, tmp_path):
    """A late event in a backfilled bucket, one that both tables have, and a late first visit
    that ends a backfilled bucket's new visitor."""
    shared = event("10:04", client_id="b", page_path="/b")
    past = events(
        spark,
        *[event(f"10:0{m}", client_id=f"v{m % 3}", page_path=f"/{m}") for m in range(10)],
        shared,
        event("12:01", client_id="z"),
    )
    batch = events(spark, event("10:05", client_id="n"), shared, event("09:01", client_id="z"))
    store = RollupStore(spark, str(tmp_path / "tables"))
    log = FirstSeenLog(spark, str(tmp_path / "seen"))
    for family in minutes.FAMILIES:
        store.write(f"minutes_{family}", batch_rows(past, family), periods.day("2024-01-01"))
    log.update(past, "base")
    stream = minutes.MinuteStream(spark, str(tmp_path / "events"), log, store, history=lambda: past)
    everything = past.union(batch).dropDuplicates(["event_id"])
    for _ in range(2):  # the second is a retry
        stream.process(batch, 0)
        for family in minutes.FAMILIES:
            columns = TABLES[f"minutes_{family}"].columns
            assert rows(store.read(f"minutes_{family}"), *columns) == rows(batch_rows(everything, family), *columns)


def test_a_backfilled_bucket_is_not_replaced_without_its_events(spark, stream):
    past = events(spark, *[event(f"10:0{m}") for m in range(10)])
    for family in minutes.FAMILIES:
        stream.store.write(f"minutes_{family}", batch_rows(past, family), periods.day("2024-01-01"))
    stream.seen_log.update(past, "base")
    with pytest.raises(ValueError):
        stream.process(events(spark, event("10:05", client_id="n")), 0)
    columns = TABLES["minutes_metrics"].columns
    assert rows(stream.store.read("minutes_metrics"), *columns) == rows(batch_rows(past, "metrics"), *columns)


def test_a_new_checkpoint_keeps_earlier_events(spark, tmp_path, stream):
    for i, batch in enumerate(BATCHES[:2]):
        source = feed(spark, str(tmp_path / f"in{i}"), [batch])
        stream.start(source, str(tmp_path / f"checkpoint{i}"), availableNow=True).awaitTermination()
    everything = events(spark, *BATCHES[0], *BATCHES[1])
    columns = TABLES["minutes_metrics"].columns
    want = rows(batch_rows(everything, "metrics"), *columns)
    assert rows(stream.store.read("minutes_metrics"), *columns) == want


def test_a_stream_buckets_in_the_zone_of_its_store(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "tables"))
    log = FirstSeenLog(spark, str(tmp_path / "seen"))
    options = Options(base_zone="Asia/Seoul")
    stream = minutes.MinuteStream(spark, str(tmp_path / "events"), log, store, options=options)
    stream.process(events(spark, event("15:00"), event("23:59")), 0)
    got = [str(r["date_time"]) for r in store.read("minutes_metrics").orderBy("date_time").collect()]
    assert got == ["2024-01-02 00:00:00", "2024-01-02 08:50:00"]
    with pytest.raises(ValueError):
        minutes.MinuteStream(spark, "", log, store, options=Options(closed_end=True))


def test_an_empty_batch_is_nothing(spark, stream):
    stream.process(events(spark), 0)
    assert stream.store.read("minutes_metrics").count() == 0


def test_late_events_are_dropped_past_the_watermark(spark, tmp_path):
    source = feed(
        spark,
        str(tmp_path / "in"),
        [
            [event("10:01"), event("10:02", event_name="page_view")],
            [event("10:45"), event("10:03")],
            [event("11:30")],
            [event("10:04")],
        ],
    )
    out = str(tmp_path / "out")
    counts = clicks.clicks_per_ten_minutes(source)
    query = (
        counts.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # 10:03 came before the watermark passed its bucket, 10:04 after. Spark drops by
    # the watermark of the batch before, so it takes a batch between the two.
    got = rows(spark.read.schema(counts.schema).parquet(out), "date_time", "clicks")
    assert got == [(at("10:00"), 2), (at("10:40"), 1)]


def test_late_events_are_kept_apart(spark, tmp_path):
    kept = clicks.KeptClicks(spark, str(tmp_path))
    kept.process(events(spark, event("10:01"), event("10:02", event_name="page_view")), 0)
    for _ in range(2):  # the second is a retry
        kept.process(events(spark, event("10:45"), event("10:03")), 1)
    kept.process(events(spark, event("10:04"), event("10:41")), 2)
    got = rows(kept.counts(), "date_time", "clicks")
    assert got == [(at("10:00"), 2), (at("10:40"), 2)]
    assert rows(kept.late(), "timestamp") == [(at("10:04"),)]
    assert rows(kept.counts(closed=True), "date_time", "clicks") == [(at("10:00"), 2)]
