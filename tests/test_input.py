"""Events as the source table has them: twelve columns, instants, visitors unknown."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.crafted import at, event, events, rows
from tidemark.functions import numbers
from tidemark.operators import metrics, pages, users, visitors
from tidemark.plans import periods, skew
from tidemark.plans.rollup import Options, Rollups
from tidemark.sources.events import as_events
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.store import RollupStore


@pytest.fixture
def session_zone(spark):
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Seoul", "America/New_York"])
def test_instants_do_not_depend_on_the_session_zone(spark, session_zone, tmp_path, zone):
    stored = events(spark, event("20:00"), event("03:15")).drop("event_id")
    instants = stored.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    path = str(tmp_path / "events")
    instants.write.parquet(path)
    session_zone(zone)
    read = spark.read.parquet(path)
    assert read.schema["timestamp"].dataType.typeName() == "timestamp"
    for source in ("UTC", "Asia/Seoul"):
        store = RollupStore(spark, str(tmp_path / f"{source[:3]}"))
        jobs = Rollups(spark, read, store, Options(source_zone=source, base_zone="UTC"))
        jobs.run("minutes_click_summary", periods.day("2024-01-01"))
        got = jobs.store.read("minutes_click_summary").select("date_time").distinct()
        assert rows(got, "date_time") == [(at("03:10"),), (at("20:00"),)]


def test_page_statistics_without_event_ids(spark):
    e = events(spark, *[event("10:01", page_path=p) for p in "abc"], event("10:02", page_path="d"))
    twelve = e.drop("event_id")
    assert len(twelve.columns) == 12
    first = rows(pages.minutes_page_stats(as_events(twelve)), "page_path", "page_views", "page_exits")
    again = as_events(twelve.repartition(3))
    assert first == rows(pages.minutes_page_stats(again), "page_path", "page_views", "page_exits")
    assert sum(r[1] for r in first) == 4 and sum(r[2] for r in first) == 1


def test_unknown_clients_click_but_do_not_visit(spark):
    e = events(spark, event("10:01"), event("10:02"), event("10:21"))
    e = e.withColumn("client_id", F.when(F.col("timestamp") < at("10:02"), F.col("client_id")))
    got = metrics.minutes_metrics(e, visitors.first_seen(e))
    want = [(at("10:00"), 2, 1, 1), (at("10:20"), 1, 0, 0)]
    assert rows(got, "date_time", "clicks", "visitors", "new_visitors") == want
    day = metrics.minutes_metrics(e, visitors.first_seen(e), "1d")
    assert rows(day, "date_time", "clicks", "visitors", "new_visitors") == want
    by_segment = users.minutes_click_summary(e).where("segment_type = 'device'")
    assert {(r[0], r[1]) for r in rows(by_segment, "total_clicks", "total_users")} <= {(2, 1), (1, 0)}


def test_long_times_add_up(spark):
    big = 9.0e11
    df = spark.range(12_000).select(F.lit(big).alias("x"))
    sums = df.agg(*numbers.mean_sums(F.col("x"), "w", "r", "n"))
    assert sums.select(numbers.mean_of(F.col("w"), F.col("r"), F.col("n"))).first()[0] == big
    odd = spark.createDataFrame([(1e21,), (1e300,), (-0.25,)], "x double")
    sums = odd.agg(*numbers.mean_sums(F.col("x"), "w", "r", "n"))
    assert sums.select(numbers.mean_of(F.col("w"), F.col("r"), F.col("n"))).first()[0] == pytest.approx(1e300 / 3)


@pytest.mark.parametrize(
    ("table", "start", "end"),
    [
        ("minutes_metrics", "2024-01-01T10:05", "2024-01-01T10:15"),
        ("hourly_metrics", "2024-01-01T10:00", "2024-01-01T10:10"),
        ("daily_metrics", "2024-01-01T00:00", "2024-01-01T12:00"),
        ("weekly_metrics", "2024-01-01T00:00", "2024-01-05T00:00"),
        ("minutes_metrics", "2024-01-01T10:00", "2024-01-01T12:00"),  # no single run
    ],
)
def test_periods_of_other_lengths_are_refused(spark, tmp_path, table, start, end):
    period = periods.Period(datetime.fromisoformat(start), datetime.fromisoformat(end))
    jobs = Rollups(spark, events(spark, event("10:01")), RollupStore(spark, str(tmp_path)))
    with pytest.raises(ValueError):
        jobs.run(table, period)


def test_a_run_that_finds_nobody_takes_its_visitors_back(spark, tmp_path):
    log = FirstSeenLog(spark, str(tmp_path))
    log.update(events(spark, event("10:01")), "run")
    log.update(events(spark), "run")
    assert log.read().count() == 0


def test_few_events_are_not_counted_by_session(spark, monkeypatch):
    monkeypatch.setattr(pages, "hot_sessions", lambda *_: pytest.fail("counted"))
    assert skew.measured_hot_sessions(events(spark, event("10:01")), 1) is None


def test_spans_and_order_across_a_clock_change(spark, tmp_path):
    """New York, 3 November 2024: 05:30 and 06:30 UTC are both 01:30."""
    e = events(
        spark,
        event("2024-11-03 05:30", page_path="a"),
        event("2024-11-03 06:30", page_path="b"),
        event("2024-11-03 05:31", page_path="c"),
        event("2024-11-03 06:31", page_path="d"),
    )
    options = Options(base_zone="America/New_York")
    jobs = Rollups(spark, e, RollupStore(spark, str(tmp_path)), options)
    day = periods.day("2024-11-03")
    jobs.run("minutes_metrics", day, "1d")
    assert rows(jobs.store.read("minutes_metrics"), "avg_session_seconds") == [(3660,)]
    moved = jobs._base_events(day)
    order = dict(rows(pages.next_page(moved), "page_path", "next_page"))
    assert order == {"a": "c", "c": "b", "b": "d", "d": None}
    hot = skew.measured_hot_sessions(moved, 1)
    assert hot is not None and dict(rows(pages.next_page(moved, hot), "page_path", "next_page")) == order


def test_reads_list_only_their_own_days(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path))
    jobs = Rollups(spark, events(spark, event("10:01"), event("2024-01-09 10:01")), store)
    for day in ("2024-01-01", "2024-01-09"):
        jobs.run("minutes_click_summary", periods.day(day))
    files = store.read("minutes_click_summary", periods.hour("2024-01-09T10")).inputFiles()
    assert files and all("dt=2024-01-09" in f for f in files)
    assert store.read("minutes_click_summary", periods.day("2024-02-01")).count() == 0
