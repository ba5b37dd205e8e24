import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.crafted import at, event, events, rows
from tidemark.operators import metrics, users, visitors
from tidemark.plans import periods
from tidemark.plans.periods import Period
from tidemark.plans.rollup import Options, Rollups
from tidemark.schema import FAMILIES, MORE_FAMILIES, TABLES
from tidemark.sources import scratch
from tidemark.sources.adapter import sample_events
from tidemark.sources.events import limit_events, read_events
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.store import RollupStore

TEN = "2024-01-01T10:00"


@pytest.fixture
def store(spark, tmp_path):
    return RollupStore(spark, str(tmp_path / "tables"))


def clicks(store, name="minutes_metrics", period=None):
    return rows(store.read(name, period), TABLES[name].time_column, "clicks")


def rollups(spark, store, *made, **kw):
    return Rollups(spark, events(spark, *made), store, **kw)


def test_columns_are_matched_by_name(spark, store):
    e = events(spark, event("10:01"))
    m = metrics.minutes_metrics(e, visitors.first_seen(e))
    store.write("minutes_metrics", m.select(*reversed(m.columns)), periods.ten_minutes(TEN))
    assert rows(store.read("minutes_metrics"), *m.columns) == rows(m, *m.columns)


def test_a_run_twice_leaves_the_table_as_after_once(spark, store):
    jobs = rollups(spark, store, event("10:01"), event("10:02"))
    for _ in range(2):
        jobs.run("minutes_metrics", periods.ten_minutes(TEN))
        jobs.run("hourly_metrics", periods.hour("2024-01-01T10"))
    assert clicks(store) == [(at("10:00"), 2)]
    assert clicks(store, "hourly_metrics") == [(at("10:00"), 2)]


def test_runs_of_one_day_stand_side_by_side(spark, store):
    jobs = rollups(spark, store, event("10:01"), event("10:11"))
    jobs.run("minutes_metrics", periods.ten_minutes(TEN))
    jobs.run("minutes_metrics", periods.ten_minutes("2024-01-01T10:10"))
    assert clicks(store) == [(at("10:00"), 1), (at("10:10"), 1)]


@pytest.mark.parametrize("name", ["minutes_metrics", "daily_metrics", "weekly_metrics"])
def test_a_period_that_turns_out_empty_loses_its_old_rows(spark, store, name):
    table = TABLES[name]
    days = Period(datetime(2024, 1, 1), datetime(2024, 1, 15))
    key = F.col("k").cast(table.schema[table.time_column].dataType)
    made = spark.createDataFrame([("2024-01-01",), ("2024-01-08",)], "k string").select(
        key.alias(table.time_column),
        *[F.lit(1).cast("long").alias(c) for c in table.columns[1:-1]],
        F.lit("k0").alias("sdk_key"),
    )
    store.write(name, made, days)
    second = Period(datetime(2024, 1, 8), datetime(2024, 1, 15))
    store.write(name, made.where("false"), second)
    left = rows(store.read(name), F.col(table.time_column).cast("date").alias("d"))
    assert left == [(date(2024, 1, 1),)]
    store.delete(name, days)
    assert store.read(name).count() == 0


def folders(store, name="minutes_metrics"):
    files = store.spark.read.parquet(store.path(name)).select("_metadata.file_path").collect()
    return sorted({f[0].split(name + "/")[1].rsplit("/", 1)[0] for f in files})


def test_narrow_runs_cut_into_wider_folders(spark, store):
    """A day written whole, then an hour and ten minutes of it from other events."""
    jobs = rollups(spark, store, *[event(f"{h:02d}:{m}1") for h in (9, 10) for m in range(6)])
    jobs.run("minutes_metrics", periods.day("2024-01-01"), "10m")
    jobs.run("hourly_metrics", periods.day("2024-01-01"))
    assert folders(store) == ["dt=2024-01-01/span=day"]
    changed = rollups(spark, store, event("10:01"), event("10:02"), event("10:22"), event("10:23"))
    for _ in range(2):
        changed.run("minutes_metrics", periods.ten_minutes(TEN))
    assert folders(store) == ["dt=2024-01-01/span=1000", "dt=2024-01-01/span=day"]
    want = [(at(f"{h:02d}:{m}0"), 2 if (h, m) == (10, 0) else 1) for h in (9, 10) for m in range(6)]
    assert sorted(clicks(store)) == sorted(want)
    hour = periods.hour("2024-01-01T10")
    assert sorted(clicks(store, period=hour)) == sorted(r for r in want if r[0].hour == 10)
    changed.run("minutes_metrics", hour, "10m")
    changed.run("hourly_metrics", hour)
    want = [(at(f"09:{m}0"), 1) for m in range(6)] + [(at("10:00"), 2), (at("10:20"), 2)]
    assert sorted(clicks(store)) == sorted(want)
    assert folders(store) == ["dt=2024-01-01/span=10", "dt=2024-01-01/span=day"]
    assert sorted(clicks(store, "hourly_metrics")) == [(at("09:00"), 6), (at("10:00"), 4)]
    store.compact("minutes_metrics", periods.day("2024-01-01"))
    assert folders(store) == ["dt=2024-01-01/span=day"]
    assert sorted(clicks(store)) == sorted(want)
    store.delete("minutes_metrics", periods.ten_minutes("2024-01-01T10:20"))
    assert sorted(clicks(store)) == sorted(want[:-1])


def test_a_wider_folder_that_keeps_nothing_is_dropped(spark, store):
    jobs = rollups(spark, store, event("10:01"))
    jobs.run("minutes_metrics", periods.day("2024-01-01"), "10m")
    jobs.run("minutes_metrics", periods.ten_minutes(TEN))
    assert folders(store) == ["dt=2024-01-01/span=1000"]
    assert clicks(store) == [(at("10:00"), 1)]


def test_an_unwritten_table_is_empty(store):
    assert store.read("daily_page_stats").count() == 0


def test_weekly_runs_from_other_days_do_not_touch_each_other(spark, store):
    jobs = rollups(spark, store, event("2024-01-03 10:00"))
    day = periods.day("2024-01-03")
    jobs.run("minutes_metrics", day)
    jobs.run("hourly_metrics", day)
    jobs.run("daily_metrics", day)
    jobs.run("weekly_metrics", periods.week("2024-01-01"))
    jobs.run("weekly_metrics", periods.week("2024-01-02"))
    jobs.run("weekly_metrics", periods.week("2024-01-01"))
    assert clicks(store, "weekly_metrics") == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 1)]


def test_reads_skip_other_partitions(spark, store):
    days = Period(datetime(2024, 1, 1), datetime(2024, 1, 4))
    made = [event(f"2024-01-0{d} 10:0{m}") for d in (1, 2, 3) for m in (1, 2)]
    rollups(spark, store, *made).run("minutes_metrics", days, "10m")
    hour = periods.hour("2024-01-02T10")
    df = store.read("minutes_metrics", hour)
    assert rows(df, "clicks") == [(2,)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    [pruned] = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert "dt#" in pruned and "2024-01-02" in pruned and "span#" in pruned
    assert "PushedFilters: [IsNotNull(date_time), GreaterThanOrEqual(date_time" in plan


def test_bulk_is_the_sum_of_single_runs(spark, tmp_path):
    """A whole range in one job against one job per ten minutes, hour and day."""
    made = [
        event(
            f"2024-01-01 {h:02d}:{m:02d}:07",
            client_id=f"c{(h * m) % 5}",
            page_path=f"/{m % 3}",
            target_text=f"t{m % 4}",
            session_id=f"s{m % 2}",
        )
        for h in (14, 15)
        for m in range(0, 60, 4)
    ]
    names = [n for n in TABLES if not n.startswith("weekly")]
    bulk = rollups(spark, RollupStore(spark, str(tmp_path / "bulk")), *made)
    days = Period(datetime(2024, 1, 1), datetime(2024, 1, 3))
    bulk.backfill(days, [*FAMILIES, *MORE_FAMILIES])
    single = Rollups(spark, bulk.events, RollupStore(spark, str(tmp_path / "single")))
    for h in (14, 15):
        for m in range(0, 60, 10):
            period = periods.ten_minutes(f"2024-01-01T{h}:{m:02d}")
            for name in (n for n in names if n.startswith("minutes")):
                single.run(name, period)
        for name in (n for n in names if n.startswith("hourly")):
            single.run(name, periods.hour(f"2024-01-01T{h}"))
    for d in ("2024-01-01", "2024-01-02"):
        for name in (n for n in names if n.startswith("daily")):
            single.run(name, periods.day(d))
    for name in names:
        columns = TABLES[name].columns
        assert rows(bulk.store.read(name), *columns) == rows(single.store.read(name), *columns), name
        assert bulk.store.read(name).count() > 0


def test_nothing_big_is_left_in_the_scratch_folder(spark, store, tmp_path, monkeypatch):
    scratch_dir = tmp_path / "scratch"
    monkeypatch.setattr(scratch, "scratch_root", lambda _: str(scratch_dir))
    rollups(spark, store, event("10:01")).run_grain("daily", periods.day("2024-01-01"))
    assert store.read("daily_click_summary").count() == 4
    assert list((scratch_dir / "tidemark").glob("segment-facts-*")) == []


def test_backfill_writes_complete_weeks_only(spark, store):
    made = [event(f"2024-01-{d:02d} 10:00") for d in range(1, 18)]
    rollups(spark, store, *made).backfill(Period(datetime(2024, 1, 1), datetime(2024, 1, 18)))
    assert clicks(store, "weekly_metrics") == [(date(2024, 1, 1), 7), (date(2024, 1, 8), 7)]
    weekly = store.read("weekly_click_summary").where("segment_type = 'user_gender'")
    assert rows(weekly, "date", "total_clicks") == [(date(2024, 1, 1), 7), (date(2024, 1, 8), 7)]


def test_closed_runs_are_stored_with_their_run(spark, store):
    jobs = rollups(spark, store, event("23:55"), event("2024-01-02 00:00:00"), options=Options(closed_end=True))
    runs = [periods.ten_minutes("2024-01-01T23:50"), periods.ten_minutes("2024-01-02T00:00")]
    for run in [*runs, *runs]:
        jobs.run("minutes_click_summary", run)
    jobs.run("hourly_click_summary", periods.hour("2024-01-02T00"))
    got = store.read("hourly_click_summary").where("segment_type = 'user_gender'")
    assert rows(got, "date_time", "total_clicks") == [(at("2024-01-02 00:00"), 2)]


def test_closed_runs_of_a_whole_day_can_be_run_again_one_by_one(spark, store):
    jobs = rollups(spark, store, event("10:05"), event("10:10:00"), options=Options(closed_end=True))
    day = periods.day("2024-01-01")
    jobs.run_grain("minutes", day, "10m")

    def totals():
        table = store.read("minutes_click_summary").where("segment_type = 'user_gender'")
        return rows(table, "date_time", "total_clicks")

    want = [(at("10:00"), 1), (at("10:10"), 1), (at("10:10"), 1)]
    assert totals() == want
    for minute in ("10:00", "10:10", "10:20"):
        jobs.run("minutes_click_summary", periods.ten_minutes(f"2024-01-01T{minute}"))
        assert totals() == want
    with pytest.raises(ValueError):
        store.compact("minutes_click_summary", day)


def test_zones_of_buckets_and_report_days(spark, store):
    """Events stored in UTC, buckets on Seoul time."""
    options = Options(base_zone="Asia/Seoul")
    jobs = rollups(spark, store, event("14:59"), event("15:00"), options=options)
    for day in ("2024-01-01", "2024-01-02"):
        jobs.run("minutes_metrics", periods.day(day), "10m")
        jobs.run("daily_click_summary", periods.day(day))
    assert clicks(store) == [(at("23:50"), 1), (at("2024-01-02 00:00"), 1)]
    daily = store.read("daily_click_summary").where("segment_type = 'user_gender'")
    assert rows(daily, "date", "total_clicks") == [(date(2024, 1, 1), 1), (date(2024, 1, 2), 1)]


def test_a_longer_minute_run_judges_visitors_over_its_span(spark, store):
    jobs = rollups(spark, store, event("09:55"), event("10:05"))
    jobs.run("minutes_metrics", periods.run_period("minutes", "2024-01-01"))
    assert rows(store.read("minutes_metrics"), "new_visitors", "avg_session_seconds") == [(1, 600), (1, 600)]
    jobs.run("minutes_metrics", periods.run_period("minutes", "2024-01-01T10"))
    assert rows(store.read("minutes_metrics"), "new_visitors", "avg_session_seconds") == [(0, 0), (1, 600)]


def test_first_seen_log(spark, tmp_path):
    log = FirstSeenLog(spark, str(tmp_path / "seen"))
    first = events(spark, event("10:05"), event("10:06", client_id="b"))
    late = events(spark, event("09:55"), event("10:07", client_id="b"), event("10:08", client_id="c"))
    for _ in range(2):
        log.update(first, "r1")
    for _ in range(2):
        log.update(late, "r2")
    state = [("a", at("09:55")), ("b", at("10:06")), ("c", at("10:08"))]
    assert rows(log.read(), "client_id", "first_seen") == state
    assert rows(log.replaced_by("r2"), "client_id", "replaced") == [("a", at("10:05"))]
    assert rows(log.read(first.where("client_id = 'a'")), "client_id") == [("a",)]
    assert rows(log.compact(str(tmp_path / "packed")).read(), "client_id", "first_seen") == state


def test_runs_with_the_log_equal_runs_over_history(spark, tmp_path):
    made = [event("09:55"), event("10:05"), event("10:06", client_id="b")]
    log = FirstSeenLog(spark, str(tmp_path / "seen"))
    results = []
    for name, seen_log in (("plain", None), ("log", log)):
        jobs = rollups(spark, RollupStore(spark, str(tmp_path / name)), *made, seen_log=seen_log)
        for minute in ("09:50", "10:00", "10:00"):
            jobs.run("minutes_metrics", periods.ten_minutes(f"2024-01-01T{minute}"))
        results.append(rows(jobs.store.read("minutes_metrics"), "date_time", "visitors", "new_visitors"))
    assert results[0] == results[1] == [(at("09:50"), 1, 1), (at("10:00"), 2, 1)]


def test_event_reads_are_pruned_and_pushed_down(spark, tmp_path):
    path = str(tmp_path / "events")
    e = sample_events(spark, "/root/testdata/sf0.001")
    e.withColumn("dt", F.col("timestamp").cast("date")).write.partitionBy("dt").parquet(path)
    day = periods.day("2024-01-05")
    got = read_events(spark, path, day)
    assert got.count() == limit_events(e, day).count() > 0
    plan = users.minutes_click_summary(got)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_name,auto_click)" in plan
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan
    assert "PartitionFilters: [isnotnull(dt" in plan
    read = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "page_path" not in read and "time_on_page" not in read


def test_a_run_reads_only_its_days(spark, tmp_path, store):
    path = str(tmp_path / "events")
    e = events(spark, event("2024-01-04 10:00"), event("2024-01-05 10:00"))
    e.withColumn("dt", F.col("timestamp").cast("date")).write.partitionBy("dt").parquet(path)
    jobs = Rollups(spark, read_events(spark, path), store)
    day = periods.day("2024-01-05")
    for name in ("minutes_click_summary", "minutes_page_stats", "minutes_metrics"):
        plan = jobs.compute(name, day, "10m")._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[isnotnull\(dt#.*?dt#.*? >= 2024-01-05", plan), name
    assert "(dt#" in plan and "<= 2024-01-06" in plan


def test_range_pushdown_keeps_bounds_exact(spark):
    e = events(spark, event("10:00:00"), event("10:10:00"))
    assert limit_events(e, periods.ten_minutes(TEN)).count() == 1
    later = Period(at("10:00") + timedelta(microseconds=1), at("10:11"))
    assert limit_events(e, later).count() == 1
