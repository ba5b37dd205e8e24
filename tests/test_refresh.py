"""Late data carried to the hours, days and weeks it touches, by streams and by late files."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.crafted import at, event, events, rows
from tidemark.functions import times
from tidemark.operators import users
from tidemark.plans import periods
from tidemark.plans.ledger import Ledger
from tidemark.plans.refresh import Refresh
from tidemark.plans.rollup import Rollups
from tidemark.schema import FAMILIES, TABLES
from tidemark.sources.arrivals import Arrivals
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.store import RollupStore
from tidemark.streaming import state
from tidemark.streaming.minutes import MinuteStream

MONDAY = date(2024, 1, 1)


class Setting:
    def __init__(self, spark, root, families=tuple(FAMILIES), e=None):
        self.store = RollupStore(spark, f"{root}/tables")
        self.ledger = Ledger(spark, f"{root}/ledger")
        self.log = FirstSeenLog(spark, f"{root}/seen")
        self.stream = MinuteStream(
            spark, f"{root}/state", self.log, self.store, families, ledger=self.ledger
        )
        self.arrivals = Arrivals(spark, f"{root}/events")
        self.jobs = Rollups(spark, e, self.store, seen_log=self.log)
        self.families = families

    def refresh(self, **source):
        return Refresh(self.jobs, self.ledger, MONDAY, self.families, **source)


@pytest.fixture
def setting(spark, tmp_path):
    return lambda **given: Setting(spark, str(tmp_path / "own"), **given)


def fortnight():
    """Events of all kinds on some days of two weeks, one of a late first visit among them."""
    made = []
    for day in (1, 2, 3, 7, 8, 13):
        for i, when in enumerate(("00:05", "05:55", "14:59:59.9", "15:01", "23:58")):
            made.append(
                event(
                    f"2024-01-{day:02d} {when}",
                    client_id=f"c{(day + i) % 4}",
                    page_path=f"/{i % 3}",
                    target_text=f"t{i % 2}",
                    event_name="auto_click" if i % 2 else "page_view",
                )
            )
    return made


def test_streams_and_refreshes_equal_a_backfill(spark, tmp_path, setting):
    made = fortnight()
    s = setting()
    refresh = s.refresh(day_clicks=s.stream.state.day_clicks)
    days = periods.backfill_days("2024-01-01", "2024-01-14", now=datetime(2024, 2, 1))
    for i, part in enumerate((made[1::2], made[0::2])):
        s.stream.process(events(spark, *part), i)
        refresh.run(days.end)
    jobs = Rollups(spark, events(spark, *made), RollupStore(spark, str(tmp_path / "whole")))
    jobs.backfill(days)
    for name in (n for n in TABLES if TABLES[n].family in FAMILIES):
        columns = TABLES[name].columns
        assert rows(s.store.read(name), *columns) == rows(jobs.store.read(name), *columns), name


def test_periods_wait_until_they_are_closed(spark, setting):
    s = setting(families=("metrics",))
    refresh = s.refresh()
    s.stream.process(events(spark, event("2024-01-03 10:05")), 0)
    for closed, hours, days, weeks in (
        ("2024-01-03 10:59", 0, 0, 0),
        ("2024-01-03 11:00", 1, 0, 0),
        ("2024-01-03 23:00", 1, 0, 0),
        ("2024-01-04 00:00", 1, 1, 0),
        ("2024-01-08 00:00", 1, 1, 1),
    ):
        refresh.run(datetime.fromisoformat(closed))
        got = [s.store.read(f"{g}_metrics").count() for g in ("hourly", "daily", "weekly")]
        assert got == [hours, days, weeks], closed
    assert s.ledger.open()[1].count() == 0


def files(store, name):
    return {p for p in store.spark.read.parquet(store.path(name)).inputFiles()}


def test_only_touched_periods_are_written_again(spark, setting):
    s = setting(families=("metrics",))
    refresh, end = s.refresh(), datetime(2024, 1, 15)
    s.stream.process(events(spark, *fortnight()), 0)
    refresh.run(end)
    before = {name: files(s.store, name) for name in ("hourly_metrics", "daily_metrics", "weekly_metrics")}
    s.stream.process(events(spark, event("2024-01-13 05:51", client_id="late")), 1)
    refresh.run(end)
    for name, old in before.items():
        gone = old - files(s.store, name)
        folder = "dt=2024-01-08" if name == "weekly_metrics" else "dt=2024-01-13"
        assert gone and all(folder in f for f in gone), name


def test_files_that_arrive_are_found_by_their_time(spark, tmp_path, setting):
    made = fortnight()
    s = setting(families=("metrics", "click_summary"), e=None)
    refresh, end = s.refresh(arrivals=s.arrivals), datetime(2024, 1, 15)
    jobs = Rollups(spark, events(spark, *made), RollupStore(spark, str(tmp_path / "whole")))
    for part in (made[1::2], made[0:1], made[2::2]):
        e = events(spark, *part).withColumn("dt", times.day(F.col("timestamp")))
        e.coalesce(1).write.mode("append").partitionBy("dt").parquet(s.arrivals.path)
        refresh.pick_up(datetime.now(timezone.utc).replace(tzinfo=None))
        refresh.run(end)
    refresh.pick_up(datetime.now(timezone.utc).replace(tzinfo=None))  # nothing came
    jobs.backfill(periods.backfill_days("2024-01-01", "2024-01-14", now=datetime(2024, 2, 1)), s.families)
    for name in (n for n in TABLES if TABLES[n].family in s.families):
        columns = TABLES[name].columns
        assert rows(s.store.read(name), *columns) == rows(jobs.store.read(name), *columns), name


def test_old_files_are_neither_listed_nor_read(spark, tmp_path):
    arrivals = Arrivals(spark, str(tmp_path / "events"))

    def add(*when):
        e = events(spark, *[event(w) for w in when]).withColumn("dt", times.day(F.col("timestamp")))
        e.coalesce(1).write.mode("append").partitionBy("dt").parquet(arrivals.path)
        return datetime.now(timezone.utc).replace(tzinfo=None)

    first = add("2024-01-01 10:00", "2024-01-02 10:00", "2024-01-03 10:00")
    last = add("2024-01-02 11:00")
    came = arrivals.since(first, last)
    assert all("dt=2024-01-02" in f for f in came.inputFiles())
    assert rows(came, "timestamp") == [(at("2024-01-02 11:00"),)]
    plan = came._jdf.queryExecution().executedPlan().toString()
    assert "file_modification_time" in plan
    none = arrivals.since(last + timedelta(hours=1), last + timedelta(hours=2))
    assert none is None or none.count() == 0
    one = arrivals.of_period(periods.day("2024-01-03"), "UTC")
    assert all("dt=2024-01-03" in f for f in one.inputFiles()) and one.count() == 1
    assert arrivals.of_period(periods.day("2024-02-03"), "UTC").count() == 0


def test_events_given_again_add_nothing(spark, setting):
    s = setting(families=("metrics", "page_stats"))
    made = events(spark, *fortnight())
    s.stream.process(made, 0)
    before = {f: rows(s.store.read(f"minutes_{f}"), *TABLES[f"minutes_{f}"].columns) for f in s.families}
    s.stream.process(made.union(made), 1)
    s.stream.process(made.limit(3), 2)
    for f, want in before.items():
        assert rows(s.store.read(f"minutes_{f}"), *TABLES[f"minutes_{f}"].columns) == want


def test_events_without_ids_count_each_time(spark, setting):
    s = setting(families=("click_summary",))
    made = events(spark, event("10:01"), event("10:01"))
    for i in range(2):
        s.stream.process(made.drop("event_id"), i)
    got = s.store.read("minutes_click_summary").select("total_clicks", "total_users").distinct()
    assert rows(got, "total_clicks", "total_users") == [(4, 1)]


def test_merged_days_hold_what_their_batches_did(spark, setting, monkeypatch):
    monkeypatch.setattr(state, "MOST_FOLDERS", 2)
    s, made = setting(families=("metrics", "click_summary", "page_stats")), fortnight()
    for i in range(5):
        s.stream.process(events(spark, *made[i::5]), i)
    s.stream.process(events(spark, *made[4::5]), 4)  # tried again after its merge
    tags = s.stream.state._tags(state.VISITS, "2024-01-01")
    assert len(tags) <= 3 and any(t.merged for t in tags)
    whole = events(spark, *made)
    want = rows(users.minutes_click_summary(whole), *TABLES["minutes_click_summary"].columns)
    assert rows(s.store.read("minutes_click_summary"), *TABLES["minutes_click_summary"].columns) == want


def test_merged_folders_stand_for_their_batches():
    tags = [state.Tag("a", 0), state.Tag("a", 1), state.Tag("a", 1, True), state.Tag("a", 2), state.Tag("b", 0)]
    assert [str(t) for t in state.current(tags)] == ["a-m1", "a-b2", "b-b0"]
    assert state.Tag.of("x-y-m12") == state.Tag("x-y", 12, True)


@pytest.mark.parametrize("name", ["minutes_metrics", "hourly_metrics", "daily_metrics", "weekly_metrics"])
def test_units_are_replaced_one_by_one(spark, tmp_path, name):
    store, table = RollupStore(spark, str(tmp_path)), TABLES[name]
    moments = {
        "minutes": ["2024-01-01 10:00", "2024-01-01 10:10", "2024-01-02 03:00"],
        "hourly": ["2024-01-01 10:00", "2024-01-01 11:00", "2024-01-02 03:00"],
        "daily": ["2024-01-01", "2024-01-02", "2024-01-03"],
        "weekly": ["2024-01-01", "2024-01-08", "2024-01-15"],
    }[table.grain]

    def made(clicks, *which):
        base = [(moments[i], clicks, 1, 1, 0, 0, "s") for i in which]
        df = spark.createDataFrame(base, "t string, a long, b long, c long, d long, e long, s string")
        key = table.schema[table.time_column].dataType
        df = df.toDF(*table.columns).withColumn(table.time_column, F.col(table.time_column).cast(key))
        return df, df.select(F.col(table.time_column).alias("unit"))

    whole, units = made(1, 0, 1, 2)
    store.write_units(name, whole, units)
    again, unit = made(7, 1)
    store.write_units(name, again, unit)
    assert [r[0] for r in rows(store.read(name).orderBy(table.time_column), "clicks")] == [1, 1, 7]
    store.write_units(name, whole.limit(0), made(0, 0, 1)[1])
    assert rows(store.read(name), "clicks") == [(1,)]
