from datetime import datetime, timezone

import pytest

from tests.crafted import at, event, events, rows
from tidemark.__main__ import main
from tidemark.plans import periods
from tidemark.plans.rollup import Rollups
from tidemark.sources.store import RollupStore


@pytest.fixture
def paths(spark, tmp_path):
    made = [event("2024-01-15 14:31"), event("2024-01-15 14:41"), event("2024-01-15 15:01")]
    events(spark, *made).write.parquet(str(tmp_path / "events"))
    return ["--events", str(tmp_path / "events"), "--store", str(tmp_path / "tables")]


def read(spark, paths, name, *columns):
    return rows(RollupStore(spark, paths[3]).read(name), *columns)


def test_runs_and_backfill(spark, paths, tmp_path):
    main(["run", "minutes", "2024-01-15T14:30", *paths])
    assert read(spark, paths, "minutes_metrics", "date_time") == [(at("2024-01-15 14:30"),)]
    assert len(read(spark, paths, "minutes_click_summary", "date_time")) == 4
    main(["run", "minutes_metrics", "2024-01-15T14:40", *paths, "--seen", str(tmp_path / "seen")])
    main(["run", "hourly_metrics", "2024-01-15T14", *paths])
    assert read(spark, paths, "hourly_metrics", "clicks") == [(2,)]
    main(["backfill", "2024-01-15", "2024-01-15", *paths])
    assert read(spark, paths, "daily_metrics", "clicks") == [(3,)]
    with pytest.raises(SystemExit):
        main(["run", "yearly", *paths])


def test_latest_days_are_each_zones_own(spark, tmp_path):
    """At 15:30 UTC it is already tomorrow in Seoul."""
    e = events(spark, event("2024-01-14 16:00"), event("2024-01-13 16:00"))
    jobs = Rollups(spark, e, RollupStore(spark, str(tmp_path / "tables")))
    day = periods.day("2024-01-14")
    jobs.run_grain("minutes", day, "10m")
    jobs.run_grain("hourly", day)
    jobs.run_latest("daily", datetime(2024, 1, 15, 15, 30, tzinfo=timezone.utc))
    assert rows(jobs.store.read("daily_metrics"), "date") == [(day.start.date(),)]
    summary = jobs.store.read("daily_click_summary").where("segment_type = 'user_gender'")
    assert rows(summary, "date", "total_clicks") == [(day.end.date(), 1)]
