from datetime import datetime, timedelta

import pytest

from tidemark.plans import periods
from tidemark.plans.periods import Period
from tidemark.schema import TABLES
from tidemark.sources.store import folders_of

NOW = datetime(2024, 1, 16, 0, 10, 30)


def span(p):
    return str(p.start), str(p.end)


def test_defaults_are_the_last_closed_period():
    assert span(periods.ten_minutes(now=NOW)) == ("2024-01-16 00:00:00", "2024-01-16 00:10:00")
    assert span(periods.hour(now=NOW)) == ("2024-01-15 23:00:00", "2024-01-16 00:00:00")
    assert span(periods.day(now=NOW)) == ("2024-01-15 00:00:00", "2024-01-16 00:00:00")
    assert span(periods.week(now=NOW)) == ("2024-01-09 00:00:00", "2024-01-16 00:00:00")


def test_given_periods():
    assert span(periods.run_period("minutes", "2024-01-15T14:30"))[1] == "2024-01-15 14:40:00"
    assert span(periods.run_period("minutes", "2024-01-15T14"))[1] == "2024-01-15 15:00:00"
    assert span(periods.run_period("hourly", "2024-01-15"))[1] == "2024-01-16 00:00:00"
    assert span(periods.run_period("weekly", "2024-01-15"))[1] == "2024-01-22 00:00:00"
    for grain, text in (
        ("minutes", "2024-01-15T14:35"),
        ("hourly", "2024-01-15T14:30"),
        ("daily", "2024-01-15T14"),
        ("daily", "2024-13-01"),
        ("minutes", "soon"),
    ):
        with pytest.raises(ValueError):
            periods.run_period(grain, text)


def test_backfill_days():
    assert span(periods.backfill_days(now=NOW)) == ("2024-01-15 00:00:00", "2024-01-16 00:00:00")
    assert span(periods.backfill_days("2024-01-03", now=NOW))[1] == "2024-01-04 00:00:00"
    assert span(periods.backfill_days("2024-01-03", "2024-02-01", NOW))[1] == "2024-01-17 00:00:00"
    with pytest.raises(ValueError):
        periods.backfill_days("2024-01-17", now=NOW)


def test_only_complete_weeks():
    days = Period(datetime(2024, 1, 1), datetime(2024, 1, 18))
    assert span(periods.complete_weeks(days)) == ("2024-01-01 00:00:00", "2024-01-15 00:00:00")
    assert periods.complete_weeks(Period(datetime(2024, 1, 1), datetime(2024, 1, 7))) is None


def test_zones_move_the_bounds():
    day = periods.day("2024-01-15").in_zone("Asia/Seoul", "UTC")
    assert span(day) == ("2024-01-14 15:00:00", "2024-01-15 15:00:00")


def test_folders_make_up_the_period():
    minutes, weekly = TABLES["minutes_metrics"], TABLES["weekly_metrics"]
    ragged = Period(datetime(2024, 1, 1, 22, 50), datetime(2024, 1, 3, 1, 10))
    assert [f.path for f in folders_of(minutes, ragged)] == [
        "dt=2024-01-01/span=2250",
        "dt=2024-01-01/span=23",
        "dt=2024-01-02/span=day",
        "dt=2024-01-03/span=00",
        "dt=2024-01-03/span=0100",
    ]
    weeks = Period(datetime(2024, 1, 1), datetime(2024, 1, 15))
    assert [f.path for f in folders_of(weekly, weeks)] == ["dt=2024-01-01", "dt=2024-01-08"]
    assert [f.path for f in folders_of(TABLES["daily_metrics"], periods.day("2024-01-05"))] == [
        "dt=2024-01-05"
    ]


def test_an_empty_period_is_refused():
    with pytest.raises(ValueError):
        Period(NOW, NOW - timedelta(1))
