from datetime import date

from tests.crafted import at, event, events, rows
from tidemark.operators import metrics, visitors

COLUMNS = ("date_time", "visitors", "new_visitors", "existing_visitors")


def minutes(e, grain="10m"):
    return metrics.minutes_metrics(e, visitors.first_seen(e), grain)


def test_new_and_existing_in_one_run(spark):
    e = events(spark, event("09:55"), event("10:05"), event("10:06", client_id="b"))
    assert rows(minutes(e), *COLUMNS) == [
        (at("09:50"), 1, 1, 0),
        (at("10:00"), 2, 1, 1),
    ]
    joined = visitors.new_and_existing(e, at("10:00"), at("10:10"))
    assert rows(joined, *COLUMNS) == [(at("10:00"), 2, 1, 1)]


def test_day_run_judges_visitors_and_sessions_over_the_day(spark):
    e = events(spark, event("09:55"), event("10:05"))
    got = rows(minutes(e, "1d"), *COLUMNS, "avg_session_seconds")
    assert got == [(at("09:50"), 1, 1, 0, 600), (at("10:00"), 1, 1, 0, 600)]


def test_hour_run_starts_afresh_each_hour(spark):
    e = events(spark, event("09:45"), event("09:55"), event("10:05"))
    got = rows(minutes(e, "1h"), *COLUMNS, "avg_session_seconds")
    assert got == [
        (at("09:40"), 1, 1, 0, 600),
        (at("09:50"), 1, 1, 0, 600),
        (at("10:00"), 1, 0, 1, 0),
    ]


def test_a_visitor_is_new_to_each_site(spark):
    e = events(spark, event("09:55"), event("10:05", sdk_key="k1"))
    assert rows(minutes(e), "sdk_key", "new_visitors") == [("k0", 1), ("k1", 1)]


def test_first_seen_in_given_events_only_counts_inside_them(spark):
    history = events(spark, event("09:55"), event("10:05"))
    run = history.where("timestamp >= timestamp_ntz'2024-01-01 10:00:00'")
    got = rows(metrics.minutes_metrics(run, visitors.first_seen(history)), *COLUMNS)
    assert got == [(at("10:00"), 1, 0, 1)]


def test_session_counts_second_boundaries(spark):
    e = events(spark, event("10:00:00.900"), event("10:00:02.100"))
    assert rows(minutes(e), "avg_session_seconds") == [(2,)]


def test_session_spans_midnight_days(spark):
    e = events(spark, event("2024-02-28 23:59:58"), event("2024-03-01 00:00:01"))
    exact = metrics.client_sessions(e)
    assert rows(exact, "session_duration") == [(0,), (0,)]


def test_no_lasting_session_is_zero(spark):
    e = events(spark, event("10:01"), event("10:02", client_id="b"))
    assert rows(minutes(e), "avg_session_seconds") == [(0,)]


def test_mean_session_weighs_by_events(spark):
    e = events(
        spark,
        event("10:00:00"),
        event("10:00:05"),
        event("10:00:10"),
        event("10:00:00", client_id="b"),
        event("10:01:40", client_id="b"),
        event("10:05:00", client_id="c"),
    )
    assert rows(minutes(e), "avg_session_seconds", "visitors") == [(46, 3)]


def test_clicks_count_only_clicks_while_visitors_count_all(spark):
    e = events(spark, event("10:01"), event("10:02", client_id="b", event_name="page_view"))
    assert rows(minutes(e), "clicks", "visitors") == [(1, 2)]


def test_higher_grains_add_up_and_average_the_averages(spark):
    e = events(
        spark,
        event("10:00:00"),
        event("10:00:11"),
        event("10:12"),
        event("11:00:00"),
        event("11:00:04"),
    )
    hourly = metrics.hourly_metrics(minutes(e))
    assert rows(hourly, "date_time", "clicks", "visitors", "avg_session_seconds") == [
        (at("10:00"), 3, 2, 5),
        (at("11:00"), 2, 1, 4),
    ]
    daily = metrics.daily_metrics(hourly)
    assert rows(daily, "date", "visitors", "new_visitors", "avg_session_seconds") == [
        (date(2024, 1, 1), 3, 1, 4)
    ]
    exact = metrics.daily_metrics_exact(e, visitors.first_seen(e))
    assert rows(exact, "date", "visitors", "new_visitors") == [(date(2024, 1, 1), 1, 1)]


def test_weeks_start_at_the_anchor(spark):
    e = events(spark, event("2024-01-03 10:00"), event("2024-01-09 10:00"), event("2024-01-10 10:00"))
    daily = metrics.daily_metrics(metrics.hourly_metrics(minutes(e)))
    weekly = metrics.weekly_metrics(daily, date(2024, 1, 3))
    assert rows(weekly, "date", "clicks") == [(date(2024, 1, 3), 2), (date(2024, 1, 10), 1)]
