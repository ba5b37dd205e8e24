from datetime import date

from tests.crafted import at, event, events, rows
from tidemark.operators import users
from tidemark.sources.adapter import sample_events


def gender(df):
    return df.where("segment_type = 'user_gender'")


def test_click_at_the_end_of_a_run(spark):
    e = events(spark, event("10:10:00"))
    assert rows(gender(users.minutes_click_summary(e)), "date_time", "total_clicks") == [(at("10:10"), 1)]
    closed = gender(users.minutes_click_summary(e, closed_end=True))
    assert rows(closed, "date_time", "total_clicks") == [(at("10:10"), 1), (at("10:10"), 1)]
    hourly = users.hourly_click_summary(closed)
    assert rows(hourly, "date_time", "total_clicks") == [(at("10:00"), 2)]


def test_closed_run_ranks_by_bucket(spark):
    e = events(spark, event("10:05", target_text="x"), event("10:10:00", target_text="y"))
    top = gender(users.minutes_top_elements(e, closed_end=True))
    assert rows(top, "date_time", "element", "rank") == [
        (at("10:00"), "x", 1),
        (at("10:10"), "y", 1),
        (at("10:10"), "y", 1),
    ]


def test_last_second_of_the_day(spark):
    e = events(spark, event("14:59:59.500"), event("14:59:59"))
    counted = gender(users.daily_click_summary(e))
    assert rows(counted, "date", "total_clicks") == [(date(2024, 1, 1), 2)]
    closed = gender(users.daily_click_summary(e, closed_end=True))
    assert rows(closed, "date", "total_clicks") == [(date(2024, 1, 1), 1)]


def test_days_are_those_of_the_report_zone(spark):
    e = events(spark, event("15:00:00"))
    assert rows(gender(users.daily_click_summary(e)), "date") == [(date(2024, 1, 2),)]
    assert rows(gender(users.daily_click_summary(e, report_zone="UTC")), "date") == [(date(2024, 1, 1),)]


def test_ratio_rounds_half_to_even(spark):
    e = events(spark, *[event("10:01", client_id=f"c{i % 4}") for i in range(9)])
    got = rows(gender(users.minutes_click_summary(e)), "total_clicks", "total_users", "avg_clicks_per_user")
    assert got == [(9, 4, 2.2)]


def test_ties_rank_by_name(spark):
    e = events(spark, *[event("10:01", target_text=t) for t in "dbca"])
    got = rows(gender(users.minutes_top_elements(e)), "rank", "element")
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_fourth_in_every_bucket_never_makes_the_hour(spark):
    made = []
    for bucket in range(6):
        for name, clicks in ((f"x{bucket}", 5), (f"y{bucket}", 5), (f"z{bucket}", 5), ("steady", 4)):
            made += [event(f"10:{bucket}1", target_text=name)] * clicks
    hourly = gender(users.hourly_top_elements(users.minutes_top_elements(events(spark, *made))))
    assert rows(hourly, "rank", "element") == [(1, "x0"), (2, "x1"), (3, "x2")]


def test_age_bands(spark):
    ages = [None, 9, 10, 19, 20, 59, 60]
    e = events(spark, *[event("10:01", client_id=f"c{a}", user_age=a) for a in ages])
    by_age = users.minutes_click_summary(e).where("segment_type = 'user_age'")
    assert rows(by_age, "segment_value", "total_users") == [
        ("10s", 2),
        ("20s", 1),
        ("50s", 1),
        ("60s+", 1),
        ("unknown", 2),
    ]
    dist = gender(users.minutes_user_distribution(e)).where("dist_type = 'ageGroup'")
    assert rows(dist, "dist_value", "user_count") == [
        ("10s", 2),
        ("20s", 1),
        ("50s", 1),
        ("60s+", 1),
        ("unknown", 1),
    ]


def test_blank_device_is_a_segment_but_no_distribution(spark):
    e = events(spark, event("10:01", device_type=""), event("10:02", device_type=None))
    segments = users.minutes_click_summary(e).where("segment_type = 'device_type'")
    assert rows(segments, "segment_value") == [("",)]
    assert users.minutes_user_distribution(e).where("dist_type = 'device'").count() == 0


def test_missing_gender_is_left_out_of_its_segment_only(spark):
    e = events(spark, event("10:01", user_gender=None))
    got = rows(users.minutes_click_summary(e), "segment_type")
    assert got == [("device_type",), ("traffic_source",), ("user_age",)]


def test_a_clicker_with_two_devices_counts_once_per_segment(spark):
    e = events(
        spark,
        event("10:01", device_type="mobile"),
        event("10:02", device_type="desktop"),
        event("10:03", device_type="desktop"),
    )
    got = rows(users.minutes_click_summary(e), "segment_type", "segment_value", "total_clicks", "total_users")
    assert ("user_gender", "female", 3, 1) in got
    assert ("device_type", "desktop", 2, 1) in got


def test_one_pass_over_all_kinds_equals_the_single_ones(spark):
    e = sample_events(spark, "/root/testdata/sf0.001")
    facts = users.segment_facts(users.minute_clicks(e), ["date_time"], users.KINDS)
    for family, (_, rows_of) in users.FAMILY_FACTS.items():
        one = getattr(users, f"minutes_{family}")(e)
        assert rows(rows_of(facts, ["date_time"]), *one.columns) == rows(one, *one.columns)


def test_ranks_run_from_one_without_gaps(spark):
    e = sample_events(spark, "/root/testdata/sf0.01")
    top = users.daily_top_elements(e)
    gaps = top.groupBy("date", *users.SEGMENT).agg({"rank": "max", "*": "count"})
    assert gaps.where("`max(rank)` <> `count(1)` or `max(rank)` > 3").count() == 0
