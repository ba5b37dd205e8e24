import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.crafted import at, event, events, rows
from tidemark.functions import numbers
from tidemark.operators import pages
from tidemark.plans import periods, skew
from tidemark.plans.rollup import Options, Rollups
from tidemark.sources.adapter import sample_events
from tidemark.sources.events import as_events
from tidemark.sources.store import RollupStore

MOVES = ("date_time", "page_path", "next_page")


def test_navigation_ends_with_the_run(spark):
    e = events(
        spark,
        event("10:01", page_path="/a"),
        event("10:02", page_path="/b"),
        event("10:11", page_path="/c"),
    )
    assert rows(pages.next_page(e), *MOVES) == [
        (at("10:00"), "/a", "/b"),
        (at("10:00"), "/b", None),
        (at("10:10"), "/c", None),
    ]
    assert rows(pages.page_exits(e), "page_path", "is_exit") == [("/a", 0), ("/b", 1), ("/c", 1)]


def test_blank_pages_are_no_stops(spark):
    e = events(
        spark,
        event("10:01", page_path="/a"),
        event("10:02", page_path=""),
        event("10:03", page_path="/b"),
    )
    assert rows(pages.next_page(e), "page_path", "next_page") == [("/a", "/b"), ("/b", None)]


def test_a_session_may_span_sites(spark):
    e = events(
        spark,
        event("10:01", page_path="/a", sdk_key="k0"),
        event("10:02", page_path="/b", sdk_key="k1"),
    )
    got = rows(pages.minutes_page_stats(e), "sdk_key", "page_path", "page_exits")
    assert got == [("k0", "/a", 0), ("k1", "/b", 1)]


def test_equal_timestamps_follow_event_id(spark):
    e = events(
        spark,
        event("10:01", page_path="/b", event_id=2),
        event("10:01", page_path="/a", event_id=1),
    )
    assert rows(pages.next_page(e), "page_path", "next_page") == [("/a", "/b"), ("/b", None)]


def walks(spark):
    path = ["/a", "/b", "/a", "/b", "/a", "/b", "/a", "/c"]
    return events(spark, *[event(f"10:0{i}", page_path=p) for i, p in enumerate(path)])


def test_next_pages_are_distinct_with_counts(spark):
    stats = pages.minutes_page_stats(walks(spark)).where("page_path = '/a'")
    [row] = stats.collect()
    assert [(m.to, m["count"]) for m in row.next_pages] == [("/b", 3), ("/c", 1)]
    assert (row.page_views, row.page_exits, row.drop_rate) == (4, 0, 0.0)
    assert rows(stats, "next_pages.to", "next_pages.count") == [(["/b", "/c"], [3, 1])]


def test_times_round_half_even_after_scaling(spark):
    e = events(
        spark,
        event("10:01", time_on_page_seconds=1.015),
        event("10:02", page_path="/n", time_on_page_seconds=None),
    )
    got = rows(pages.minutes_page_stats(e), "page_path", "avg_time_on_page_seconds")
    assert got == [("/a", 1.01), ("/n", None)]


def test_first_and_merged_lists(spark):
    e = events(
        spark,
        event("10:01", page_path="/a"),
        event("10:02", page_path="/b"),
        event("10:11", page_path="/a"),
        event("10:12", page_path="/c"),
        event("10:21", page_path="/a"),
        event("10:22", page_path="/c"),
    )
    lower = pages.minutes_page_stats(e)

    def lists(df):
        return [[tuple(m) for m in r.next_pages] for r in df.where("page_path = '/a'").collect()]

    assert lists(pages.hourly_page_stats(lower)) == [[("/b", 1)]]
    merged = pages.hourly_page_stats(lower, "merge")
    assert lists(merged) == [[("/c", 2), ("/b", 1)]]
    first = pages.hourly_page_stats(lower)
    scalars = ("date_time", "page_path", "page_views", "page_exits", "drop_rate", "avg_time_on_page_seconds")
    assert rows(first, *scalars) == rows(merged, *scalars)
    with pytest.raises(ValueError):
        pages.hourly_page_stats(lower, "any")


def test_rolled_up_time_is_a_mean_of_means(spark):
    e = events(
        spark,
        event("10:01", time_on_page_seconds=1.0),
        event("10:02", time_on_page_seconds=3.0),
        event("10:11", time_on_page_seconds=5.0),
    )
    hourly = pages.hourly_page_stats(pages.minutes_page_stats(e))
    assert rows(hourly, "page_views", "avg_time_on_page_seconds") == [(3, 3.5)]
    daily = pages.daily_page_stats(hourly)
    assert rows(daily, "date", "page_views", "avg_time_on_page_seconds") == [(date(2024, 1, 1), 3, 3.5)]


def test_mean_of_two_times_is_the_mean_of_doubles(spark):
    """1.01 + 1.02 is a little over 2.03, so half of it rounds up."""
    e = events(
        spark,
        event("10:01", time_on_page_seconds=1.01),
        event("10:11", time_on_page_seconds=1.02),
        event("10:21", time_on_page_seconds=None),
    )
    lower = pages.minutes_page_stats(e)
    for mode in ("first", "merge"):
        assert rows(pages.hourly_page_stats(lower, mode), "avg_time_on_page_seconds") == [(1.02,)]


def test_means_do_not_depend_on_row_order(spark):
    times = [((i * 7919) % 100003) / 100 for i in range(2000)] + [-3.37]
    e = events(spark, *[event("10:01", time_on_page_seconds=t, session_id=f"s{t}") for t in times])
    total = e.agg(*numbers.mean_sums(F.col("time_on_page_seconds"), "w", "r", "n"))
    mean = total.select(numbers.mean_of(F.col("w"), F.col("r"), F.col("n"))).first()[0]
    assert mean == math.fsum(times) / len(times)
    orders = {
        e.repartition(parts, "event_id")
        .agg(*numbers.mean_sums(F.col("time_on_page_seconds"), "w", "r", "n"))
        .first()
        for parts in (1, 3, 7)
    }
    assert len(orders) == 1


def test_absurd_times_do_not_fail_the_mean(spark):
    def mean(*times):
        e = events(spark, *[event("10:01", time_on_page_seconds=t) for t in times])
        return pages.minutes_page_stats(e).first().avg_time_on_page_seconds

    assert mean(1e300, 1.0) == 5e299
    assert mean(float("inf"), 1.0) == float("inf")
    assert math.isnan(mean(float("nan"), 1.0))


def test_moves_and_exits_make_up_the_views(spark):
    e = sample_events(spark, "/root/testdata/sf0.001")
    moves = pages.page_transitions(e).groupBy("date_time", "page_path", "sdk_key").agg(
        F.sum("to_count").alias("views"),
        F.sum(F.when(F.col("next_page").isNull(), F.col("to_count")).otherwise(0)).alias("exits"),
    )
    stats = pages.minutes_page_stats(e)
    keys = ("date_time", "page_path", "sdk_key")
    assert rows(moves, *keys, "views", "exits") == rows(stats, *keys, "page_views", "page_exits")
    assert stats.where("page_exits > page_views").count() == 0


@pytest.mark.parametrize("quota", [1, 3, 10, 40])
def test_cutting_hot_sessions_changes_nothing(spark, quota):
    """One session with most of the views, many at the same moment, beside small ones."""
    made = [
        event(f"10:0{i % 10}:{(i * 7) % 60:02d}.{i % 3}", page_path=f"/{i * i % 11}") for i in range(200)
    ]
    made += [event("10:03:11.5", page_path=f"/{i * i % 13}") for i in range(120)]
    made += [event("10:03:11.7", page_path=f"/{i % 5}") for i in range(60)]
    made += [event("10:00:00", page_path=f"/{i % 5}") for i in range(30)]
    made += [event(f"10:0{i}", session_id=f"t{i % 3}", page_path=f"/{i}") for i in range(9)]
    made += [event(f"10:1{i}", page_path=f"/{i}") for i in range(9)]
    e = events(spark, *made)
    hot = skew.measured_hot_sessions(e, quota)
    moments = hot.selectExpr("max(size(moments))").first()[0]
    assert moments >= (2 if quota == 40 else 3)
    columns = ("event_id", "date_time", "session_id", "page_path", "next_page")
    assert rows(pages.next_page(e, hot), *columns) == rows(pages.next_page(e), *columns)


def test_pieces_of_a_hot_session_stay_below_it(spark):
    """A moment with most of a session's views is cut by event id."""
    made = [event("10:05:00", page_path=f"/{i % 5}") for i in range(1000)]
    e = events(spark, *made, event("10:01"), event("10:07"))
    hot = skew.measured_hot_sessions(e, 100)
    sizes = (
        pages.page_views(e)
        .join(hot, pages.SESSION)
        .groupBy(pages._piece())
        .count()
        .agg({"count": "max"})
        .first()[0]
    )
    assert sizes <= 100


def test_ids_may_lie_anywhere(spark):
    ids = [(i * 0x9E3779B97F4A7C15) % 2**64 - 2**63 for i in range(400)]
    e = events(spark, *[event("10:05:00", page_path=f"/{i % 7}", event_id=n) for i, n in enumerate(ids)])
    hot = skew.measured_hot_sessions(e, 50)
    columns = ("event_id", "next_page")
    assert rows(pages.next_page(e, hot), *columns) == rows(pages.next_page(e), *columns)


def test_a_hot_moment_without_ids_is_cut_by_page(spark):
    made = [event("10:05:00", page_path=f"/{i % 7}", sdk_key=f"s{i % 2}") for i in range(400)]
    made += [event("10:04", page_path="/x"), event("10:06", page_path="/y")]
    e = as_events(events(spark, *made).drop("event_id"))
    hot = skew.measured_hot_sessions(e, 50)
    columns = ("date_time", "page_path", "sdk_key", "page_views", "page_exits", "next_pages")
    got = rows(pages.minutes_page_stats(e.repartition(5), hot), *columns)
    assert got == rows(pages.minutes_page_stats(e), *columns)


def test_hot_sessions_are_broadcast_only_when_counted_to_fit(spark):
    e = events(spark, *[event(f"10:0{i}", session_id=f"s{i % 4}") for i in range(8)])

    def plan(hot):
        return pages.next_page(e, hot)._jdf.queryExecution().optimizedPlan().toString()

    assert skew.measured_hot_sessions(e, quota=2) is None
    few = skew.measured_hot_sessions(e, quota=1)
    assert "strategy=broadcast" in plan(few)
    many = skew.measured_hot_sessions(e, quota=1, broadcast_rows=3)
    assert "strategy=broadcast" not in plan(many)
    columns = ("event_id", "next_page")
    assert rows(pages.next_page(e, many), *columns) == rows(pages.next_page(e), *columns)


def test_lists_are_a_view_of_stored_transitions(spark, tmp_path):
    made = [event(f"{h:02d}:{m:02d}", page_path=f"/{(h * 7 + m) % 5}") for h in (1, 2, 9) for m in range(0, 60, 3)]
    e, day = events(spark, *made), periods.backfill_days("2024-01-01", "2024-01-07", datetime(2024, 2, 1))
    families = ("page_stats", "page_transitions")
    for name, options in (("list", Options(next_pages="merge")), ("view", Options(next_pages="view"))):
        jobs = Rollups(spark, e, RollupStore(spark, str(tmp_path / name)), options)
        jobs.backfill(day, families)
    lists, views = (RollupStore(spark, str(tmp_path / n)) for n in ("list", "view"))
    for grain in ("minutes", "hourly", "daily", "weekly"):
        stats, moves = (views.read(f"{grain}_{f}") for f in families)
        assert stats.where("size(next_pages) > 0").isEmpty()
        want = lists.read(f"{grain}_page_stats")
        assert rows(pages.with_next_pages(stats, moves), *want.columns) == rows(want, *want.columns)
        short = pages.with_next_pages(stats, moves, 1).select(F.size("next_pages").alias("n"))
        assert {r[0] for r in rows(short, "n")} <= {0, 1}


def test_a_page_of_very_many_targets_is_rows(spark):
    """Two hundred thousand targets of one page: its statistics hold no list of them."""
    targets = 200_000
    views = spark.range(2 * targets).select(
        F.lit(at("10:00")).cast("timestamp_ntz").alias("timestamp"),
        F.lit("k").alias("sdk_key"),
        (F.col("id") / 2).cast("long").cast("string").alias("session_id"),
        F.when(F.col("id") % 2 == 0, "/hub").otherwise(F.concat(F.lit("/t"), F.col("id"))).alias("page_path"),
        F.lit(1.0).alias("time_on_page_seconds"),
        F.col("id").alias("event_id"),
    )
    hub = pages.minutes_page_stats(views, next_pages="view").where("page_path = '/hub'")
    assert rows(hub, "page_views", "page_exits") == [(targets, 0)]
    moves = pages.page_transitions(views).where("page_path = '/hub'")
    [row] = pages.with_next_pages(hub, moves, 3).collect()
    assert [n["count"] for n in row["next_pages"]] == [1, 1, 1]
