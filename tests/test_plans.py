"""The physical plans the operators are meant to get."""

from datetime import date

import pytest

from tidemark.operators import metrics, pages, users, visitors
from tidemark.sources.adapter import sample_events


@pytest.fixture(scope="module")
def e(spark):
    return sample_events(spark, "/root/testdata/sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ten_minute_metrics_need_no_join_window_or_multi_distinct(e):
    text = plan(metrics.minutes_metrics(e, visitors.first_seen(e)))
    for costly in ("Join", "Window", "Expand", "Sort "):
        assert costly not in text, costly
    assert text.count("Exchange") == 3


def test_sites_and_buckets_are_combined_before_the_shuffle(e):
    text = plan(metrics.minutes_metrics(e, visitors.first_seen(e)))
    assert "partial_sum(visitor" in text and "partial_min(timestamp" in text


def test_top_elements_are_cut_before_the_shuffle(e):
    text = plan(users.minutes_top_elements(e))
    assert text.count("WindowGroupLimit") == 2
    assert "row_number(), 3, Partial" in text


def test_rows_spread_over_segments_are_not_shuffled(e):
    """Two branches (elements and the rest) of three shuffles: collapsed clicks,
    the same by clicker, and counted facts. None of them sits right on an explode."""
    facts = users.segment_facts(users.minute_clicks(e), ["date_time"], users.KINDS)
    text = plan(facts)
    assert text.count("FileScan") == 2 and text.count("Exchange") == 6
    assert text.count("REPARTITION_BY_COL") == 2
    lines = text.split("\n")
    counted = [n for n, line in enumerate(lines) if "partial_sum(n#" in line and "segment_type" in line]
    first = next(n for n, line in enumerate(lines) if "Generate" in line)
    assert len(counted) >= 2 and counted[0] < first
    between = "\n".join(lines[counted[0] + 1 : first])
    assert "Exchange" not in between


def test_scalar_page_statistics_gather_no_lists(e):
    text = plan(pages.minutes_page_stats(e).drop("next_pages"))
    assert "collect_list" not in text
    assert text.count("Exchange") == 3


def test_nothing_leaves_the_jvm_or_crosses(e):
    hourly = pages.hourly_page_stats(pages.minutes_page_stats(e), "merge")
    for df in (hourly, users.weekly_top_elements(users.daily_top_elements(e), date(2024, 1, 1))):
        text = plan(df)
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
