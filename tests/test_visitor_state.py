"""First-seen state in buckets: the same answers as the log, without a shuffle of the state."""

import pytest
from pyspark.sql import functions as F

from tests.crafted import at, event, events, rows
from tidemark.operators import visitors
from tidemark.plans import periods
from tidemark.plans.rollup import Rollups
from tidemark.sources import visitor_state
from tidemark.sources.adapter import sample_events
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.store import RollupStore
from tidemark.sources.visitor_state import VisitorState

COLUMNS = ["client_id", "sdk_key", "first_seen"]


@pytest.fixture
def state(spark, tmp_path):
    return VisitorState(spark, str(tmp_path / "state"), buckets=4)


def first(spark):
    return events(spark, event("10:05"), event("10:06", client_id="b"))


def late(spark):
    return events(spark, event("09:55"), event("10:07", client_id="b"), event("10:08", client_id="c"))


@pytest.mark.parametrize("few", [0, 500])
def test_folds_keep_the_state_of_the_log(spark, state, tmp_path, monkeypatch, few):
    monkeypatch.setattr(visitor_state, "FEW", few)
    log = FirstSeenLog(spark, str(tmp_path / "log"))
    assert state.base() is None and state.read().count() == 0
    state.fold()
    assert state.runs() == []
    for run, made in (("r1", first(spark)), ("r2", late(spark))):
        for _ in range(2):
            state.update(made, run)
            log.update(made, run)
        assert rows(state.replaced_by(run), "client_id", "replaced") == rows(log.replaced_by(run), "client_id", "replaced")
        assert rows(state.read(), *COLUMNS) == rows(log.read(), *COLUMNS)
        state.fold([run])
        assert state.runs() == []
        assert rows(state.read(), *COLUMNS) == rows(log.read(), *COLUMNS)
    assert rows(state.read(first(spark).where("client_id = 'a'")), *COLUMNS) == [("a", "k0", at("09:55"))]
    state.update(late(spark), "r2")  # a folded run once more finds nothing earlier
    assert state.read().count() == 3 and state._entries().count() == 0
    assert [b[0] for b in state._bases()] == [0, 1]


def test_a_fold_takes_only_settled_runs_and_may_end_half_way(spark, state):
    state.update(first(spark), "r1")
    state.update(late(spark), "r2")
    whole = rows(state.read(), *COLUMNS)
    drop, state._drop = state._drop, lambda run: None
    state.fold(["r1", "unknown"])
    state._drop = drop
    assert state.runs() == ["r1", "r2"] and rows(state.read(), *COLUMNS) == whole
    state.fold(["r1"])
    assert state.runs() == ["r2"] and rows(state.read(), *COLUMNS) == whole
    assert rows(state.replaced_by("r2"), "client_id") == [("a",)]
    # Another session, or another wish for buckets, finds the base as it is.
    other = VisitorState(spark, state.path, buckets=16)
    other.fold()
    assert rows(other.read(), *COLUMNS) == whole and other._bases()[-1][1] == 4


def test_sites_do_not_mix(spark, state):
    made = [event("10:00", sdk_key="1", client_id="1a"), event("10:01", sdk_key="11", client_id="a")]
    made += [event("10:02", sdk_key="", client_id="11a"), event("10:03", sdk_key="1:1", client_id="a")]
    state.update(events(spark, *made), "r")
    state.fold()
    assert state.read().count() == 4


def test_no_tables_stay_in_the_catalog(spark, state):
    state.update(first(spark), "r")
    state.fold()
    state.read().count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_visitors")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_base_is_not_shuffled_and_few_visitors_read_their_buckets(spark, state):
    e = sample_events(spark, "/root/testdata/sf0.001")
    state.update(e, "all")
    state.fold()
    one = e.where("client_id is not null").orderBy("event_id").limit(1)
    assert "SelectedBucketsCount: 1 out of 4" in plan(state.read(one))
    base = state.base()
    asked = e.select(visitor_state.visitor().alias("visitor"))
    added = visitors.first_seen(e).withColumn("visitor", visitor_state.visitor())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for joined in (visitor_state.of_visitors(base, asked, 4), visitor_state.merged(base, added, 4)):
            text = plan(joined)
            lines = text.split("\n")
            join = next(n for n, line in enumerate(lines) if "SortMergeJoin" in line)
            scan = next(n for n, line in enumerate(lines) if "Bucketed: true" in line)
            assert join < scan and "Exchange" not in "\n".join(lines[join:scan]), text
            assert joined.count() == base.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_runs_with_the_state_equal_runs_over_history(spark, state, tmp_path):
    made = [event("09:55"), event("10:05"), event("10:06", client_id="b")]
    results = []
    for name, seen in (("plain", None), ("state", state)):
        if seen is not None:
            seen.update(events(spark, *made), "backfill")
            seen.fold()
        store = RollupStore(spark, str(tmp_path / name))
        jobs = Rollups(spark, events(spark, *made), store, seen_log=seen)
        for minute in ("09:50", "10:00"):
            jobs.run("minutes_metrics", periods.ten_minutes(f"2024-01-01T{minute}"))
        results.append(rows(store.read("minutes_metrics"), "date_time", "visitors", "new_visitors"))
    assert results[0] == results[1] == [(at("09:50"), 1, 1), (at("10:00"), 2, 1)]


def test_new_and_existing_by_state(spark, state):
    e = events(spark, event("09:55"), event("10:05"), event("10:06", client_id="b"))
    state.update(e, "r")
    state.fold()
    start, end = at("10:00"), at("10:10")
    run = e.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    got = visitors.new_and_existing_of(run, state.read(run), start)
    want = visitors.new_and_existing(e, start, end)
    assert rows(got, *want.columns) == rows(want, *want.columns) == [(start, "k0", 2, 1, 1)]
