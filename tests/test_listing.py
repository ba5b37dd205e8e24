import pytest

from tests.crafted import events, event, rows
from tidemark.operators import metrics, visitors
from tidemark.schema import TABLES
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.listing import MOST_DAYS, by_day
from tidemark.sources.store import RollupStore
from tidemark.streaming import minutes, state

DAYS = [f"2024-{month:02}-{day:02}" for month in (1, 2) for day in range(1, 29)]


@pytest.mark.parametrize("some", [DAYS[:3], DAYS])
def test_folders_of_days_are_listed_by_day(spark, tmp_path, some):
    for day in [*DAYS, "2024-02-29"]:
        (tmp_path / "a,b" / f"dt={day}" / "span=10").mkdir(parents=True)
        (tmp_path / "a,b" / f"dt={day}" / "span=11").mkdir()
    assert (len(some) > MOST_DAYS) == (some is DAYS)
    root = str(tmp_path / "a,b")
    assert by_day(spark, root, [*some, "2030-01-01"]) == {d: [f"file:{root}/dt={d}"] for d in some}
    found = by_day(spark, root, some, "/span=1*")
    assert {d: sorted(paths) for d, paths in found.items()} == {
        d: [f"file:{root}/dt={d}/span={hour}" for hour in (10, 11)] for d in some
    }
    assert by_day(spark, root, some, "/span=2*") == {}
    assert by_day(spark, f"{root}/none", some) == {}
    assert by_day(spark, root, []) == {}


def new_stream(spark, tmp_path):
    store = RollupStore(spark, str(tmp_path / "tables"))
    log = FirstSeenLog(spark, str(tmp_path / "seen"))
    return minutes.MinuteStream(spark, str(tmp_path / "state"), log, store, ("metrics",))


def test_a_batch_of_new_events_alone_is_not_cut_again(spark, tmp_path, monkeypatch):
    stream = new_stream(spark, tmp_path)
    calls, cut = [], state.BucketState.new_events
    monkeypatch.setattr(state.BucketState, "new_events", lambda *a: calls.append(a) or cut(*a))
    batches = [events(spark, event("10:01")), events(spark, event("10:02"), event("10:02"))]
    batches[1] = batches[1].withColumn("event_id", batches[1].event_id + 100)
    for i, batch in enumerate(batches):
        stream.process(batch, i)
    assert not calls
    stream.process(batches[1].union(batches[0]), 2)
    assert len(calls) == 1
    stream.process(batches[0].union(batches[0]), 3)
    assert len(calls) == 2
    want = metrics.minutes_metrics(batches[0].union(batches[1]), visitors.first_seen(batches[0].union(batches[1])))
    columns = TABLES["minutes_metrics"].columns
    assert rows(stream.store.read("minutes_metrics"), *columns) == rows(want, *columns)


def test_many_days_of_a_batch_are_written_by_many_tasks(spark, tmp_path):
    stream = new_stream(spark, tmp_path)
    e = events(spark, event("10:01"), event("10:02", client_id="b"))
    days = spark.createDataFrame([(i,) for i in range(len(DAYS))], "i int")
    many = e.crossJoin(days).selectExpr(
        "* except (i, timestamp, event_id)", "timestamp + make_dt_interval(i) as timestamp", "event_id * 100 + i as event_id"
    )
    stream.process(many, 0)
    ids = spark.read.parquet(f"{stream.state.root}/{state.IDS}").selectExpr("_metadata.file_name as name")
    tasks = {r.name.split("-")[1] for r in ids.distinct().collect()}
    assert len(tasks) > 1
    columns = TABLES["minutes_metrics"].columns
    want = metrics.minutes_metrics(many, visitors.first_seen(many))
    assert rows(stream.store.read("minutes_metrics"), *columns) == rows(want, *columns)
