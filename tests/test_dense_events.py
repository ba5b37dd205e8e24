"""The queries against their SQL over denser, rougher events than the test tables
hold: many per bucket, whole seconds, ties, bucket and day boundaries."""

import json
import random
from datetime import datetime, timedelta

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from tests.compare import differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# A weekly backfill counts weeks from the first day of the data, its SQL from that of
# the test tables, so it is not among these.
GRAINS = ("minutes_", "hourly_", "daily_", "weekly_", "stream_minutes")
ROLLUPS = [n for n in QUERIES if n.startswith(GRAINS)] + [
    "backfill_daily_metrics",
    "page_stats_sliced_sessions",
    "page_transitions",
    "session_duration",
    "next_page",
    "sink_roundtrip",
]


@pytest.fixture(scope="module")
def dense(tmp_path_factory):
    """Three bursts of events around midnights in both zones and a week's turn."""
    rng = random.Random(7)
    bursts = [datetime(2024, 1, 6, 14, 40), datetime(2024, 1, 7, 23, 30), datetime(2024, 1, 8, 14, 30)]
    moments = []
    for start in bursts:
        for _ in range(500):
            second = rng.choice([0, 600, 1200, 1800, 3599, 3600, rng.randrange(4200)])
            fraction = rng.choice([0, 0, 0, 500_000, 999_999])
            moments.append(start + timedelta(seconds=second, microseconds=fraction))
    rows = {
        "event_id": list(range(len(moments))),
        "ts": moments,
        "user_id": [rng.choice([3, 3, 3, rng.randrange(40)]) for _ in moments],
        "event_type": [rng.choice(["click", "click", "view", "error"]) for _ in moments],
        "value": [rng.randrange(10000) / 100 for _ in moments],
        "props": [json.dumps({"k": rng.randrange(100)}) for _ in moments],
    }
    schema = pa.schema(
        [
            ("event_id", pa.int64()),
            ("ts", pa.timestamp("us")),
            ("user_id", pa.int64()),
            ("event_type", pa.string()),
            ("value", pa.float64()),
            ("props", pa.string()),
        ]
    )
    folder = tmp_path_factory.mktemp("dense")
    pq.write_table(pa.table(rows, schema=schema), folder / "events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet')")
    return str(folder), con


@pytest.mark.parametrize("name", ROLLUPS)
def test_query_agrees_with_sql(spark, dense, name):
    folder, con = dense
    problem, _ = differences(spark, con, QUERIES[name], SQL[name], folder)
    assert not problem
