"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Every query is run to its last row into Spark's noop sink
(or, for backfills and streams, into tables of its own) after one warm-up pass
over a small query.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks import spark_queries  # noqa: E402
from tidemark.plans.rollup import Rollups  # noqa: E402
from tidemark.sources.adapter import sample_events  # noqa: E402

HEADLINES = [
    "minutes_metrics",
    "minutes_metrics_day_run",
    "minutes_page_stats",
    "minutes_page_stats_next",
    "minutes_click_summary",
    "minutes_top_elements",
    "minutes_user_distribution",
    "hourly_metrics",
    "hourly_page_stats",
    "hourly_click_summary",
    "hourly_top_elements",
    "hourly_user_distribution",
    "daily_metrics",
    "daily_metrics_exact",
    "daily_page_stats",
    "daily_click_summary",
    "daily_top_elements",
    "daily_user_distribution",
    "weekly_metrics",
    "weekly_page_stats",
    "weekly_click_summary",
    "weekly_top_elements",
    "weekly_user_distribution",
    "page_stats_sliced_sessions",
    "new_vs_existing_join",
    "stream_clicks_10m",
    "stream_minutes_metrics",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def full_backfill(spark: SparkSession, sf_dir: str) -> None:
    """All twenty tables over the whole range of days, written to a store."""
    e = sample_events(spark, sf_dir)
    Rollups(spark, e, spark_queries.new_store(spark)).backfill(spark_queries.data_days(e))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = spark_queries.all_queries()
    queries["daily_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    full_backfill(spark, sf_dir)
    seconds["backfill_all_tables"] = round(time.perf_counter() - started, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "rollup queries, total wall time",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
