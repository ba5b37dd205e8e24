"""The generated test table ``events`` seen as clickstream events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_clickstream(raw: DataFrame) -> DataFrame:
    user = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    sources = ["direct", "search", "social", "ad"]
    source = F.when(user % 4 == 0, sources[0])
    for i, name in enumerate(sources[1:], start=1):
        source = source.when(user % 4 == i, name)
    return raw.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("sdk_"), user % 3).alias("sdk_key"),
        F.concat(F.lit("c"), user).alias("client_id"),
        F.concat(F.lit("s"), user % 5).alias("session_id"),
        F.when(kind == "click", "auto_click")
        .when(kind == "view", "page_view")
        .otherwise(kind)
        .alias("event_name"),
        F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("/p"), k % 10)).alias("page_path"),
        F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("btn"), k % 6)).alias("target_text"),
        F.when(user % 7 == 0, None)
        .when(user % 2 == 0, "female")
        .otherwise("male")
        .alias("user_gender"),
        F.when(user % 11 == 0, None).otherwise(5 + (user * 7) % 70).cast("int").alias("user_age"),
        source.alias("traffic_source"),
        F.when(user % 13 == 0, "")
        .when(user % 2 == 0, "mobile")
        .otherwise("desktop")
        .alias("device_type"),
        F.col("value").alias("time_on_page_seconds"),
        "event_id",
    )


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_clickstream(spark.read.parquet(f"{sf_dir}/events.parquet"))
