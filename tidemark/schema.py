"""Column layout of the event input and of the twenty rollup tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("sdk_key", T.StringType(), False),
        T.StructField("client_id", T.StringType(), False),
        T.StructField("session_id", T.StringType(), False),
        T.StructField("event_name", T.StringType(), False),
        T.StructField("page_path", T.StringType(), False),
        T.StructField("target_text", T.StringType(), False),
        T.StructField("user_gender", T.StringType()),
        T.StructField("user_age", T.IntegerType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("time_on_page_seconds", T.DoubleType()),
        T.StructField("event_id", T.LongType()),
    ]
)

# What the watermarked click counts give.
CLICKS = "date_time timestamp_ntz, sdk_key string, clicks long"

NEXT_PAGES = T.ArrayType(T.StructType().add("to", T.StringType()).add("count", T.LongType()))

_SEGMENT = [("segment_type", T.StringType()), ("segment_value", T.StringType())]

FAMILIES = {
    "metrics": [
        ("clicks", T.LongType()),
        ("visitors", T.LongType()),
        ("new_visitors", T.LongType()),
        ("existing_visitors", T.LongType()),
        ("avg_session_seconds", T.LongType()),
    ],
    "page_stats": [
        ("page_path", T.StringType()),
        ("page_views", T.LongType()),
        ("page_exits", T.LongType()),
        ("drop_rate", T.DoubleType()),
        ("next_pages", NEXT_PAGES),
        ("avg_time_on_page_seconds", T.DoubleType()),
    ],
    "click_summary": _SEGMENT
    + [
        ("total_clicks", T.LongType()),
        ("total_users", T.LongType()),
        ("avg_clicks_per_user", T.DoubleType()),
    ],
    "top_elements": _SEGMENT
    + [
        ("element", T.StringType()),
        ("total_clicks", T.LongType()),
        ("user_count", T.LongType()),
        ("rank", T.IntegerType()),
    ],
    "user_distribution": _SEGMENT
    + [
        ("dist_type", T.StringType()),
        ("dist_value", T.StringType()),
        ("user_count", T.LongType()),
    ],
}

# Families that jobs make on request, beside the twenty tables. Page transitions are the long form
# of ``next_pages``: a page's targets are rows, however many.
MORE_FAMILIES = {
    "page_transitions": [
        ("page_path", T.StringType()),
        ("next_page", T.StringType()),
        ("to_count", T.LongType()),
    ],
}
_COLUMNS = FAMILIES | MORE_FAMILIES

# grain -> (time column, its type, partition columns from coarse to fine).
GRAINS = {
    "minutes": ("date_time", T.TimestampNTZType(), ["dt", "span"]),
    "hourly": ("date_time", T.TimestampNTZType(), ["dt", "span"]),
    "daily": ("date", T.DateType(), ["dt"]),
    "weekly": ("date", T.DateType(), ["dt"]),
}


@dataclass(frozen=True)
class Table:
    grain: str
    family: str

    @property
    def name(self) -> str:
        return f"{self.grain}_{self.family}"

    @property
    def time_column(self) -> str:
        return GRAINS[self.grain][0]

    @property
    def partitions(self) -> list[str]:
        return GRAINS[self.grain][2]

    @property
    def columns(self) -> list[str]:
        return [self.time_column, *(n for n, _ in _COLUMNS[self.family]), "sdk_key"]

    @property
    def schema(self) -> T.StructType:
        out = T.StructType().add(self.time_column, GRAINS[self.grain][1])
        for name, kind in _COLUMNS[self.family]:
            out = out.add(name, kind)
        return out.add("sdk_key", T.StringType())

    @property
    def stored_schema(self) -> T.StructType:
        out = self.schema
        for name in self.partitions:
            out = out.add(name, T.StringType())
        return out


TABLES = {t.name: t for t in (Table(g, f) for g in GRAINS for f in _COLUMNS)}
