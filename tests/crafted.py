"""Small hand-made event tables."""

from __future__ import annotations

from datetime import datetime
from itertools import count

from tidemark.schema import EVENTS

_ids = count(1)
DEFAULTS = {
    "sdk_key": "k0",
    "client_id": "a",
    "session_id": "s",
    "event_name": "auto_click",
    "page_path": "/a",
    "target_text": "btn",
    "user_gender": "female",
    "user_age": 25,
    "traffic_source": "direct",
    "device_type": "mobile",
    "time_on_page_seconds": 1.0,
}


def at(text: str) -> datetime:
    """``10:05`` on the first test day, or a full timestamp."""
    return datetime.fromisoformat(text if "-" in text else f"2024-01-01 {text}")


def event(when: str, **columns) -> tuple:
    row = {**DEFAULTS, "timestamp": at(when), "event_id": next(_ids), **columns}
    return tuple(row[name] for name in EVENTS.fieldNames())


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [str(v) for v in r])
