"""Event predicates, age bands and audience segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event name that counts as a click, the age bands
# (label, first age, last age) and the two distribution names.
CLICK_EVENT = "auto_click"
AGE_BANDS = [
    ("10s", 10, 19),
    ("20s", 20, 29),
    ("30s", 30, 39),
    ("40s", 40, 49),
    ("50s", 50, 59),
]
OLDEST_BAND = ("60s+", 60)
UNKNOWN_BAND = "unknown"
AGE_DISTRIBUTION = "ageGroup"
DEVICE_DISTRIBUTION = "device"


def is_click(event_name: Column | None = None) -> Column:
    return (F.col("event_name") if event_name is None else event_name) == CLICK_EVENT


def non_empty(text: Column) -> Column:
    return F.length(text) > 0


def age_band(age: Column) -> Column:
    """Ten-year band; missing ages and those under ten are ``unknown``."""
    label, oldest = OLDEST_BAND
    banded = F.when(age >= oldest, label)
    for name, low, high in AGE_BANDS:
        banded = banded.when(age.between(low, high), name)
    return banded.otherwise(UNKNOWN_BAND)


def segments() -> list[tuple[str, Column]]:
    """Every audience dimension as (segment_type, segment_value)."""
    return [
        ("user_gender", F.col("user_gender")),
        ("traffic_source", F.col("traffic_source")),
        ("device_type", F.col("device_type")),
        ("user_age", age_band(F.col("user_age"))),
    ]


def labelled(pairs: list[tuple[str, Column]], label: str, value: str) -> Column:
    """Array of (label, value) structs, one per pair, ready for explode."""
    return F.array(*[F.struct(F.lit(n).alias(label), v.alias(value)) for n, v in pairs])
