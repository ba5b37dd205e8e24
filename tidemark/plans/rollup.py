"""Run one table for one period, or backfill all of them over a range of days."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import times
from tidemark.operators import metrics, pages, users
from tidemark.operators.visitors import first_seen
from tidemark.plans import skew
from tidemark.plans.periods import (
    DAY,
    HOUR,
    TEN_MINUTES,
    Period,
    complete_weeks,
    require_whole,
    run_period,
)
from tidemark.schema import FAMILIES, TABLES
from tidemark.sources.events import events_before, limit_events, rebase
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.scratch import staged
from tidemark.sources.store import RollupStore

# Families whose daily tables come from hourly ones; those of the others from events.
BY_BASE_DAY = ("metrics", "page_stats", "page_transitions")
LOWER = {"hourly": "minutes", "daily": "hourly", "weekly": "daily"}


@dataclass(frozen=True)
class Options:
    """``source_zone`` is the zone events are stored in, ``base_zone`` the one of
    the ten-minute, hour and day buckets, ``report_zone`` the one of the days in
    the per-segment daily tables."""

    source_zone: str = "UTC"
    base_zone: str = "UTC"
    report_zone: str = "Asia/Seoul"
    closed_end: bool = False
    next_pages: str = "first"
    session_quota: int = skew.SESSION_QUOTA


class Rollups:
    def __init__(
        self,
        spark: SparkSession,
        events: DataFrame,
        store: RollupStore,
        options: Options = Options(),
        seen_log: FirstSeenLog | None = None,
    ):
        self.spark = spark
        self.events = events
        self.store = store
        self.options = options
        self.seen_log = seen_log

    def _base_events(self, period: Period) -> DataFrame:
        o = self.options
        span = period.in_zone(o.base_zone, o.source_zone)
        stored = limit_events(self.events, span, o.source_zone)
        return rebase(stored, o.source_zone, o.base_zone)

    def _click_events(self, period: Period) -> DataFrame:
        """Minute clicks of the period; with ``closed_end`` also those at its end."""
        if self.options.closed_end:
            period = Period(period.start, period.end + timedelta(microseconds=1))
        return self._base_events(period)

    def _report_events(self, period: Period) -> DataFrame:
        o = self.options
        span = period.in_zone(o.report_zone, o.source_zone)
        return limit_events(self.events, span, o.source_zone)

    def _seen(self, period: Period) -> DataFrame:
        """First times within the period; earlier ones do not make anybody new."""
        o = self.options
        if self.seen_log is not None:
            seen = self.seen_log.read(self._base_events(period))
        else:
            end = period.in_zone(o.base_zone, o.source_zone).end
            history = events_before(self.events, end, o.source_zone)
            history = rebase(history, o.source_zone, o.base_zone)
            seen = first_seen(history)
        return seen.where(seen.first_seen >= times.at(period.start))

    def _run_grain(self, period: Period) -> str:
        """A single run is ten minutes, an hour or a day; other spans must say which
        runs they are made of."""
        span = period.end - period.start
        grain = {TEN_MINUTES: "10m", HOUR: "1h", DAY: "1d"}.get(span)
        if grain is None:
            raise ValueError(f"{span} is no single run; give run_grain")
        return grain

    def compute(self, name: str, period: Period, run_grain: str | None = None) -> DataFrame:
        """The rows of one table for one period. Lazy, but for page statistics a
        counting pass looks for hot sessions first."""
        table = TABLES[name]
        require_whole(period, table.grain)
        o = self.options
        if table.grain == "minutes":
            return self._minutes(table.family, period, run_grain)
        if table.grain == "daily" and table.family not in BY_BASE_DAY:
            kinds, rows_of = users.FAMILY_FACTS[table.family]
            return rows_of(self._day_facts(period, kinds), ["date"])
        lower = self.store.read(f"{LOWER[table.grain]}_{table.family}", period)
        return self.rolled(name, lower, period.start.date())

    def rolled(self, name: str, lower: DataFrame, anchor: date) -> DataFrame:
        """Rows of a table from those of the grain below; weeks count from ``anchor``."""
        table = TABLES[name]
        module = pages if table.family.startswith("page_") else users
        module = metrics if table.family == "metrics" else module
        extra = {"next_pages": self.options.next_pages} if table.family == "page_stats" else {}
        if table.grain == "weekly":
            extra["anchor"] = anchor
        return getattr(module, name)(lower, **extra)

    def _minutes(self, family: str, period: Period, run_grain: str | None) -> DataFrame:
        if family == "metrics":
            runs = run_grain or self._run_grain(period)
            return metrics.minutes_metrics(self._base_events(period), self._seen(period), runs)
        if family.startswith("page_"):
            events = self._base_events(period)
            hot = skew.measured_hot_sessions(events, self.options.session_quota)
            if family == "page_transitions":
                return pages.page_transitions(events, hot)
            return pages.minutes_page_stats(events, hot, self.options.next_pages)
        kinds, rows_of = users.FAMILY_FACTS[family]
        keys = users.minute_keys(self.options.closed_end)
        return rows_of(self._minute_facts(period, kinds), keys)

    def _minute_facts(self, period: Period, kinds: list[str]) -> DataFrame:
        closed = self.options.closed_end
        clicks = users.minute_clicks(self._click_events(period), closed)
        if closed:
            clicks = clicks.where((clicks.run >= period.start) & (clicks.run < period.end))
        return users.segment_facts(clicks, users.minute_keys(closed), kinds)

    def _day_facts(self, period: Period, kinds: list[str]) -> DataFrame:
        o = self.options
        clicks = users.day_clicks(
            self._report_events(period), o.source_zone, o.report_zone, o.closed_end
        )
        return users.segment_facts(clicks, ["date"], kinds)

    def run(self, name: str, period: Period, run_grain: str | None = None) -> None:
        """Compute one table for one period and replace that period in the store."""
        require_whole(period, TABLES[name].grain)
        if name == "minutes_metrics" and self.seen_log is not None:
            run_id = f"{period.start:%Y%m%dT%H%M}-{period.end:%Y%m%dT%H%M}"
            self.seen_log.update(self._base_events(period), run_id)
        self.store.write(name, self.compute(name, period, run_grain), period)

    def run_latest(self, grain: str, now: datetime | None = None) -> None:
        """All tables of a grain for the last closed period. "Yesterday" is that of
        the zone a table reports its days in. ``now`` is zone-aware."""
        now = now or datetime.now(timezone.utc)

        def latest(zone: str) -> Period:
            return run_period(grain, None, now.astimezone(ZoneInfo(zone)).replace(tzinfo=None))

        base = latest(self.options.base_zone)
        report = latest(self.options.report_zone) if grain == "daily" else base
        self.run_grain(grain, base, None, report)

    def run_grain(
        self,
        grain: str,
        period: Period,
        run_grain: str | None = None,
        segment_period: Period | None = None,
        families: Iterable[str] = tuple(FAMILIES),
    ) -> None:
        """All five tables of a grain, or those of some families. The three per-segment
        tables that read events are made from facts written once; their period may be given
        apart from that of the others."""
        families = tuple(families)
        for family in BY_BASE_DAY:
            if family in families:
                self.run(f"{grain}_{family}", period, run_grain)
        period = segment_period or period
        shared = [f for f in families if f not in BY_BASE_DAY]
        if not shared:
            return
        if grain not in ("minutes", "daily"):
            for family in shared:
                self.run(f"{grain}_{family}", period)
            return
        if grain == "minutes":
            keys = users.minute_keys(self.options.closed_end)
            facts = self._minute_facts(period, users.KINDS)
        else:
            keys = ["date"]
            facts = self._day_facts(period, users.KINDS)
        with staged(facts, "segment-facts", "kind") as rows:
            for family in shared:
                _, rows_of = users.FAMILY_FACTS[family]
                self.store.write(f"{grain}_{family}", rows_of(rows, keys), period)

    def backfill(self, days: Period, families: Iterable[str] = tuple(FAMILIES)) -> None:
        """Every grain over whole days, lower grains first, one bulk job per table. Page
        transitions are made where ``families`` names them.

        Minutes are ten-minute runs whatever the range. Weeks count from the first
        day, and only complete ones are written.
        """
        self.run_grain("minutes", days, "10m", families=families)
        self.run_grain("hourly", days, families=families)
        self.run_grain("daily", days, families=families)
        weeks = complete_weeks(days)
        if weeks:
            self.run_grain("weekly", weeks, families=families)
