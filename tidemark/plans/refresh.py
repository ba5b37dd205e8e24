"""Carries late data upwards: only the hours, days and weeks it touches are made again.

A ledger holds the ten-minute buckets that streams or late files have changed. From these come
the hours, from closed hours the days, from closed days the weeks. A period that is not closed
yet waits in the ledger. Every step makes whole periods from the grain below and replaces them,
so a refresh that fails half-way can be run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from contextlib import ExitStack
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import metrics, pages, users
from tidemark.plans import skew
from tidemark.plans.ledger import ARRIVED, BUCKET, SCHEMA, Ledger
from tidemark.plans.periods import runs_of_days
from tidemark.plans.rollup import BY_BASE_DAY, LOWER, Rollups
from tidemark.schema import FAMILIES, TABLES
from tidemark.sources.arrivals import Arrivals
from tidemark.sources.events import as_events, limit_events, rebase
from tidemark.sources.scratch import staged

# Levels of the ledger. Days and weeks of the per-segment tables are those of the report zone.
HOUR, DAY, WEEK, REPORT_DAY, REPORT_WEEK = "hour", "day", "week", "report_day", "report_week"
LENGTH = {HOUR: "1 HOUR", DAY: "1 DAY", REPORT_DAY: "1 DAY", WEEK: "7 DAYS", REPORT_WEEK: "7 DAYS"}


class Refresh:
    def __init__(
        self,
        jobs: Rollups,
        ledger: Ledger,
        week_anchor: date,
        families: Iterable[str] = tuple(FAMILIES),
        day_clicks: Callable[[DataFrame], DataFrame] | None = None,
        arrivals: Arrivals | None = None,
    ):
        """``day_clicks`` gives the clicks of some days (``unit``) of the report zone with their
        ``date``: a stream's are those of its state. Without it they come from the events table,
        that of ``arrivals`` where files are still added to it. Weeks count from ``week_anchor``."""
        self.jobs = jobs
        self.spark, self.store = jobs.spark, jobs.store
        self.ledger = ledger
        self.anchor = week_anchor
        self.families = tuple(families)
        self.day_clicks = day_clicks or self._day_clicks
        self.arrivals = arrivals

    def pick_up(self, until: datetime) -> None:
        """Take in the files that came since the last time, up to ``until``: the ten-minute
        tables of the buckets they touch are made again from the events table."""
        if self.jobs.seen_log is None or self.arrivals is None:
            raise ValueError("late files need the table they come to, and a first-seen log")
        o = self.jobs.options
        run = f"arrived-{until:%Y%m%dT%H%M%S%f}"
        came = self.arrivals.since(self.ledger.arrived(), until)
        if came is not None:
            events = rebase(as_events(came, o.source_zone), o.source_zone, o.base_zone)
            self.jobs.seen_log.update(events, run)
            own = events.select(times.ten_minutes(F.col("timestamp")).alias("unit"))
            moved = self.jobs.seen_log.replaced_by(run).select(
                times.ten_minutes(F.col("replaced")).alias("unit")
            )
            with staged(own.union(moved).distinct(), "arrived") as units:
                if days := _days(units):
                    self._minutes(units, days)
                    self.ledger.mark(units, run)
        at = [(ARRIVED, until)]
        self.ledger.put(self.spark.createDataFrame(at, SCHEMA), f"{run}-until")

    def _minutes(self, units: DataFrame, days: list[str]) -> None:
        o = self.jobs.options
        events = rebase(self._events(days, o.base_zone), o.source_zone, o.base_zone)
        bucket = times.ten_minutes(F.col("timestamp"))
        touched = events.withColumn("unit", bucket).join(F.broadcast(units), "unit", "left_semi")
        with staged(touched.drop("unit"), "arrived-events") as own:
            for family in self.families:
                self.store.write_units(f"minutes_{family}", self._minute_rows(family, own), units)

    def _minute_rows(self, family: str, events: DataFrame) -> DataFrame:
        if family == "metrics":
            return metrics.minutes_metrics(events, self.jobs.seen_log.read(events))
        if family.startswith("page_"):
            o = self.jobs.options
            hot = skew.measured_hot_sessions(events, o.session_quota)
            if family == "page_transitions":
                return pages.page_transitions(events, hot)
            return pages.minutes_page_stats(events, hot, o.next_pages)
        return getattr(users, f"minutes_{family}")(events)

    def run(self, closed_to: datetime) -> None:
        """Make all periods again that have changed below and end by ``closed_to``, wall-clock
        time of the base zone."""
        o = self.jobs.options
        moment = F.lit(str(closed_to)).cast("timestamp_ntz")
        report_to = times.in_zone(moment, o.base_zone, o.report_zone)
        folders, entries = self.ledger.open()
        others = [f for f in self.families if f not in BY_BASE_DAY]
        base = [f for f in self.families if f in BY_BASE_DAY]
        # What is due of one level names that of the next, so all of it stays till the end.
        with ExitStack() as stack:
            marked = stack.enter_context(staged(entries, "ledger"))
            rest = [marked.where(F.col("level") == ARRIVED)]

            def due(level: str, found: DataFrame, closed: Column = moment) -> DataFrame:
                """What is marked or found of a level, if it is closed; else it stays marked."""
                units = found.select(F.col("unit").cast("timestamp_ntz"))
                units = units.union(_marked(marked, level)).distinct()
                late = F.col("unit") + F.expr(f"INTERVAL {LENGTH[level]}") > closed
                rest.append(units.where(late).select(F.lit(level).alias("level"), F.col("unit").alias("start")))
                return stack.enter_context(staged(units.where(~late), f"due-{level}"))

            buckets = _marked(marked, BUCKET)
            hours = due(HOUR, buckets.select(times.hour(F.col("unit")).alias("unit")))
            self._roll("hourly", self.families, hours)
            if base:
                days = due(DAY, hours.select(times.day(F.col("unit")).alias("unit")))
                self._roll("daily", base, days)
                self._roll("weekly", base, due(WEEK, self._weeks(days)))
            if others:
                # A bucket may lie in two days of another zone.
                ends = [F.col("unit"), F.col("unit") + F.expr("INTERVAL '9:59.999999' MINUTE TO SECOND")]
                dates = F.array(*(times.zone_day(e, o.base_zone, o.report_zone) for e in ends))
                days = due(REPORT_DAY, buckets.select(F.explode(dates).alias("unit")), report_to)
                self._report_days(others, days)
                self._roll("weekly", others, due(REPORT_WEEK, self._weeks(days), report_to))
            left = stack.enter_context(staged(reduce(DataFrame.unionByName, rest), "ledger-rest"))
            self.ledger.settle(folders, left)

    def _weeks(self, days: DataFrame) -> DataFrame:
        return days.select(times.week_of(F.col("unit").cast("date"), self.anchor).alias("unit"))

    def _roll(self, grain: str, families: Iterable[str], units: DataFrame) -> None:
        """Make the rows of some units of a grain from the grain below."""
        days = _days(units, 7 if grain == "weekly" else 1)
        if not days:
            return
        for family in families:
            lower = TABLES[f"{LOWER[grain]}_{family}"]
            parts = [self.store.read(lower.name, run) for run in runs_of_days(days)]
            rows = reduce(DataFrame.unionByName, parts)
            name = f"{grain}_{family}"
            made = self.jobs.rolled(name, rows, self.anchor)
            key = TABLES[name].time_column
            wanted = units.select(F.col("unit").cast(TABLES[name].schema[key].dataType).alias(key))
            made = made.join(F.broadcast(wanted), key, "left_semi")
            self.store.write_units(name, made, units)

    def _report_days(self, families: list[str], days: DataFrame) -> None:
        if days.isEmpty():
            return
        kinds = [k for f in families for k in users.FAMILY_FACTS[f][0]]
        facts = users.segment_facts(self.day_clicks(days), ["date"], kinds)
        with staged(facts, "day-facts", "kind") as rows:
            for family in families:
                made = users.FAMILY_FACTS[family][1](rows, ["date"])
                self.store.write_units(f"daily_{family}", made, days)

    def _day_clicks(self, days: DataFrame) -> DataFrame:
        """Clicks of some days from the events table."""
        o = self.jobs.options
        events = self._events(_days(days), o.report_zone)
        clicks = users.day_clicks(events, o.source_zone, o.report_zone)
        wanted = F.broadcast(days.select(F.col("unit").cast("date").alias("date")))
        return clicks.join(wanted, "date", "left_semi")

    def _events(self, days: list[str], zone: str) -> DataFrame:
        """Events of some days of a zone, as they are stored; other days are not listed."""
        o = self.jobs.options
        spans = [run.in_zone(zone, o.source_zone) for run in runs_of_days(days)]
        if self.arrivals is None:
            parts = [limit_events(self.jobs.events, span, o.source_zone) for span in spans]
        else:
            parts = [self.arrivals.of_period(span, o.source_zone) for span in spans]
        return reduce(DataFrame.unionByName, parts)


def _marked(entries: DataFrame, level: str) -> DataFrame:
    return entries.where(F.col("level") == level).select(F.col("start").alias("unit"))


def _days(units: DataFrame, length: int = 1) -> list[str]:
    """The days that units of some days' length cover: one row per day."""
    first = F.col("unit").cast("date")
    days = F.explode(F.sequence(first, F.date_add(first, length - 1))).alias("day")
    return sorted(str(r.day) for r in units.select(days).distinct().collect())
