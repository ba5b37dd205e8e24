"""Keeps the ten-minute tables current from a stream of events.

Each micro-batch is cut to partial results of the buckets it touches, which merge with those of
the batches before (``state``); touched buckets are then made from their partials and replaced
whole. Distinct counts, navigation and first visits are therefore those of the batch rollups,
also where a bucket's events arrive over several batches, late, or twice.

Where a backfill wrote buckets of the same store, the stream takes the backfill's events
too: a touched bucket is then made from both, an event that both have counting once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import times
from tidemark.plans import skew
from tidemark.plans.ledger import Ledger
from tidemark.plans.periods import TEN_MINUTES, Period, runs_of_days
from tidemark.plans.rollup import Options
from tidemark.schema import EVENTS, FAMILIES
from tidemark.sources.events import as_events, limit_events, rebase
from tidemark.sources.first_seen import FirstSeenLog
from tidemark.sources.scratch import scratch_path, staged
from tidemark.sources.store import RollupStore
from tidemark.streaming.state import BucketState, Tag

FAMILIES = tuple(FAMILIES)
COLUMNS = [*EVENTS.fieldNames(), times.INSTANT]


class MinuteStream:
    def __init__(
        self,
        spark: SparkSession,
        state_path: str,
        seen_log: FirstSeenLog,
        store: RollupStore,
        families: tuple[str, ...] = FAMILIES,
        session_quota: int = skew.SESSION_QUOTA,
        options: Options = Options(),
        history: Callable[[], DataFrame] | None = None,
        ledger: Ledger | None = None,
    ):
        """``options`` are those of the batch store beside it: the zones events are stored
        and bucketed in. Runs closed at both ends are not for streams.

        ``history`` reads the events table that batch jobs fill the same store from, as
        ``read_events`` does; it is called for each batch, so that files added since are
        seen. ``seen_log`` must know its visitors. Without it, a batch that would replace
        a bucket no stream made is refused before anything is written.

        ``ledger`` is told which buckets a batch replaced, for ``Refresh`` to carry them to the
        hourly, daily and weekly tables."""
        if options.closed_end:
            raise ValueError("a stream has no closed runs")
        self.spark = spark
        self.options = options
        self.state = BucketState(spark, state_path, families, options.report_zone)
        self.seen_log = seen_log
        self.store = store
        self.families = families
        self.session_quota = session_quota
        self.history = history
        self.ledger = ledger

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch. Every write replaces what an earlier try of the same
        batch wrote, so a repeated batch changes nothing."""
        tag = Tag(self._stream_id(), batch_id)
        if self.state.is_merged(tag):
            return
        o = self.options
        events = rebase(as_events(batch, o.source_zone), o.source_zone, o.base_zone)
        events = events.withColumn(times.INSTANT, times.instant(events)).select(*COLUMNS)
        with staged(events, "batch") as given:
            days = _days(given.select(times.ten_minutes(F.col("timestamp")).alias("unit")))
            if self.state.all_new(given, days, tag):
                self._take(given, tag)
                return
            with staged(self.state.new_events(given, days, tag), "new-events") as new:
                self._take(new, tag)

    def _take(self, new: DataFrame, tag: Tag) -> None:
        added = new.select(times.ten_minutes(F.col("timestamp")).alias("unit")).distinct()
        # Buckets of an earlier try are there only if this was checked before it wrote any.
        if self.history is None and not self.state.has_batch(tag):
            with staged(added, "batch-buckets") as units:
                self._refuse_others_buckets(units)
        self.seen_log.update(new, str(tag))
        # Where a visitor now is seen first, the bucket that held their former first event
        # no longer has them as a new one.
        moved = self.seen_log.replaced_by(str(tag)).select(
            times.ten_minutes(F.col("replaced")).alias("unit")
        )
        with staged(added.union(moved).distinct(), "touched") as touched:
            days = _days(touched)
            if not days:
                return
            if self.history is None:
                self.state.add(new, None, tag, self.options.source_zone, len(days))
            else:
                with staged(self._past(new, touched, days, tag), "past") as past:
                    self.state.add(new, past, tag, self.options.source_zone, len(days))
            self._replace(touched, days, tag)

    def _past(self, new: DataFrame, touched: DataFrame, days: list[str], tag: Tag) -> DataFrame:
        """The history's events of the touched buckets that the state does not know yet. An
        earlier try of this batch may have written some: these are found again."""
        units = F.broadcast(touched)
        bucket = times.ten_minutes(F.col("timestamp"))
        past = self._history_of(days).withColumn("unit", bucket).join(units, "unit", "left_semi").drop("unit")
        return self.state.unknown_past(past, new, days, tag).select(*COLUMNS)

    def _replace(self, touched: DataFrame, days: list[str], tag: Tag) -> None:
        """Make the touched buckets from their partials. One without any is another writer's
        and stays as it is."""
        own = touched.join(self.state.buckets(days), "unit", "left_semi")
        with staged(own, "own-buckets") as units:
            for family in self.families:
                rows = self.state.rows(
                    family, units, days, self.seen_log.read, self._hot, self.options.next_pages
                )
                self.store.write_units(f"minutes_{family}", rows, units)
            if self.ledger is not None:
                self.ledger.mark(units, str(tag))
        self.state.merge(days, tag)

    def _hot(self, views: DataFrame) -> DataFrame | None:
        return skew.measured_hot_sessions(views, self.session_quota)

    def _history_of(self, days: list[str]) -> DataFrame:
        """The history's events of some days, read by runs of days that follow each other."""
        o = self.options
        spans = [run.in_zone(o.base_zone, o.source_zone) for run in runs_of_days(days)]
        history = self.history()
        parts = [limit_events(history, span, o.source_zone) for span in spans]
        events = rebase(reduce(DataFrame.unionByName, parts), o.source_zone, o.base_zone)
        return events.withColumn(times.INSTANT, times.instant(events)).select(*COLUMNS)

    def _refuse_others_buckets(self, units: DataFrame) -> None:
        """Buckets that the store has rows of but the stream no events were made from events
        not known here: replacing them would lose those. Rows are read only of days that have
        a folder, and only where the stream does not know a bucket of them."""
        made = [f"minutes_{family}" for family in self.families]
        days = _days(units)
        there = set().union(*(self.store.days_of(name, days) for name in made))
        days = [d for d in days if d in there]
        if not days:
            return
        unknown = units.where(F.col("unit").cast("date").cast("string").isin(days))
        unknown = unknown.join(self.state.buckets(days), "unit", "left_anti")
        with staged(unknown, "unknown-buckets") as rest:
            first, last = rest.agg(F.min("unit"), F.max("unit")).first()
            if first is None:
                return
            span = Period(first, last + TEN_MINUTES)
            for name in made:
                stored = self.store.read(name, span).select(F.col("date_time").alias("unit"))
                if row := rest.join(stored, "unit", "left_semi").first():
                    raise ValueError(f"{row.unit} is not of this stream; give its history")

    def _stream_id(self) -> str:
        """The id Spark keeps with the checkpoint: the same after a restart, another one for
        a new checkpoint, whose batches count from 0 again."""
        own = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        return (own or "s").replace("-", "")

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = events.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "10 minutes"})).start()


def _days(units: DataFrame) -> list[str]:
    """One row per day."""
    days = units.select(times.day(F.col("unit")).alias("day")).distinct().collect()
    return sorted(str(row.day) for row in days)


def drain(
    spark: SparkSession,
    events: DataFrame,
    families: tuple[str, ...] = FAMILIES,
    ledger: Ledger | None = None,
) -> RollupStore:
    """Run a stream over all that is available now, into tables of its own."""
    root = scratch_path(spark, "stream")
    store = RollupStore(spark, f"{root}/tables")
    log = FirstSeenLog(spark, f"{root}/seen")
    stream = MinuteStream(spark, f"{root}/state", log, store, families, ledger=ledger)
    stream.start(events, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return store
