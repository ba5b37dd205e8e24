"""Rollup tables as partitioned Parquet, where writing a period replaces it.

Every table is partitioned by ``dt``, the date of the time key. The minutes and
hourly tables, which are also run for parts of a day, have a second level
``span``: what the run that wrote the rows covered of that day (``day``, an hour
``14``, or ten minutes ``1430``). So ten-minute runs of one day stand side by
side, and a backfill of a year leaves a folder per day, not one per ten minutes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.plans.periods import DAY, HOUR, TEN_MINUTES, WEEK, Period, require_whole
from tidemark.schema import TABLES, Table
from tidemark.sources.listing import by_day

WHOLE_DAY = "day"
# So many hours of a day that has no folder yet get one together.
HOURS_OF_A_DAY = 6


@dataclass(frozen=True)
class Folder:
    """One partition folder: a whole day, an hour or ten minutes of it."""

    dt: str
    span: str | None = None

    @property
    def path(self) -> str:
        return f"dt={self.dt}" if self.span is None else f"dt={self.dt}/span={self.span}"

    def inside(self) -> str:
        """Pattern of this folder and of all narrower ones."""
        if self.span is None:
            return self.path
        return f"dt={self.dt}/span={'*' if self.span == WHOLE_DAY else self.span + '*'}"

    def wider(self) -> list[Folder]:
        """Folders that may hold rows of this span among others."""
        if self.span in (None, WHOLE_DAY):
            return []
        hour = [Folder(self.dt, self.span[:2])] if len(self.span) == 4 else []
        return [Folder(self.dt, WHOLE_DAY), *hour]


def folders_of(table: Table, period: Period) -> list[Folder]:
    """The widest folders that make up a period."""
    if table.grain == "weekly":
        # Weekly rows lie under their first day.
        weeks = -((period.start - period.end) // WEEK)
        return [Folder(str((period.start + i * WEEK).date())) for i in range(weeks)]
    out, at = [], period.start
    while at < period.end:
        left, dt = period.end - at, str(at.date())
        if table.grain == "daily":
            out.append(Folder(dt))
            at += DAY
        elif at.hour == at.minute == 0 and left >= DAY:
            out.append(Folder(dt, WHOLE_DAY))
            at += DAY
        elif at.minute == 0 and left >= HOUR:
            out.append(Folder(dt, f"{at:%H}"))
            at += HOUR
        else:
            out.append(Folder(dt, f"{at:%H%M}"))
            at += TEN_MINUTES
    return out


def _up(moment: datetime, step: timedelta) -> datetime:
    midnight = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight - (midnight - moment) // step * step


def _placing(table: Table, df: DataFrame) -> Column:
    """What places a row: the run that wrote it, else its time key."""
    return F.col("run" if "run" in df.columns else table.time_column)


def _span_of(at: Column, period: Period) -> Column:
    """The span a row belongs to, as ``folders_of`` cuts the period."""

    def in_whole(step: timedelta) -> Column:
        last = period.end if _up(period.end, step) == period.end else _up(period.end, step) - step
        return times.half_open(at, _up(period.start, step), last)

    by_hour = F.when(in_whole(HOUR), _hour_span(at)).otherwise(_ten_span(at))
    return F.when(in_whole(DAY), WHOLE_DAY).otherwise(by_hour)


def _hour_span(at: Column) -> Column:
    return F.lpad(F.hour(at).cast("string"), 2, "0")


def _ten_span(at: Column) -> Column:
    return F.concat(_hour_span(at), F.lpad(F.minute(at).cast("string"), 2, "0"))


class RollupStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, period: Period | None = None) -> DataFrame:
        """A table, limited to the rows whose time key lies in ``period``."""
        table = TABLES[name]
        df = self._stored(table, period)
        if period is not None:
            df = df.where(_covering(table, period))
            if table.time_column == "date_time":
                df = df.where(times.half_open(F.col("date_time"), period.start, period.end))
        return df.select(*table.columns)

    def _stored(self, table: Table, period: Period | None) -> DataFrame:
        """The folders of the period's days alone, so that no others are listed."""
        root = self.path(table.name)
        fs, path = self._fs(root)
        fs.mkdirs(path)
        reader = self.spark.read.schema(table.stored_schema).option("basePath", root)
        if period is None:
            return reader.parquet(root)
        # The day before may hold rows that closed runs put past their end.
        first, last = (period.start - DAY).date(), period.days()[1]
        days = [str(first + i * DAY) for i in range((last - first).days + 1)]
        there = self.days_of(table.name, days)
        if not there:
            return self.spark.createDataFrame([], table.stored_schema)
        return reader.parquet(*(f"{root}/dt={d}" for d in days if d in there))

    def write(self, name: str, df: DataFrame, period: Period) -> None:
        """Replace the rows of ``period`` with ``df``, matched by column name.

        Running a period twice leaves the table as after the first run. A ``run``
        column, where there is one, places the rows instead of the time key and is
        not stored.
        """
        table = TABLES[name]
        require_whole(period, table.grain)
        folders = folders_of(table, period)
        wider = self._existing(name, [f for folder in folders for f in folder.wider()])
        time_key = F.col(table.time_column).cast("timestamp_ntz")
        outside = ~times.half_open(time_key, period.start, period.end)
        if "run" in df.columns:
            # Rows closed runs put past their end can only be told apart by folder.
            span = _ten_span(F.col("run"))
        else:
            span = _span_of(time_key, period)
        self._replace(table, df, span, folders, wider, lambda old: old.where(outside))

    def write_units(self, name: str, df: DataFrame, units: DataFrame) -> None:
        """Replace single units of a table's grain (ten minutes, hours, days or weeks by their
        first day), given as column ``unit``; a unit without rows in ``df`` loses those it had.

        Ten minutes and hours go into the folder of their hour, or of their day where there
        is one, or where many hours of a day not written yet come at once. The rows a folder
        keeps stay in it, so a write that fails half-way can be tried again.
        """
        table = TABLES[name]
        if "span" not in table.partitions:
            dates = units.select(F.col("unit").cast("date").alias("dt")).distinct().collect()
            self._replace(table, df, F.lit(None), [Folder(str(r.dt)) for r in dates], [], None)
            return
        hours: dict[str, set[str]] = {}
        day = F.col("unit").cast("date").cast("string").alias("dt")
        for r in units.select(day, _hour_span(F.col("unit")).alias("hour")).distinct().collect():
            hours.setdefault(r.dt, set()).add(r.hour)
        there = self._spans(name, hours)
        whole = [
            dt
            for dt, touched in hours.items()
            if WHOLE_DAY in there[dt] or (not there[dt] and len(touched) >= HOURS_OF_A_DAY)
        ]
        wider = [
            Folder(dt, span)
            for dt, spans in there.items()
            for span in sorted(spans)
            if span == WHOLE_DAY or span[:2] in hours[dt]
        ]
        replaced = F.broadcast(units.select(F.col("unit").alias(table.time_column)).distinct())

        def keep(old: DataFrame) -> DataFrame:
            return old.join(replaced, table.time_column, "left_anti")

        at = F.col(table.time_column)
        in_whole = at.cast("date").cast("string").isin(whole) if whole else F.lit(False)
        if len(whole) == len(hours):  # of many days, the usual case
            in_whole = F.lit(True)
        span = F.when(in_whole, WHOLE_DAY).otherwise(_hour_span(at))
        folders = sum(1 if dt in whole else len(touched) for dt, touched in hours.items())
        self._replace(table, df, span, [], wider, keep, max(folders, len(wider)))

    def _replace(self, table, df, span, folders, wider, keep, count=None) -> None:
        """Put rows in place, then drop the folders that were to get some but did not.

        Wider folders that overlap are written again without the replaced rows.
        Spark writes all of it aside and swaps folders in at the end, so the rows
        kept can be read from the very folders they go back to.
        """
        name = table.name
        dt = _placing(table, df).cast("date").cast("string")
        rows = df.withColumns({"dt": dt, "span": span}).select(*table.columns, *table.partitions)
        if wider:
            old = (
                self.spark.read.schema(table.stored_schema)
                .option("basePath", self.path(name))
                .parquet(*[f"{self.path(name)}/{f.path}" for f in wider])
            )
            rows = rows.unionByName(keep(old))
        patterns = [f.inside() for f in folders] + [f.path for f in wider]
        before = self._files(name, patterns)
        (
            self._spread(rows, table, count or len(folders))
            .sortWithinPartitions(*table.partitions, table.time_column, "sdk_key")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*table.partitions)
            .parquet(self.path(name))
        )
        if not before:
            return
        after = self._files(name, patterns)
        for folder, files in before.items():
            if files & after.get(folder, set()):
                self._drop(folder)

    def _spread(self, rows: DataFrame, table: Table, folders: int) -> DataFrame:
        """Rows laid out so that tasks write few files each and share hot folders.

        More folders than tasks: tasks take ranges over all keys, so a range ends
        inside a big folder and spans many small ones. Otherwise tasks are sized
        by bytes, and a folder too big for one task is split.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if folders > tasks:
            keys = [c for c in table.columns if table.schema[c].dataType.typeName() != "array"]
            return rows.repartitionByRange(tasks, *table.partitions, "sdk_key", *keys[:-1])
        return rows.hint("rebalance", *[F.col(c) for c in table.partitions])

    def delete(self, name: str, period: Period) -> None:
        """Drop all rows of a period."""
        table = TABLES[name]
        self.write(name, self.spark.createDataFrame([], table.schema), period)

    def compact(self, name: str, days: Period) -> None:
        """Write whole days again as one folder each. Not for runs closed at both
        ends, whose rows would lose their run."""
        first, last = days.days()
        stored = self.spark.read.schema(TABLES[name].stored_schema).parquet(self.path(name))
        apart = (F.length("span") == 4) & (F.col("span") != _ten_span(F.col("date_time")))
        if not stored.where(F.col("dt").between(str(first), str(last)) & apart).isEmpty():
            raise ValueError(f"{name} holds rows of closed runs between {first} and {last}")
        self.write(name, self.read(name, days), days)

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _drop(self, folder: str) -> None:
        fs, path = self._fs(folder)
        fs.delete(path, True)

    def _existing(self, name: str, folders: list[Folder]) -> list[Folder]:
        """Those of the folders that are there."""
        there = self._spans(name, {f.dt for f in folders})
        return [f for f in dict.fromkeys(folders) if f.span in there[f.dt]]

    def _spans(self, name: str, days: Iterable[str]) -> dict[str, set[str]]:
        """The spans of some days that have folders, by day: one listing."""
        found = by_day(self.spark, self.path(name), days, "/span=*")
        return {
            day: {path.rsplit("/span=", 1)[1] for path in found.get(day, [])} for day in days
        }

    def days_of(self, name: str, days: Iterable[str]) -> set[str]:
        """Those of some days that have a folder: one listing, no rows are read."""
        return set(by_day(self.spark, self.path(name), days))

    def _files(self, name: str, patterns: list[str]) -> dict[str, set[str]]:
        """Files by folder for the given folder patterns: a listing for all days that have the
        same pattern below them, no Spark job."""
        below: dict[str, list[str]] = {}
        for pattern in patterns:
            day, *rest = pattern.removeprefix("dt=").split("/")
            below.setdefault("/".join(["", *rest, "*.parquet"]), []).append(day)
        found: dict[str, set[str]] = {}
        for rest, days in below.items():
            for paths in by_day(self.spark, self.path(name), days, rest).values():
                for folder, _, file in (path.rpartition("/") for path in paths):
                    found.setdefault(folder, set()).add(file)
        return found


def _covering(table: Table, period: Period) -> Column:
    """Partitions that may hold rows of the period. A minute row may lie with the
    run before it, where runs were closed at both ends."""
    first, last = period.days()
    covering = F.col("dt").between(str(first), str(last))
    if "span" not in table.partitions:
        return covering
    if first == last and period.end - period.start < DAY:
        folders = folders_of(table, Period(_hour(period.start), _up(period.end, HOUR)))
        hours = [f.span for f in folders if f.span != WHOLE_DAY]
        within = F.col("span") == WHOLE_DAY
        for hour in hours:
            within = within | F.col("span").startswith(hour)
        if hours:
            covering = covering & within
    before = period.start - TEN_MINUTES
    if table.grain == "minutes":
        spans = [WHOLE_DAY, f"{before:%H}", f"{before:%H%M}"]
        covering = covering | ((F.col("dt") == str(before.date())) & F.col("span").isin(spans))
    return covering


def _hour(moment: datetime) -> datetime:
    return moment.replace(minute=0, second=0, microsecond=0)
