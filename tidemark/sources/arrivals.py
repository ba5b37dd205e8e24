"""Events by when their files came, not by when they happened."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.periods import Period
from tidemark.schema import EVENTS
from tidemark.sources.events import as_events, limit_events

MODIFIED = "_metadata.file_modification_time"


class Arrivals:
    """An events table in ``dt=`` folders, or without any, to which files are added.

    A folder that has not changed is not listed, a file that is not new not read. Where folders
    do not say when they changed, as in object stores, their files are listed, and read by their
    own times all the same. Moments are instants in UTC without a zone."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def since(self, after: datetime | None, until: datetime) -> DataFrame | None:
        """Events of the files that came after one moment, up to another; None without any."""
        folders = self._changed(after)
        if not folders:
            return None
        reader = self.spark.read.option("basePath", self.path).option("timeZone", "UTC")
        if after is not None:
            # To the second, and exclusive; the filter below is exact.
            early = after.replace(microsecond=0) - timedelta(seconds=1)
            reader = reader.option("modifiedAfter", f"{early:%Y-%m-%dT%H:%M:%S}")
        try:
            events = reader.parquet(*folders)
        except Exception as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):  # none of their files is as new
                return None
            raise
        came = F.col(MODIFIED) <= F.lit(until.replace(tzinfo=timezone.utc))
        if after is not None:
            came = came & (F.col(MODIFIED) > F.lit(after.replace(tzinfo=timezone.utc)))
        return events.where(came)

    def of_period(self, period: Period, zone: str) -> DataFrame:
        """All events of a period, wall-clock time of ``zone``. Only its days are listed."""
        first, last = period.days()
        days = [str(first + timedelta(days=i)) for i in range((last - first).days + 1)]
        there = {f.rsplit("dt=", 1)[-1]: f for f in self._folders() if "dt=" in f}
        folders = [there[d] for d in days if d in there] if there else [self.path]
        if not folders:
            return as_events(self.spark.createDataFrame([], EVENTS), zone)
        events = self.spark.read.option("basePath", self.path).parquet(*folders)
        return limit_events(events, period, zone)

    def _folders(self) -> list[str]:
        return [path for path, _ in self._listed()]

    def _listed(self) -> list[tuple[str, int]]:
        """The ``dt=`` folders and when they changed, in milliseconds: one listing."""
        sc = self.spark.sparkContext
        root = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
        found = [s for s in fs.listStatus(root) if s.isDirectory()]
        named = [(s.getPath().toString(), s.getModificationTime()) for s in found]
        return [(path, at) for path, at in named if "/dt=" in path]

    def _changed(self, after: datetime | None) -> list[str]:
        folders = self._listed()
        if not folders:
            return [self.path]
        if after is None:
            return [path for path, _ in folders]
        since = after.replace(tzinfo=timezone.utc).timestamp() * 1000
        return [path for path, at in folders if at == 0 or at >= int(since)]
