"""Partial results of ten-minute buckets, which batches of events merge into.

A batch is cut to what its events add to each bucket and written beside what is there, by day
and batch: visits (one row per bucket, site and visitor), clicks (one row per bucket, clicker,
element and set of dimensions) and page views. A bucket is then made from its partials, so an
event costs its own rows and the partials of its bucket, never a look at the events before it.
The ids of events are kept, too, so that one given again, however late, adds nothing.

Folders are ``dt=<day>/batch=<stream>-b<number>``. A batch tried again replaces its own. Days of
many folders are merged to one, ``<stream>-m<number>``, which stands for all batches of its stream
up to that number; that a folder is merged is told by the names alone, so there is no moment at
which rows count twice or not at all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.operators import metrics, pages, users
from tidemark.schema import EVENTS
from tidemark.sources.events import identity
from tidemark.sources.listing import by_day
from tidemark.sources.scratch import staged

# Folders of a day before these are merged.
MOST_FOLDERS = 16

VISITS, CLICKS, VIEWS, IDS = "visits", "clicks", "views", "ids"
# What each family of tables is made from.
NEEDS = {
    "metrics": VISITS,
    "page_stats": VIEWS,
    "page_transitions": VIEWS,
    "click_summary": CLICKS,
    "top_elements": CLICKS,
    "user_distribution": CLICKS,
}
_KINDS = {
    VISITS: "date_time timestamp_ntz, sdk_key string, client_id string, clicks long, n long, "
    "first_at timestamp_ntz, last_at timestamp_ntz, seen_at timestamp_ntz",
    CLICKS: "date_time timestamp_ntz, date date, sdk_key string, client_id string, "
    "target_text string, user_gender string, traffic_source string, device_type string, "
    "user_age int, n long",
    VIEWS: "date_time timestamp_ntz, timestamp timestamp_ntz, instant timestamp_ntz, "
    "event_id long, session_id string, sdk_key string, page_path string, "
    "time_on_page_seconds double",
    IDS: "date_time timestamp_ntz, id long, past boolean",
}
SCHEMAS = {kind: f"{columns}, dt string, batch string" for kind, columns in _KINDS.items()}


@dataclass(frozen=True)
class Tag:
    """The name of a batch's folders."""

    stream: str
    number: int
    merged: bool = False

    def __str__(self) -> str:
        return f"{self.stream}-{'m' if self.merged else 'b'}{self.number}"

    @classmethod
    def of(cls, name: str) -> Tag:
        stream, _, rest = name.rpartition("-")
        return cls(stream, int(rest[1:]), rest[0] == "m")


def current(tags: list[Tag]) -> list[Tag]:
    """Those that no merged folder stands for."""
    last: dict[str, int] = {}
    for tag in tags:
        if tag.merged:
            last[tag.stream] = max(tag.number, last.get(tag.stream, -1))
    return [
        t
        for t in tags
        if t.number > last.get(t.stream, -1) or (t.merged and t.number == last[t.stream])
    ]


def _ids(events: DataFrame, past: bool) -> DataFrame:
    bucket = times.ten_minutes(F.col("timestamp"))
    return events.select(bucket.alias("date_time"), identity().alias("id"), F.lit(past).alias("past"))


def _unknown(events: DataFrame, ids: DataFrame) -> DataFrame:
    bucket = times.ten_minutes(F.col("timestamp"))
    keyed = events.withColumns({"date_time": bucket, "id": identity()})
    known = ids.select("date_time", "id").distinct()
    return keyed.join(known, ["date_time", "id"], "left_anti").drop("date_time", "id")


class BucketState:
    def __init__(self, spark: SparkSession, root: str, families: tuple[str, ...], report_zone: str):
        """``report_zone`` is that of the days that clicks are also kept by."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.kinds = [IDS, *dict.fromkeys(NEEDS[f] for f in families)]
        self.report_zone = report_zone

    # Writing

    def add(self, events: DataFrame, past: DataFrame | None, tag: Tag, zone: str, days: int = 1) -> None:
        """The partials of a batch. ``past`` are events of the history that belong to its
        buckets; ``zone`` is that of the stored time; ``days`` is about how many days it has."""
        known = _ids(events, False)
        if past is not None:
            known, events = known.unionByName(_ids(past, True)), events.unionByName(past)
        made = {
            IDS: lambda: known,
            VISITS: lambda: metrics.minute_visits(events),
            CLICKS: lambda: self._clicks(events, zone),
            VIEWS: lambda: pages.page_views(events),
        }
        for kind in self.kinds:
            self._write(kind, made[kind](), tag, days)

    def _clicks(self, events: DataFrame, zone: str) -> DataFrame:
        local = times.zone_day(times.instant(events), zone, self.report_zone)
        return users.collapsed(users.minute_clicks(events.withColumn("date", local)), ["date_time", "date"])

    def _write(self, kind: str, rows: DataFrame, tag: Tag, days: int) -> None:
        names = [c.split()[0] for c in _KINDS[kind].split(", ")]
        dt = F.col("date_time").cast("date").cast("string")
        rows = rows.select(*names, dt.alias("dt"), F.lit(str(tag)).alias("batch"))
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # Sized by bytes, one task would write the files of many small days one after another.
        if days > tasks:
            rows = rows.repartitionByRange(tasks, "dt", "date_time", F.xxhash64(*names))
        else:
            rows = rows.hint("rebalance", F.col("dt"))
        (
            rows.sortWithinPartitions("dt", "date_time")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt", "batch")
            .parquet(f"{self.root}/{kind}")
        )

    # Reading

    def parts(self, kind: str, days: list[str], but: Tag | None = None) -> DataFrame:
        """The partials of some days; ``but`` leaves out those of one batch. Only the folders
        of these days are listed."""
        tags = self._tags_of(kind, days)
        there = [
            f"{self.root}/{kind}/dt={day}/batch={tag}"
            for day in days
            for tag in current(tags[day])
            if tag != but
        ]
        if not there:
            # A limit of no rows, unlike a list of none, is known to be empty when planned.
            return self.spark.createDataFrame([], SCHEMAS[kind]).limit(0)
        reader = self.spark.read.schema(SCHEMAS[kind]).option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*there)

    def _tags(self, kind: str, day: str) -> list[Tag]:
        return self._tags_of(kind, [day])[day]

    def _tags_of(self, kind: str, days: list[str]) -> dict[str, list[Tag]]:
        """The folders of some days, by day: one listing."""
        found = by_day(self.spark, f"{self.root}/{kind}", days, "/batch=*")
        return {d: [Tag.of(f.rsplit("/batch=", 1)[1]) for f in found.get(d, [])] for d in days}

    def has_batch(self, tag: Tag) -> bool:
        fs, pattern = self._fs(f"{self.root}/{IDS}/dt=*/batch={tag}")
        return bool(fs.globStatus(pattern))

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def buckets(self, days: list[str]) -> DataFrame:
        """The buckets (``unit``) of some days that there are events of."""
        return self.parts(IDS, days).select(F.col("date_time").alias("unit")).distinct()

    def is_merged(self, tag: Tag) -> bool:
        """Whether a merge stands for this batch: all it does was done before."""
        fs, pattern = self._fs(f"{self.root}/{IDS}/dt=*/batch={tag.stream}-m*")
        names = (s.getPath().getName() for s in fs.globStatus(pattern) or [])
        return any(Tag.of(n.removeprefix("batch=")).number >= tag.number for n in names)

    def all_new(self, events: DataFrame, days: list[str], tag: Tag) -> bool:
        """Whether ``new_events`` are all events: told by their ids alone, so that a batch in
        which nothing is given again is neither shuffled nor written once more."""
        named = F.col("event_id").isNotNull().alias("named")
        keyed = events.select(times.ten_minutes(F.col("timestamp")).alias("date_time"), identity().alias("id"), named)
        if not keyed.where("named").groupBy("id").count().where("count > 1").isEmpty():
            return False
        known = self.parts(IDS, days, but=tag).select("date_time", "id", "past")
        met = keyed.join(known, ["date_time", "id"]).where("named or past")
        return met.isEmpty()

    def new_events(self, events: DataFrame, days: list[str], tag: Tag) -> DataFrame:
        """Events that other batches have not brought yet, each once. An event without an id
        may come several times in a stream, and is held against the history's only."""
        some = F.col("event_id").isNotNull()
        known = self.parts(IDS, days, but=tag)
        named = _unknown(events.where(some).dropDuplicates(["event_id"]), known)
        return named.unionByName(_unknown(events.where(~some), known.where("past")))

    def unknown_past(self, past: DataFrame, new: DataFrame, days: list[str], tag: Tag) -> DataFrame:
        """Events of the history that neither other batches nor the events of this one are. What
        an earlier try of this batch has written is found again."""
        known = self.parts(IDS, days, but=tag).select("date_time", "id")
        return _unknown(past, known.unionByName(_ids(new, False).drop("past")))

    # Results

    def rows(
        self, family: str, units: DataFrame, days: list[str], seen, hot, next_pages: str = "first"
    ) -> DataFrame:
        """The rows of a minute table in some buckets, from their partials. ``seen`` gives first
        visits of visitors, ``hot`` sessions too big for one task."""
        kind = NEEDS[family]
        wanted = F.broadcast(units.select(F.col("unit").alias("date_time")))
        parts = self.parts(kind, days).join(wanted, "date_time", "left_semi")
        if family == "metrics":
            visits = metrics.merged_visits(parts)
            return metrics.metrics_of_visits(visits, seen(visits))
        if kind == VIEWS:
            views = parts.select(*(c for c in parts.columns if c in [*EVENTS.fieldNames(), times.INSTANT]))
            if family == "page_transitions":
                return pages.page_transitions(views, hot(views))
            return pages.minutes_page_stats(views, hot(views), next_pages)
        kinds, rows_of = users.FAMILY_FACTS[family]
        return rows_of(users.segment_facts(parts, ["date_time"], kinds), ["date_time"])

    def day_clicks(self, dates: DataFrame) -> DataFrame:
        """Clicks of some days (``unit``) of the report zone, as ``users.segment_facts`` takes
        them. Such a day lies in up to three days of the buckets."""
        nearby = dates.select(F.explode(F.array(*(F.date_add("unit", i) for i in (-1, 0, 1)))).alias("d"))
        days = sorted(str(r.d) for r in nearby.distinct().collect())
        wanted = F.broadcast(dates.select(F.col("unit").cast("date").alias("date")))
        return self.parts(CLICKS, days).join(wanted, "date", "left_semi")

    # Keeping small

    def merge(self, days: list[str], tag: Tag) -> None:
        """Days of many folders get one in place of all that ``tag``'s stream has written."""
        for kind in self.kinds:
            tags = self._tags_of(kind, days)
            mine = {d: [t for t in current(ts) if t.stream == tag.stream] for d, ts in tags.items()}
            many = [d for d, ts in mine.items() if len(ts) > MOST_FOLDERS]
            if many:
                folders = [f"{self.root}/{kind}/dt={d}/batch={t}" for d in many for t in mine[d]]
                reader = self.spark.read.schema(SCHEMAS[kind])
                parts = reader.option("basePath", f"{self.root}/{kind}").parquet(*folders)
                with staged(self._merged(kind, parts), f"merged-{kind}") as rows:
                    self._write(kind, rows, Tag(tag.stream, tag.number, merged=True), len(many))
            for day, now in (self._tags_of(kind, days) if many else tags).items():
                for old in set(now) - set(current(now)):
                    fs, path = self._fs(f"{self.root}/{kind}/dt={day}/batch={old}")
                    fs.delete(path, True)

    @staticmethod
    def _merged(kind: str, parts: DataFrame) -> DataFrame:
        if kind == VISITS:
            return metrics.merged_visits(parts)
        if kind == CLICKS:
            return users.collapsed(parts, ["date_time", "date"])
        return parts.drop("dt", "batch")
