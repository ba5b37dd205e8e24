"""Ten-minute click counts past a watermark: late events are dropped, or kept apart."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import dimensions, times
from tidemark.schema import CLICKS, EVENTS
from tidemark.sources.scratch import staged


def clicks_per_ten_minutes(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Append-mode counts per site. A watermark needs TIMESTAMP, so event time is
    cast on the way in and back on the way out; state holds one row per open
    bucket and site."""
    return (
        events.withColumn("event_time", F.col("timestamp").cast("timestamp"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "10 minutes"), "sdk_key")
        .agg(F.count_if(dimensions.is_click()).alias("clicks"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("date_time"), "sdk_key", "clicks")
    )


def drain(events: DataFrame, folder: str, delay: str = "10 minutes") -> DataFrame:
    """Counts of all that is available now, then the stream is at its end: the buckets the
    watermark has not passed are read from the query's state and added. Events later than
    ``delay`` are dropped where the source hands rows out over several batches."""
    spark = events.sparkSession
    (
        clicks_per_ten_minutes(events, delay)
        .writeStream.format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    closed = spark.read.schema(CLICKS).parquet(f"{folder}/rows")
    state = spark.read.format("statestore").load(f"{folder}/checkpoint")
    still_open = state.select(
        F.col("key.window.start").cast("timestamp_ntz").alias("date_time"),
        F.col("key.sdk_key").alias("sdk_key"),
        F.col("value.count").alias("clicks"),
    )
    return closed.unionByName(still_open)


class KeptClicks:
    """Click counts to which nothing is lost: an event whose bucket the watermark had passed
    when it came is written to a side table.

    The watermark of a batch is the latest event of the batches before it, less ``delay``; it is
    read from what these wrote. Counts are added up in the batch before they are written, so a
    bucket has a row per site and batch. A batch tried again replaces what it wrote, and batches
    of another checkpoint stand beside those of the first."""

    def __init__(self, spark: SparkSession, path: str, delay: timedelta = timedelta(minutes=10)):
        self.spark = spark
        self.path = path.rstrip("/")
        self.delay = delay

    def process(self, batch: DataFrame, batch_id: int) -> None:
        own = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        tag = f"{(own or 's').replace('-', '')}-b{batch_id}"
        with staged(batch.select(*EVENTS.fieldNames()), "clicks-batch") as events:
            mark = self._watermark(but=tag)
            bucket = times.ten_minutes(F.col("timestamp"))
            passed = F.lit(False)
            if mark is not None:
                passed = bucket + F.expr("INTERVAL 10 MINUTES") <= times.at(mark)
            counts = events.where(~passed).groupBy(bucket.alias("date_time"), "sdk_key")
            counts = counts.agg(F.count_if(dimensions.is_click()).alias("clicks"))
            self._put("counts", counts, tag)
            self._put("late", events.where(passed), tag)
            self._put("marks", events.agg(F.max("timestamp").alias("last")), tag)

    def _put(self, table: str, rows: DataFrame, tag: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={tag}")

    def _table(self, table: str, schema: str) -> DataFrame:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(folder)
        return self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.path}/{table}")

    def _watermark(self, but: str | None = None):
        marks = self._table("marks", "last timestamp_ntz")
        last = marks.where(F.col("batch") != (but or "")).agg(F.max("last")).first()[0]
        return None if last is None else last - self.delay

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = events.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "10 minutes"})).start()

    def counts(self, closed: bool = False) -> DataFrame:
        """Clicks that came in time; ``closed`` limits them to buckets that will get no more."""
        rows = self._table("counts", CLICKS)
        if closed:
            mark = self._watermark()
            end = F.col("date_time") + F.expr("INTERVAL 10 MINUTES")
            rows = rows.where(F.lit(False) if mark is None else end <= times.at(mark))
        return rows.groupBy("date_time", "sdk_key").agg(F.sum("clicks").alias("clicks"))

    def late(self) -> DataFrame:
        """The events that came too late, as they came."""
        columns = EVENTS.fieldNames()
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EVENTS)
        return self._table("late", schema).select(*columns)
