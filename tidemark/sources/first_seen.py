"""The first-seen state as an append-only log, kept small by writing changes only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.visitors import first_seen

VISITOR = ["client_id", "sdk_key"]
SCHEMA = (
    "client_id string, sdk_key string, first_seen timestamp_ntz, replaced timestamp_ntz, run string"
)


class FirstSeenLog:
    """Each run adds the visitors it saw first, or saw earlier than known.

    The state is the minimum per visitor over all runs. A run writes its own
    ``run=`` partition and never reads it, so repeating a run changes nothing. Events
    taken back from history need a rebuild: a new log over the whole history.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _entries(self) -> DataFrame:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(folder)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def _drop(self, run: str) -> None:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/run={run}")
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)

    def read(self, visitors: DataFrame | None = None, but_run: str | None = None) -> DataFrame:
        """(client_id, sdk_key, first_seen), of the given visitors only if given."""
        entries = self._entries()
        if but_run is not None:
            entries = entries.where(F.col("run") != but_run)
        if visitors is not None:
            entries = entries.join(visitors.select(*VISITOR).distinct(), VISITOR, "left_semi")
        return entries.groupBy(*VISITOR).agg(F.min("first_seen").alias("first_seen"))

    def update(self, events: DataFrame, run: str) -> None:
        # A run that now finds nobody would leave its former folder in place.
        self._drop(run)
        seen = first_seen(events)
        known = self.read(seen, but_run=run).withColumnRenamed("first_seen", "replaced")
        earlier = F.col("replaced").isNull() | (F.col("first_seen") < F.col("replaced"))
        (
            seen.join(known, VISITOR, "left")
            .where(earlier)
            .withColumn("run", F.lit(run))
            .hint("rebalance")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run")
            .parquet(self.path)
        )

    def replaced_by(self, run: str) -> DataFrame:
        """Former first times that the run moved to an earlier one."""
        moved = (F.col("run") == run) & F.col("replaced").isNotNull()
        return self._entries().where(moved).select(*VISITOR, "replaced")

    def compact(self, path: str) -> FirstSeenLog:
        """The same state as one run in a new log."""
        (
            self.read()
            .withColumns({"replaced": F.lit(None).cast("timestamp_ntz"), "run": F.lit("base")})
            .write.partitionBy("run")
            .parquet(path)
        )
        return FirstSeenLog(self.spark, path)
