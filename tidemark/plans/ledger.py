"""Which periods have changed below and are still to be carried upwards."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "level string, start timestamp_ntz"
BUCKET, ARRIVED = "bucket", "arrived"


class Ledger:
    """One folder of entries (level, start) per writer's run, so that a run tried again replaces
    its own and entries made meanwhile are left for the next time. Settling writes what stays
    open before it drops what was read: a settlement that fails in between leaves entries twice,
    which only means that a period is made again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def mark(self, units: DataFrame, run: str) -> None:
        """Ten-minute buckets (``unit``) that a run has replaced."""
        rows = units.select(F.lit(BUCKET).alias("level"), F.col("unit").alias("start"))
        self.put(rows, run)

    def put(self, rows: DataFrame, run: str) -> None:
        rows.select("level", "start").write.mode("overwrite").parquet(f"{self.path}/{run}")

    def open(self) -> tuple[list[str], DataFrame]:
        """The folders of now, and their entries, each once."""
        fs, root = self._fs(self.path)
        fs.mkdirs(root)
        folders = [s.getPath().toString() for s in fs.listStatus(root) if s.isDirectory()]
        if not folders:
            return [], self.spark.createDataFrame([], SCHEMA)
        return folders, self.spark.read.schema(SCHEMA).parquet(*folders).distinct()

    def settle(self, folders: list[str], rest: DataFrame) -> None:
        """Entries of these folders are done but for the rest."""
        self.put(rest, f"rest-{uuid.uuid4().hex}")
        for folder in folders:
            fs, path = self._fs(folder)
            fs.delete(path, True)

    def arrived(self) -> datetime | None:
        """Up to when files that arrived have been taken in."""
        last = self.open()[1].where(F.col("level") == ARRIVED).agg(F.max("start")).first()
        return last[0]

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p
