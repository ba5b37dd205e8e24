"""Where intermediate and checkpoint files go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder, or a local one where Spark itself is local."""
    shared = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch root; never one used before."""
    return f"{scratch_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the scratch folder. What reads them does not
    compute them again, also not after the loss of an executor."""
    return _through(df, scratch_path(df.sparkSession, name))


@contextmanager
def staged(df: DataFrame, name: str, *by: str) -> Iterator[DataFrame]:
    """As ``written``, partitioned by ``by``, for the length of a with block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        yield _through(df, path, *by)
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)


def _through(df: DataFrame, path: str, *by: str) -> DataFrame:
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
