"""The first-seen state as a compacted table in buckets of visitors, and a short log beside it."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.first_seen import VISITOR, FirstSeenLog

BASE = "visitor string, client_id string, sdk_key string, first_seen timestamp_ntz"
# Up to so many visitors are looked up by name, which reads their buckets only.
FEW = 500


def visitor() -> Column:
    """One column that tells visitors apart: joins on it fit the buckets of the base."""
    site = F.coalesce(F.length("sdk_key").cast("string"), F.lit("-"))
    return F.concat(site, F.lit(":"), F.coalesce("sdk_key", F.lit("")), F.col("client_id"))


def of_visitors(base: DataFrame, asked: DataFrame, buckets: int) -> DataFrame:
    """The base's rows of the visitors asked for. These are dealt to its buckets: dealt to
    any other number of partitions, the base would be shuffled to meet them."""
    return base.join(asked.distinct().repartition(buckets, "visitor"), "visitor", "left_semi")


def merged(base: DataFrame, added: DataFrame, buckets: int) -> DataFrame:
    """Bucket by bucket: the base stays where it is, only what was added moves."""
    old, new = base.alias("old"), added.repartition(buckets, "visitor").alias("new").hint("merge")
    joined = old.join(new, F.col("old.visitor") == F.col("new.visitor"), "full")
    return joined.select(
        *(F.coalesce(f"old.{c}", f"new.{c}").alias(c) for c in ("visitor", *VISITOR)),
        F.least("old.first_seen", "new.first_seen").alias("first_seen"),
    )


class VisitorState(FirstSeenLog):
    """A first-seen log whose settled runs are folded into a base, one row per visitor in
    ``buckets`` files sorted by visitor. A lookup joins the visitors asked for to the base
    bucket by bucket, so that the base is never shuffled, and reads only the buckets of few
    visitors; what runs added since is small and is filtered the same way.

    Folds write a new base and then drop what it holds. First times are minima, so a fold that
    ended in between, with its runs still there, changes nothing. A folded run may be repeated,
    but ``replaced_by`` then no longer knows what it moved: fold only runs nobody repeats.
    One fold at a time; readers of an older base must be done before the fold after the next.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        super().__init__(spark, path)
        self.buckets = buckets

    def _folders(self, path: str) -> list:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        return [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]

    def _bases(self) -> list[tuple[int, int, str]]:
        """(version, buckets, path) of every whole base, oldest first."""
        sc = self.spark.sparkContext
        fs_conf = sc._jsc.hadoopConfiguration()
        found = []
        # A leading underscore hides the folder from reads of the log.
        for folder in self._folders(f"{self.path}/_base"):
            done = sc._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
            if done.getFileSystem(fs_conf).exists(done):
                version, buckets = folder.getName().split("-")
                found.append((int(version), int(buckets), folder.toString()))
        return sorted(found)

    def base(self) -> DataFrame | None:
        """The newest base, known to be in buckets."""
        bases = self._bases()
        if not bases:
            return None
        _, buckets, path = bases[-1]
        # Buckets are a property of tables; the name is needed only to say so.
        name = f"tidemark_visitors_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({BASE}) USING parquet CLUSTERED BY (visitor) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def read(self, visitors: DataFrame | None = None, but_run: str | None = None) -> DataFrame:
        """As the log's. Visitors asked for are distinct or not, and without null clients."""
        recent, base = super().read(visitors, but_run), self.base()
        if base is None:
            return recent
        if visitors is not None:
            asked = visitors.where(F.col("client_id").isNotNull()).select(visitor().alias("visitor"))
            names = [r[0] for r in asked.distinct().limit(FEW + 1).toLocalIterator()]
            if len(names) <= FEW:
                base = base.where(F.col("visitor").isin(names))
            else:
                base = of_visitors(base, asked, self._bases()[-1][1])
        both = base.select(*VISITOR, "first_seen").unionByName(recent)
        return both.groupBy(*VISITOR).agg(F.min("first_seen").alias("first_seen"))

    def runs(self) -> list[str]:
        """Runs of the log that are not folded."""
        names = (f.getName() for f in self._folders(self.path))
        return sorted(n.removeprefix("run=") for n in names if n.startswith("run="))

    def fold(self, settled: Iterable[str] | None = None) -> None:
        """Moves ``settled`` runs (all, if not given) from the log to the base."""
        runs = self.runs() if settled is None else sorted(set(settled) & set(self.runs()))
        if not runs:
            return
        bases, base = self._bases(), self.base()
        added = self._entries().where(F.col("run").isin(runs)).withColumn("visitor", visitor())
        added = added.groupBy("visitor", *VISITOR).agg(F.min("first_seen").alias("first_seen"))
        version, buckets = (bases[-1][0] + 1, bases[-1][1]) if bases else (0, self.buckets)
        if base is None:
            folded = added.repartition(buckets, "visitor")
        else:
            folded = merged(base, added, buckets)
        self._write_base(folded, f"{version:09d}-{buckets}", buckets)
        for run in runs:
            self._drop(run)
        # Readers that began before may still be at the base before this one.
        for _, _, path in bases[:-1]:
            self._delete(path)

    def _write_base(self, rows: DataFrame, folder: str, buckets: int) -> None:
        name, path = f"tidemark_visitors_{uuid.uuid4().hex}", f"{self.path}/_base/{folder}"
        # What a fold that failed left there.
        self._delete(path)
        try:
            (
                rows.write.bucketBy(buckets, "visitor")
                .sortBy("visitor")
                .option("path", path)
                .format("parquet")
                .saveAsTable(name)
            )
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)
