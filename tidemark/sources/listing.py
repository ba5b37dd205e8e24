"""Listings of folders by day: one for many days, as text, instead of one for each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

# More days than these are listed by their months.
MOST_DAYS = 40


def by_day(spark: SparkSession, root: str, days: Iterable[str], below: str = "") -> dict[str, list[str]]:
    """Paths that match ``dt=<day><below>`` under ``root``, by day; days without any are left
    out. ``below`` may hold patterns."""
    wanted = set(days)
    if not wanted:
        return {}
    some = sorted(wanted if len(wanted) <= MOST_DAYS else {f"{day[:7]}*" for day in wanted})
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    fs = folder.getFileSystem(conf)
    there = fs.globStatus(hadoop.Path(f"{root}/dt={{{','.join(some)}}}{below}"))
    if not there:
        return {}
    # As one text, "{path,path}": a call for each path would take longer than the listing.
    text = jvm.org.apache.commons.lang3.ArrayUtils.toString(hadoop.FileUtil.stat2Paths(there))
    start = f"{fs.makeQualified(folder).toString()}/dt="
    found: dict[str, list[str]] = {}
    for rest in text[1:-1].removeprefix(start).split(f",{start}"):
        day = rest.partition("/")[0]
        if day in wanted:
            found.setdefault(day, []).append(start + rest)
    return found
