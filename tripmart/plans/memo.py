"""Per-session memo of lazily built DataFrames (plans, never data).

Reading a Parquet table infers its schema with a Spark job, and building
the transform chain costs a few hundred JVM analysis round trips; queries
that share inputs reuse the same DataFrame objects instead of rebuilding
them.  Nothing is cached or materialised: every action still runs the
full plan.  The memo lives on the SparkSession object, so a new session
starts empty.  A plan holds the file listing of its inputs, so it is kept
only as long as the files of its input folder stay the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Hashable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_ATTR = "_tripmart_plan_memo"
_ACCESS = re.compile(r"access_time=\d+")


def files_of(spark: SparkSession, path: str, tables: bool = False) -> list[str] | None:
    """What tells whether the files under a path are still the same: their number and bytes in
    all, and the status (with its time of change) of the path and, for a folder of tables, of each
    table; None where there is no such path.  Takes a few calls, however many files there are.
    """
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [fs.getFileStatus(at), *(fs.listStatus(at) if tables else [])]
        return [fs.getContentSummary(at).toString(), *(_ACCESS.sub("", x.toString()) for x in found)]
    except (Py4JError, AttributeError):  # no such folder, or a session without a JVM of its own
        return None


def memo(spark: SparkSession, key: Hashable, build: Callable[[], object], path: str, tables: bool = True):
    """What build() gives, kept under key until the files under path (a folder of tables, or a table) change."""
    try:
        cache = spark.__dict__.setdefault(_ATTR, {})
    except (AttributeError, TypeError):  # a session object without a __dict__
        return build()
    now = files_of(spark, path, tables)
    if key not in cache or cache[key][0] != now:
        cache[key] = (now, build())
    return cache[key][1]


def clear(spark: SparkSession) -> None:
    spark.__dict__.pop(_ATTR, None)


def table(spark: SparkSession, path: str) -> DataFrame:
    return memo(spark, ("table", path), lambda: spark.read.parquet(path), path, tables=False)
