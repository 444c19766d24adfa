"""What each stage has done with each month, kept beside the stage's output.

A month is done if its last entry says success or empty for the fingerprint
that its input files have now.  So a month whose files changed, whose run was
cut off half-way (its last entry says started) or failed is pending, and one
that no trip survived is not.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import astuple, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.manifest import missing_path

DDL = "stage string, year int, month int, fingerprint string, status string, rows bigint, error string, at bigint"
STARTED, SUCCESS, EMPTY, FAILED = "started", "success", "empty", "failed"
#: Characters of an error that are kept.
ERROR_LENGTH = 2000


@dataclass(frozen=True)
class Entry:
    """One month's state in one stage."""

    stage: str
    year: int
    month: int
    fingerprint: str
    status: str
    rows: int = 0
    error: str | None = None


def record(spark: SparkSession, folder: str, entries: Iterable[Entry]) -> None:
    """Append entries: one small file, after or before the data that they speak of."""
    rows = [(*astuple(e)[:6], e.error[:ERROR_LENGTH] if e.error else None, time.time_ns()) for e in entries]
    if rows:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(folder)


def history(spark: SparkSession, folder: str) -> DataFrame:
    """All entries; none if nothing was recorded yet."""
    try:
        return spark.read.schema(DDL).parquet(folder)
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], DDL)


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The last entry of each stage and month."""
    rest = ("fingerprint", "status", "rows", "error", "at")
    last = history(spark, folder).groupBy("stage", "year", "month").agg(F.max_by(F.struct(*rest), "at").alias("e"))
    return last.select("stage", "year", "month", *(F.col(f"e.{c}").alias(c) for c in rest))


def pending(spark: SparkSession, folder: str, stage: str, inputs: dict[tuple[int, int], str]) -> list[tuple[int, int]]:
    """Months of the inputs (month -> fingerprint now) that the stage has still to do; one row per month is compared."""
    done = latest(spark, folder).where((F.col("stage") == stage) & F.col("status").isin(SUCCESS, EMPTY))
    have = {(r["year"], r["month"]): r["fingerprint"] for r in done.select("year", "month", "fingerprint").collect()}
    return sorted(k for k, fingerprint in inputs.items() if have.get(k) != fingerprint)
