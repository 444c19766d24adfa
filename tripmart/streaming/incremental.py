"""Process-only-new-data with Structured Streaming (the job-bookmark role).

A file stream over the raw zone's listing remembers, in its checkpoint,
which files it has seen.  Each micro-batch names the (year, month)
partitions that received new files; those months are re-read IN FULL from
the raw zone, transformed and overwritten.  Re-reading whole months keeps
the partition overwrite correct when a month gains a second file, and makes
a replayed batch (after a failure) idempotent.  `availableNow` processes
everything new and stops — a scheduled incremental run — in batches of
a bounded number of files, each of which is progress that stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import ledger
from ..plans.run import LOAD, TRANSFORM, attempt_loads, attempt_months, state_folder
from ..plans.star import fact_ledger
from ..schema import DEFAULT_WINDOW

# The binaryFile source's fixed schema (a stream needs it up front).
BINARY_FILE_SCHEMA = ("path string, modificationTime timestamp, length bigint, "
                      "content binary")


#: New files of one micro-batch at most; every month among them is worked through in full.
FILES_PER_BATCH = 48


def new_file_stream(spark: SparkSession, root: str, glob: str = "*.parquet", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Streaming listing of a zone's files, oldest first and so many in a
    batch: (path, year, month).  File contents are not read; year/month are
    parsed from the path."""
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", files_per_batch)
             .option("recursiveFileLookup", "true").load(root))
    return files.select(
        "path",
        F.regexp_extract("path", r"/year=(\d+)/", 1).try_cast("int").alias("year"),
        F.regexp_extract("path", r"/month=(\d+)/", 1).try_cast("int").alias("month")) \
        .where("year is not null and month is not null")


def _for_new_months(files: DataFrame, checkpoint: str, work: Callable[[list[tuple[int, int]]], object]) -> list[list[tuple[int, int]]]:
    """Call work with the months of each micro-batch of new files, until none
    is left.  A batch is done once its work is: after a crash the next call
    goes on with the batch that was cut off."""
    done: list[list[tuple[int, int]]] = []

    def batch(new: DataFrame, epoch_id: int) -> None:
        # one row per touched month reaches the driver, never the files' rows
        months = sorted((int(r["year"]), int(r["month"]))
                        for r in new.select("year", "month").distinct().collect())
        if months:
            work(months)
        done.append(months)

    q = (files.writeStream
         .foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return done


def _again(spark: SparkSession, runs: str, stage: str, work: Callable[[list[tuple[int, int]]], object]) -> list[list[tuple[int, int]]]:
    """Work once more through months that failed in an earlier call: their files are not new to the stream."""
    failed = ledger.latest(spark, runs).where((F.col("stage") == stage) & (F.col("status") == ledger.FAILED))
    months = sorted((r["year"], r["month"]) for r in failed.select("year", "month").collect())
    if months:
        work(months)
    return [months] if months else []


def run_incremental(spark: SparkSession, raw_root: str, out_root: str, checkpoint: str,
                    window=DEFAULT_WINDOW, mode: str = "as_written",
                    fmt: str = "parquet", files_per_batch: int = FILES_PER_BATCH) -> list[list[tuple[int, int]]]:
    """Run once over whatever is new since the last run, a bounded number of
    files at a time; returns the months processed per micro-batch.  Months that fail
    don't hold the others up: they are in the ledger, and first in the next call."""
    def work(months):
        return attempt_months(spark, raw_root, out_root, months, window, mode, fmt)

    again = _again(spark, state_folder(out_root, "runs"), TRANSFORM, work)
    return again + _for_new_months(new_file_stream(spark, raw_root, files_per_batch=files_per_batch), checkpoint, work)


def run_load_incremental(spark: SparkSession, zone_root: str, checkpoint: str, fmt: str = "parquet",
                         database: str | None = None, error_budget: float = 0.0, files_per_batch: int = FILES_PER_BATCH) -> list[list[tuple[int, int]]]:
    """The load stage with a progress of its own: months of the transformed
    zone with files that are new since its last run go to fact_trips in full."""
    def work(months):
        return attempt_loads(spark, zone_root, months, fmt, database, error_budget)

    again = _again(spark, fact_ledger(spark, database), LOAD, work)
    return again + _for_new_months(new_file_stream(spark, zone_root, f"*.{fmt}", files_per_batch), checkpoint, work)
