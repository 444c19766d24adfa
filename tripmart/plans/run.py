"""Runs of the monthly pipeline over every pending partition.

The source fans out one cluster job per month file; here all pending months
go through ONE plan (read -> transform -> partitioned write) and the tasks
provide the parallelism.  Writes overwrite only the months they contain,
so a rerun of a month replaces it.

A month that can't be read fails alone: months whose footers are broken, or
whose columns can't be cast, are left out beforehand; if data pages turn out
broken while the plan runs, its months are halved until the broken ones are
by themselves.  What became of each month is kept in a ledger (ledger.py),
which also says what is pending.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.discover import audit
from ..schema import DEFAULT_WINDOW
from ..sources.manifest import Part, fingerprints, folder_parts, missing_path, month_folders
from ..sources.raw import list_partitions, normalise, read_parts
from ..sources.zones import layout_for_write, write_zone
from . import ledger
from .ledger import EMPTY, FAILED, STARTED, SUCCESS, Entry
from .star import fact_ledger, load_month_versions
from .transform import transform

Month = tuple[int, int]
TRANSFORM, LOAD = "transform", "load"
#: What Spark says of files that can't be read; any other error ends the run.
UNREADABLE = ("[FAILED_READ_FILE", "[CANNOT_READ_FILE_FOOTER", "[PARQUET_", "[UNSUPPORTED_FEATURE.PARQUET", "[MALFORMED_", "[DATATYPE_MISMATCH.CAST_WITHOUT_SUGGESTION",
              "is not a Parquet file", "Could not read footer", "Encountered error while reading file")


def state_folder(root: str, what: str) -> str:
    """Where a zone keeps its ledger and schemas: readers of the zone don't look into folders with a low line."""
    return f"{root.rstrip('/')}/_{what}"


def zone_keys(spark: SparkSession, root: str) -> DataFrame:
    """(key) relative to the zone root, e.g. `year=2023/month=01/x.parquet`;
    an absent zone gives an empty manifest."""
    root = root.rstrip("/")
    try:
        files = list_partitions(spark, root)
    except AnalysisException as e:  # only a missing folder means "nothing there yet"
        if missing_path(e):
            return spark.createDataFrame([], "key string")
        raise
    return files.where("year is not null").select(F.regexp_extract("path", r"((?:[^/]*=[^/]*/)+[^/]+)$", 1).alias("key"))


def zone_months(spark: SparkSession, root: str, glob: str = "*.parquet", months: list[Month] | None = None) -> dict[Month, str]:
    """Fingerprint of each month of a zone; an absent zone has none."""
    try:
        return fingerprints(month_folders(spark, root, months, glob))
    except AnalysisException as e:
        if missing_path(e):
            return {}
        raise


def pending_months(spark: SparkSession, raw_root: str, out_root: str) -> list[Month]:
    """Months of the raw zone that the output zone's ledger doesn't show as done with the files they have now."""
    return ledger.pending(spark, state_folder(out_root, "runs"), TRANSFORM, zone_months(spark, raw_root))


def unreadable(e: Exception) -> bool:
    return any(s in str(e) for s in UNREADABLE)


def one_by_one(months: list[Month], work: Callable[[list[Month]], dict[Month, int]]) -> tuple[dict[Month, int], dict[Month, str]]:
    """(rows, errors) of months that go through work together; if that fails
    on what it reads, each half goes by itself, down to single months.  Any
    other failure is raised."""
    if not months:
        return {}, {}
    try:
        return work(months), {}
    except Exception as e:
        if not unreadable(e):
            raise
        if len(months) == 1:
            return {}, {months[0]: str(e)}
    half = len(months) // 2
    (a, b), (c, d) = one_by_one(months[:half], work), one_by_one(months[half:], work)
    return {**a, **c}, {**b, **d}


def attempt_months(spark: SparkSession, raw_root: str, out_root: str, months: list[Month], window=DEFAULT_WINDOW,
                   mode: str = "as_written", fmt: str = "parquet") -> list[Entry]:
    """Re-read the given months in full, transform, overwrite them; one entry
    per month, which the ledger of the output zone keeps too.

    Rows are counted while they are written.  A month of which no row is left
    gets a partition without rows, which replaces what it held before.  A
    failed month keeps what it held."""
    if not months:
        return []
    runs = state_folder(out_root, "runs")
    folders = month_folders(spark, raw_root, months)
    inputs = fingerprints(folders)
    parts, broken = folder_parts(spark, folders, state_folder(out_root, "schemas"))
    errors = {(f.year, f.month): str(e) for f, e in broken.items()}
    by_month: dict[Month, list[Part]] = {}
    for f, found in parts.items():
        try:
            for p in found:
                normalise(spark.createDataFrame([], p.schema))
        except AnalysisException as e:  # a column that no cast brings to its type
            errors.setdefault((f.year, f.month), str(e))
        by_month.setdefault((f.year, f.month), []).extend(found)
    good = sorted(set(by_month) - set(errors))
    ledger.record(spark, runs, (Entry(TRANSFORM, *k, inputs[k], STARTED) for k in good))

    def write(some: list[Month]) -> dict[Month, int]:
        raw = read_parts(spark, raw_root.rstrip("/"), [p for k in some for p in by_month[k]])
        fact = layout_for_write(transform(raw, window, mode))
        seen = Observation("rows per month")
        counts = [F.count_if((F.col("year") == y) & (F.col("month") == m)).alias(f"{y}-{m}") for y, m in some]
        write_zone(fact.observe(seen, *counts), out_root, fmt=fmt, layout=False)
        rows = {(y, m): seen.get[f"{y}-{m}"] for y, m in some}
        empty = fact.drop("year", "month").limit(0)
        for (y, m), n in rows.items():
            if not n:
                out = empty.write.mode("overwrite").format(fmt)
                (out.option("header", True) if fmt == "csv" else out).save(f"{out_root.rstrip('/')}/year={y}/month={m}")
        return rows

    rows, late = one_by_one(good, write)
    errors |= late
    entries = [Entry(TRANSFORM, *k, inputs[k], SUCCESS if rows[k] else EMPTY, rows[k]) for k in rows]
    entries += [Entry(TRANSFORM, *k, inputs[k], FAILED, 0, errors[k]) for k in errors]
    ledger.record(spark, runs, entries)
    return sorted(entries, key=lambda e: (e.year, e.month))


def process_months(spark: SparkSession, raw_root: str, out_root: str, months: list[Month], window=DEFAULT_WINDOW,
                   mode: str = "as_written", fmt: str = "parquet") -> dict[Month, int]:
    """attempt_months; returns the rows written per month, and raises if a
    month failed, after the others are written."""
    entries = attempt_months(spark, raw_root, out_root, months, window, mode, fmt)
    failed = [f"{e.year}-{e.month:02d}: {e.error}" for e in entries if e.status == FAILED]
    if failed:
        raise RuntimeError("months failed: " + "; ".join(failed))
    return {(e.year, e.month): e.rows for e in entries}


def report(spark: SparkSession, entries: list[Entry]) -> DataFrame:
    """The audit summary (status, partitions, n_partitions, rows) of a run."""
    rows = [(f"year={e.year:04d}/month={e.month:02d}", e.status, e.rows) for e in entries]
    return audit(spark.createDataFrame(rows, "key string, status string, rows bigint"))


def run_pending(spark: SparkSession, raw_root: str, out_root: str, window=DEFAULT_WINDOW,
                mode: str = "as_written", fmt: str = "parquet") -> DataFrame:
    """Process every pending month; returns the audit summary.  Months that
    fail are in it as failed, with their errors in the ledger
    (`run_history`), and are pending again in the next run."""
    months = pending_months(spark, raw_root, out_root)
    return report(spark, attempt_months(spark, raw_root, out_root, months, window, mode, fmt))


def run_history(spark: SparkSession, out_root: str) -> DataFrame:
    """The last entry of every month of a transformed zone: stage, year, month, fingerprint, status, rows, error, at."""
    return ledger.latest(spark, state_folder(out_root, "runs"))


def attempt_loads(spark: SparkSession, zone_root: str, months: list[Month], fmt: str = "parquet", database: str | None = None,
                  error_budget: float = 0.0) -> list[Entry]:
    """Load the given months of the transformed zone into fact_trips, each
    from its own new folder; one entry per month, which the table's ledger keeps too.

    A month with a larger share of lines that don't parse than the budget
    fails; so does one with files that can't be read.  Failed months stay as
    they were."""
    if not months:
        return []
    runs = fact_ledger(spark, database)
    inputs = zone_months(spark, zone_root, f"*.{fmt}", months)
    good = sorted(k for k in months if k in inputs)
    ledger.record(spark, runs, (Entry(LOAD, *k, inputs[k], STARTED) for k in good))
    refused: dict[Month, str] = {}

    def load(some: list[Month]) -> dict[Month, int]:
        rows, over = load_month_versions(spark, zone_root, some, fmt, database, error_budget)
        refused.update(over)
        return rows

    rows, errors = one_by_one(good, load)
    errors |= refused
    entries = [Entry(LOAD, *k, inputs[k], SUCCESS if rows[k] else EMPTY, rows[k]) for k in rows]
    entries += [Entry(LOAD, *k, inputs[k], FAILED, 0, errors[k]) for k in errors]
    ledger.record(spark, runs, entries)
    return sorted(entries, key=lambda e: (e.year, e.month))


def pending_loads(spark: SparkSession, zone_root: str, fmt: str = "parquet", database: str | None = None) -> list[Month]:
    """Months of the transformed zone whose present files fact_trips has not loaded."""
    return ledger.pending(spark, fact_ledger(spark, database), LOAD, zone_months(spark, zone_root, f"*.{fmt}"))


def load_pending(spark: SparkSession, zone_root: str, fmt: str = "parquet", database: str | None = None,
                 error_budget: float = 0.0) -> list[Month]:
    """The load stage as a run: every month that is pending in it; returns
    those loaded.  Failed ones are in the ledger with their errors, and pending again."""
    months = pending_loads(spark, zone_root, fmt, database)
    return [(e.year, e.month) for e in attempt_loads(spark, zone_root, months, fmt, database, error_budget) if e.status != FAILED]
