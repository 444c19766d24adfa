"""The star schema as catalog tables, and its idempotent load.

Dimensions are small, bounded tables (replicated to every executor by
broadcast at query time — the role of "distribute to all nodes").  The
fact is partitioned by storage (year, month) and written range-partitioned
and sorted on (pickup_date_id, dropoff_date_id) so Parquet statistics prune
date filters — the role of a sort key.  It is deliberately not bucketed on
pickup_date_id: a date column has at most 366 values and one busy day would
become one hot bucket.

A load writes its months into a new folder and then points the table's
partitions at it, so that readers never meet a month half written, and the
files of an emptied month can't come back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import load_mapping
from ..schema import FACT_SCHEMA
from ..sources.manifest import of_months
from ..sources.zones import BAD_LINE, bad_lines, layout_for_write, read_text_zone, scan_text_zone

DIM_SCHEMAS = {
    "dim_vendors": "vendor_id INT, vendor_name STRING",
    "dim_dates": "date_id INT, date DATE, year INT, month INT, day INT, weekday INT, "
                 "is_holiday BOOLEAN",
    "dim_times": "time_id INT, hour INT, minute INT, second INT",
    "dim_locations": "location_id INT, borough STRING, zone STRING",
    "dim_rate_codes": "rate_code_id INT, rate_code_name STRING",
    "dim_payment_types": "payment_type_id INT, payment_type_name STRING",
}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)


def create_star_schema(spark: SparkSession, location: str, database: str | None = None) -> None:
    """CREATE TABLE for the six dimensions and the fact (Parquet, under
    `location`).  Keys are enforced by the quality jobs, not the catalog."""
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, cols in DIM_SCHEMAS.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({cols}) USING parquet "
                  f"LOCATION '{location}/{name}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}fact_trips ({_ddl(FACT_SCHEMA)}, "
              f"year INT, month INT) USING parquet PARTITIONED BY (year, month) "
              f"LOCATION '{location}/fact_trips'")


def load_dims(spark: SparkSession, dims: dict[str, DataFrame], database: str | None = None) -> None:
    """Replace the dimension tables."""
    prefix = f"{database}." if database else ""
    for name, df in dims.items():
        cols = [c.split()[0] for c in DIM_SCHEMAS[name].split(", ")]
        df.select(*cols).write.mode("overwrite").insertInto(f"{prefix}{name}")


def fact_table(database: str | None = None) -> str:
    return f"{database}." * bool(database) + "fact_trips"


def fact_location(spark: SparkSession, database: str | None = None) -> str:
    """The folder of the fact table, as the catalog has it."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {fact_table(database)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def fact_ledger(spark: SparkSession, database: str | None = None) -> str:
    """Folder of the load stage's ledger."""
    return f"{fact_location(spark, database)}/_runs"


def new_version(spark: SparkSession, database: str | None = None) -> str:
    """A folder for the partitions of one load, where no scan or repair of the
    table looks for partitions: what the catalog has replaced stays replaced."""
    return f"{fact_location(spark, database)}/_versions/{uuid.uuid4().hex}"


def point_partitions(spark: SparkSession, folder: str, months: list[tuple[int, int]], database: str | None = None) -> None:
    """Make the table's partitions of the months those of a version folder.

    Each is one change in the catalog: a reader sees a month before or after
    it, never half of it, and the files it has begun to read stay."""
    table, have = fact_table(database), loaded_months(spark, database)
    for y, m in months:
        part, path = f"PARTITION (year = {int(y)}, month = {int(m)})", f"{folder}/year={int(y)}/month={int(m)}"
        spark.sql(f"ALTER TABLE {table} {part} SET LOCATION '{path}'" if (y, m) in have else f"ALTER TABLE {table} ADD IF NOT EXISTS {part} LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def write_version(spark: SparkSession, loaded: DataFrame, months: list[tuple[int, int]], database: str | None = None) -> tuple[str, dict[tuple[int, int], int], dict[tuple[int, int], int]]:
    """Write the fact rows of the months into a new version folder: (folder,
    rows of each month, bad lines of each month).  A month without rows gets an empty partition.

    Rows and bad lines (BAD_LINE not null, if there is such a column) are
    counted while the rows are written, after their exchange: what is below it
    runs once more for its sampling."""
    columns = spark.table(fact_table(database)).columns
    folder = new_version(spark, database)
    bad = F.col(BAD_LINE) if BAD_LINE in loaded.columns else F.lit(None)
    seen = Observation("rows per month")

    def counts(kind: str, wanted: Column) -> list[Column]:
        return [F.count_if(wanted & (F.col("year") == y) & (F.col("month") == m)).alias(f"{kind} {y}-{m}") for y, m in months]

    laid = layout_for_write(loaded.select(*columns, *([BAD_LINE] if BAD_LINE in loaded.columns else [])))
    laid = laid.observe(seen, F.lit(0).alias("none"), *counts("rows", bad.isNull()), *counts("bad", bad.isNotNull()))
    laid.where(bad.isNull()).select(*columns).write.partitionBy("year", "month").parquet(folder)
    rows, hurt = ({(y, m): seen.get[f"{kind} {y}-{m}"] for y, m in months} for kind in ("rows", "bad"))
    for (y, m), n in rows.items():
        if not n:
            loaded.select(*columns).drop("year", "month").limit(0).write.parquet(f"{folder}/year={y}/month={m}")
    return folder, rows, hurt


def load_fact(spark: SparkSession, zone: DataFrame, database: str | None = None) -> None:
    """Second mapping of the transformed trips into fact_trips; replaces only
    the (year, month) partitions present (a rerun replaces, never appends twice)."""
    months = sorted((r["year"], r["month"]) for r in zone.select("year", "month").distinct().collect())
    folder, rows, _ = write_version(spark, load_mapping(zone, passthrough=("year", "month")), months, database)
    point_partitions(spark, folder, sorted(rows), database)


def load_star(spark: SparkSession, fact: DataFrame, dims: dict[str, DataFrame],
              database: str | None = None) -> None:
    """Replace the dimensions and load the fact."""
    load_dims(spark, dims, database)
    load_fact(spark, fact, database)


def read_zone(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The transformed zone in either format; bad lines of a text zone are left out (see `read_text_zone`)."""
    return read_text_zone(spark, root) if fmt == "csv" else spark.read.parquet(root)


def quarantine_folder(spark: SparkSession, database: str | None = None) -> str:
    """Where the load keeps lines that don't parse: year, month, path, line."""
    return f"{fact_location(spark, database)}/_quarantine"


def load_month_versions(spark: SparkSession, zone_root: str, months: list[tuple[int, int]], fmt: str = "parquet", database: str | None = None,
                        error_budget: float = 0.0) -> tuple[dict[tuple[int, int], int], dict[tuple[int, int], str]]:
    """Load the given months of the transformed zone in full: (rows of each
    month loaded, why each other one was refused).

    Lines of a text zone that don't parse are counted while the others are
    written, and kept in the quarantine.  A month of which they are a larger
    share than the budget is refused, and keeps what it held."""
    if not months:
        return {}, {}
    zone = of_months(scan_text_zone(spark, zone_root) if fmt == "csv" else spark.read.parquet(zone_root), months)
    extra = [BAD_LINE] if fmt == "csv" else []
    folder, rows, bad = write_version(spark, load_mapping(zone, passthrough=("year", "month", *extra)), months, database)
    hurt = [k for k in months if bad[k]]
    if hurt:
        bad_lines(of_months(zone, hurt)).write.mode("append").parquet(quarantine_folder(spark, database))
    refused = {k: f"{bad[k]} of {bad[k] + rows[k]} lines don't parse, more than {error_budget:.2%}: see {quarantine_folder(spark, database)}"
               for k in hurt if bad[k] > error_budget * (bad[k] + rows[k])}
    kept = {k: n for k, n in rows.items() if k not in refused}
    point_partitions(spark, folder, sorted(kept), database)
    return kept, refused


def load_months(spark: SparkSession, zone_root: str, months: list[tuple[int, int]],
                fmt: str = "parquet", database: str | None = None, error_budget: float = 0.0) -> None:
    """Load the given months of the transformed zone in full; a month without
    trips is emptied in the table too.  A month over the error budget is an
    error, after the others are loaded."""
    _, refused = load_month_versions(spark, zone_root, months, fmt, database, error_budget)
    if refused:
        raise RuntimeError("months refused: " + "; ".join(f"{y}-{m:02d}: {why}" for (y, m), why in sorted(refused.items())))


def loaded_months(spark: SparkSession, database: str | None = None) -> set[tuple[int, int]]:
    """Months that fact_trips has a partition of."""
    parts = [dict(p.split("=") for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {fact_table(database)}").collect()]
    return {(int(p["year"]), int(p["month"])) for p in parts}
