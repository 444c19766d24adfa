"""Zone sinks and scans: partitioned writes, the text zone, seeds, re-encoding,
catalog registration.

Writes are idempotent: partitions are overwritten dynamically (only the
(year, month) partitions present in the output are replaced), so re-running
a month replaces it instead of appending a second copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ZONE_SCHEMA
from .manifest import missing_path, probe_files, scans, zone_files

PARTITION_COLUMNS = ("year", "month")


def layout_for_write(df: DataFrame, partition_cols: Sequence[str] = PARTITION_COLUMNS,
                     sort_cols: Sequence[str] = ("pickup_date_id", "dropoff_date_id"),
                     num_partitions: int | None = None, tie_breaker: str | None = "trip_id"
                     ) -> DataFrame:
    """Range-partition on (partition columns, sort columns, tie breaker) so
    each task holds a contiguous slice of few (year, month) partitions —
    few files per partition, and a hot month or day is still split across
    tasks by the tie breaker — then sort inside each task so Parquet
    row-group statistics prune on the sort columns."""
    keys = [c for c in [*partition_cols, *sort_cols, tie_breaker] if c and c in df.columns]
    if not keys:
        return df
    out = df.repartitionByRange(num_partitions, *keys) if num_partitions else \
        df.repartitionByRange(*keys)
    sort = [c for c in [*partition_cols, *sort_cols] if c in df.columns]
    return out.sortWithinPartitions(*sort) if sort else out


def write_zone(df: DataFrame, path: str, fmt: str = "parquet",
               partition_cols: Sequence[str] = PARTITION_COLUMNS, mode: str = "overwrite",
               compression: str | None = None, max_records_per_file: int | None = None,
               header: bool = True, layout: bool = True) -> None:
    """Write a `year=/month=` zone.  mode="overwrite" replaces only the
    partitions present in `df` (dynamic partition overwrite)."""
    data = layout_for_write(df, partition_cols) if layout else df
    w = data.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if compression:
        w = w.option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        w = w.option("header", header)
    w.format(fmt).save(path)


def write_text_zone(df: DataFrame, path: str, **kw) -> None:
    """The transformed zone as CSV with a header (the source's text zone)."""
    write_zone(df, path, fmt="csv", **kw)


#: Column that holds the text of a line that does not parse, null for others.
BAD_LINE = "_bad_line"


def scan_text_zone(spark: SparkSession, root: str, schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """Every line of a CSV zone by position (headers and blank lines skipped),
    with `year`/`month` from the directory names and the whole line in
    BAD_LINE if a value has the wrong type, or the line too few or too many
    values.  Go on with good_lines or bad_lines, which look at all values."""
    full = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField(BAD_LINE, T.StringType())])
    return (spark.read.schema(full).option("header", True).option("enforceSchema", True).option("columnPruning", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(root))


def read_text_zone(spark: SparkSession, root: str, schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """Read the CSV zone back with a fixed schema; lines that don't parse are
    left out (`bad_lines` has them), never read as rows of nulls."""
    return good_lines(scan_text_zone(spark, root, schema))


def _parsed(scanned: DataFrame) -> Column:
    """Always true, and names every column: a value that nobody asks for is not
    parsed, and then does not show that its line is bad."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in scanned.columns if c != BAD_LINE)) >= F.lit(-(1 << 63))


def good_lines(scanned: DataFrame) -> DataFrame:
    """The rows of scan_text_zone that parse."""
    return scanned.where(F.col(BAD_LINE).isNull() & _parsed(scanned)).drop(BAD_LINE)


def bad_lines(scanned: DataFrame) -> DataFrame:
    """(year, month, path, line) of the lines of scan_text_zone that don't parse."""
    return scanned.where(F.col(BAD_LINE).isNotNull() & _parsed(scanned)).select("year", "month", F.col("_metadata.file_path").alias("path"), F.col(BAD_LINE).alias("line"))


def through_text(df: DataFrame, schema: T.StructType = ZONE_SCHEMA) -> DataFrame:
    """In-memory equivalent of a CSV round trip: each value printed as text
    and parsed back with the zone type (float 40.234 -> '40.234' -> double
    40.234)."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").cast(f.dataType).alias(f.name)
                       for f in schema.fields if f.name in df.columns])


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Seed dimension file: header, quoted fields with embedded commas."""
    return spark.read.schema(schema).option("header", True).option("quote", '"').csv(path)


def append_table(df: DataFrame, table: str, replace_partitions: bool = False) -> None:
    """Append to a catalog table; with replace_partitions, overwrite the table
    partitions that df touches instead (a rerun replaces, never duplicates)."""
    if replace_partitions:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .insertInto(table)
    else:
        df.write.mode("append").insertInto(table)


def recompress(spark: SparkSession, src: str, dst: str, codec: str = "gzip") -> DataFrame:
    """Re-encode a `year=/month=` Parquet zone with another codec into `dst`,
    skipping files that are already there.

    Every source file gets a partition of its own, `year=/month=/file=<hash of
    its key>`, so that files of one month may differ in schema, a late file is
    converted when it comes, and a rerun after a failure replaces what it had
    written.  Returns the (year, month, file) converted: what one listing
    showed, so a file that arrives meanwhile waits for the next run.  Never
    writes in place."""
    src = src.rstrip("/")
    key = F.regexp_extract("path", r"((?:[^/]*=[^/]*/)+[^/]+)$", 1)
    source = zone_files(spark, src, "*.parquet").where("year is not null and month is not null")
    source = source.select("path", "year", "month", file_id(key).alias("file"))
    try:
        done = zone_files(spark, dst, "*.parquet").select(F.regexp_extract("path", r"/file=([^/]*)/", 1).alias("file")).distinct()
        source = source.join(done, "file", "left_anti")
    except AnalysisException as e:
        if not missing_path(e):
            raise
    todo = sorted((r["year"], r["month"], r["path"], r["file"]) for r in source.collect())
    months = [[path for *_, path, _ in same] for _, same in groupby(todo, lambda t: t[:2])]
    for scan in scans(p for paths in months for p in probe_files(spark, paths)):
        data = spark.read.option("basePath", scan.paths[0][:scan.paths[0].find("/year=")]).schema(scan.schema).parquet(*scan.paths)
        own = F.regexp_extract(F.col("_metadata.file_path"), r"((?:[^/]*=[^/]*/)+[^/]+)$", 1)
        write_zone(data.withColumn("file", file_id(own)), dst, compression=codec, layout=False,
                   partition_cols=(*PARTITION_COLUMNS, "file"))
    return spark.createDataFrame([(y, m, f) for y, m, _, f in todo], "year int, month int, file string")


def file_id(key: Column) -> Column:
    """Name of a file's partition: a hash of its key below the zone's root."""
    return F.concat(F.lit("f"), F.lower(F.hex(F.xxhash64(key))))


def register_zone_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                        schema: T.StructType = ZONE_SCHEMA) -> None:
    """Catalog table over a zone with `year=/month=` partitions, which are
    discovered from the folders (what a crawler does).  Parquet files bring
    their schema; CSV files have a header line and the given schema."""
    if fmt == "csv":
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, year INT, month INT) USING csv "
                  f"OPTIONS (header 'true') PARTITIONED BY (year, month) LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
