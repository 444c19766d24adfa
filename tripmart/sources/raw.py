"""Raw zone scan with schema-drift normalisation.

Monthly files disagree on types (bigint vs double, int vs bigint, epoch
nanos vs timestamp) and on name case (`airport_fee` / `Airport_fee`).
Spark's `mergeSchema` rejects such mixes, and an imposed read schema
cannot narrow or switch between integral and floating types, so the raw
zone's months are grouped by schema (one scan per schema, however the months
alternate), each group is cast to the canonical 19-column schema, and the
groups are unioned by name.  See manifest.py for how the schemas are found.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_nanos_to_ntz
from ..functions.timekeys import ntz_from_epoch_seconds
from ..schema import RAW_COLUMNS, RAW_SCHEMA
from .adapter import POSITION_COLUMN
from .manifest import Part, folder_parts, month_folders, probe, scans, zone_files

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def normalise(df: DataFrame, columns=RAW_COLUMNS, keep: Iterable[str] = ()) -> DataFrame:
    """Any drifted raw frame -> the canonical raw columns, in order.

    * names match case-insensitively;
    * LONG columns that should be timestamps are epoch nanoseconds (each
      column is checked on its own type);
    * other types are cast with try_cast (a value that does not fit -> NULL);
    * missing columns become typed NULLs; extra columns are dropped, except
      the position column and those named in `keep`.
    """
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for name, typ in columns:
        f = by_lower.get(name.lower())
        if f is None:
            out.append(F.lit(None).cast(typ).alias(name))
            continue
        c = F.col(f"`{f.name}`")
        if typ == "timestamp_ntz":
            if isinstance(f.dataType, _INTEGRAL):
                c = epoch_nanos_to_ntz(c.cast("bigint"))
            elif isinstance(f.dataType, T.TimestampType):
                # instant -> UTC wall clock, independent of the session zone
                c = ntz_from_epoch_seconds(F.unix_micros(c) / F.lit(1_000_000))
            else:
                c = c.try_cast("timestamp_ntz")
        elif f.dataType.simpleString() != typ:
            c = c.try_cast(typ)
        out.append(c.alias(name))
    for extra in [*keep, POSITION_COLUMN]:
        if extra in df.columns:
            out.append(F.col(f"`{extra}`"))
    return df.select(*out)


def with_file_position(df: DataFrame) -> DataFrame:
    """Add `_src_pos` = hash(file path, row index in file): deterministic."""
    return df.withColumn(POSITION_COLUMN,
                         F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")))


def list_partitions(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, year, month) of every file under a `year=/month=`
    zone; none in an empty zone.  File contents are never read."""
    return zone_files(spark, root).select("path", "length", "year", "month")


def partition_dirs(spark: SparkSession, root: str,
                   months: Iterable[tuple[int, int]] | None = None) -> list[str]:
    """Month folders of the zone that hold Parquet files, by (year, month)."""
    return [f.path for f in month_folders(spark, root, months)]


def schema_runs(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Folders (or files) grouped by schema, each group in order: one scan per
    group.  Footers are read once per folder; a folder whose own files disagree
    is given by its files."""
    found = [p for path in paths for p in probe(spark, path)]
    return [list(p.paths) for p in scans(found)]


def _base(root: str, example: str) -> str:
    """The zone root in the same URI form as the listed paths (`file:/…`)."""
    i = example.find("/year=")
    return example[:i] if i > 0 else root


def read_parts(spark: SparkSession, root: str, parts: Iterable[Part], with_position: bool = True) -> DataFrame:
    """The given parts of a raw zone, normalised to the canonical schema, plus
    `year`, `month` and `_src_pos`; one scan per schema."""
    frames = []
    for scan in scans(parts):
        df = spark.read.option("basePath", _base(root, scan.paths[0])).schema(scan.schema).parquet(*scan.paths)
        if with_position:
            df = with_file_position(df)
        frames.append(normalise(df, keep=("year", "month")))
    if not frames:
        empty = spark.createDataFrame([], RAW_SCHEMA)
        return empty.withColumns({"year": F.lit(None).cast("int"), "month": F.lit(None).cast("int")})
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_raw(spark: SparkSession, root: str, months: Iterable[tuple[int, int]] | None = None,
             with_position: bool = True, manifest: str | None = None) -> DataFrame:
    """Read the raw zone (optionally only some (year, month) partitions),
    normalised to the canonical schema, plus `year`, `month` and `_src_pos`.
    A month that can't be read is an error.  `manifest` names a folder that
    keeps the months' schemas between runs."""
    parts, errors = folder_parts(spark, month_folders(spark, root, months), manifest)
    for e in errors.values():
        raise e
    return read_parts(spark, root.rstrip("/"), [p for ps in parts.values() for p in ps], with_position)
