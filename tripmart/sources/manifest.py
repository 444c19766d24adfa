"""What a zone holds, month by month: files, fingerprints and schemas.

The driver sees one row per month folder.  A folder's footers are merged by
the executors, once; what was found is kept under the folder's fingerprint, so
that the next run reads the footers of new and changed months only.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders whose footers are looked at together.
PROBES = 8
MANIFEST_DDL = "folder string, fingerprint string, parts string"


def missing_path(e: Exception) -> bool:
    """Whether a read failed because its folder does not exist (and for nothing else)."""
    return isinstance(e, AnalysisException) and "[PATH_NOT_FOUND]" in str(e)


def zone_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime, year, month) of every file of a
    `year=/month=` zone; year and month are null for files outside.  An empty
    zone gives an empty frame, a missing one an error.  Contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    value = lambda name: F.regexp_extract("path", rf"/{name}=(\d+)/", 1).try_cast("int").alias(name)
    return reader.load(root.rstrip("/")).select("path", "length", "modificationTime", value("year"), value("month"))


def of_months(df: DataFrame, months: Iterable[tuple[int, int]] | None) -> DataFrame:
    """Rows of the given (year, month); all of them for None."""
    if months is None:
        return df
    by_year: dict[int, list[int]] = {}
    for y, m in months:
        by_year.setdefault(int(y), []).append(int(m))
    wanted = F.lit(False)
    for y, ms in sorted(by_year.items()):
        wanted = wanted | (F.col("year") == y) & F.col("month").isin(sorted(ms))
    return df.where(wanted)


@dataclass(frozen=True)
class Folder:
    """One month folder; its fingerprint changes with any file's key, length or time."""

    year: int
    month: int
    path: str
    fingerprint: str


def month_folders(spark: SparkSession, root: str, months: Iterable[tuple[int, int]] | None = None, glob: str | None = "*.parquet") -> list[Folder]:
    """The month folders of a zone, by year and month, files in sub-folders included."""
    files = of_months(zone_files(spark, root, glob), months).where("year is not null and month is not null")
    folder = F.regexp_extract("path", r"^(.*/year=[^/]+/month=[^/]+)/", 1)
    key = F.regexp_extract("path", r"(/year=[^/]+/month=[^/]+/.*)$", 1)
    one = F.xxhash64(key, "length", "modificationTime")
    rows = files.select("year", "month", folder.alias("folder"), one.alias("h")).groupBy("year", "month", "folder") \
        .agg(F.concat_ws("-", F.count("*"), F.hex(F.bit_xor("h")), F.hex(F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)))).alias("fingerprint")).collect()
    return sorted((Folder(r["year"], r["month"], r["folder"], r["fingerprint"]) for r in rows), key=lambda f: (f.year, f.month, f.path))


def fingerprints(folders: Iterable[Folder]) -> dict[tuple[int, int], str]:
    """One fingerprint per month, of all its folders."""
    out: dict[tuple[int, int], str] = {}
    for f in folders:
        known = out.get((f.year, f.month))
        out[f.year, f.month] = f"{known},{f.fingerprint}" if known else f.fingerprint
    return out


@dataclass(frozen=True)
class Part:
    """Paths that one scan can read with one schema: a folder, or those of its files that agree."""

    paths: tuple[str, ...]
    schema: T.StructType

    @property
    def shape(self) -> str:
        """Equal for schemas that read alike: names in any case and order, and types."""
        return json.dumps(sorted((f.name.lower(), f.dataType.simpleString()) for f in self.schema.fields))


def _merged(spark: SparkSession, *paths: str) -> T.StructType:
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths).schema


def _conflict(e: Exception) -> bool:
    return "[CANNOT_MERGE_" in str(e)


def probe_files(spark: SparkSession, paths: list[str]) -> list[Part]:
    """Parts of given files: one if their footers merge, else by equal schemas."""
    try:
        return [Part(tuple(paths), _merged(spark, *paths))]
    except Exception as e:
        if not _conflict(e) or len(paths) == 1:
            raise
    return scans(Part((path,), _merged(spark, path)) for path in paths)


def probe(spark: SparkSession, folder: str) -> list[Part]:
    """The parts of one folder, from its footers; files are told apart only where they disagree."""
    try:
        return probe_files(spark, [folder])
    except Exception as e:
        if not _conflict(e):
            raise
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return probe_files(spark, sorted(r["path"] for r in files.select("path").collect()))


def _saved(spark: SparkSession, manifest: str | None) -> dict[tuple[str, str], list[Part]]:
    if not manifest:
        return {}
    try:
        rows = spark.read.schema(MANIFEST_DDL).parquet(manifest).collect()
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return {}
    return {(r["folder"], r["fingerprint"]): [Part(tuple(p["paths"]), T.StructType.fromJson(p["schema"])) for p in json.loads(r["parts"])] for r in rows}


def folder_parts(spark: SparkSession, folders: list[Folder], manifest: str | None = None) -> tuple[dict[Folder, list[Part]], dict[Folder, Exception]]:
    """(parts, error) of each folder.  Footers are read of folders that the
    manifest (a path, or None) does not know by their fingerprint; those
    found are added to it."""
    known = _saved(spark, manifest)
    found = {f: known[f.path, f.fingerprint] for f in folders if (f.path, f.fingerprint) in known}
    fresh, errors = [f for f in folders if f not in found], {}
    with ThreadPoolExecutor(PROBES) as pool:
        for f, future in [(f, pool.submit(probe, spark, f.path)) for f in fresh]:
            try:
                found[f] = future.result()
            except Exception as e:  # noqa: BLE001 (a folder that can't be read is told to the caller)
                errors[f] = e
    rows = [(f.path, f.fingerprint, json.dumps([{"paths": p.paths, "schema": p.schema.jsonValue()} for p in found[f]])) for f in fresh if f in found]
    if manifest and rows:
        spark.createDataFrame(rows, MANIFEST_DDL).coalesce(1).write.mode("append").parquet(manifest)
    return {f: found[f] for f in folders if f in found}, errors


def scans(parts: Iterable[Part]) -> list[Part]:
    """Parts put together by shape: one scan each, however the months alternate."""
    by_shape: dict[str, Part] = {}
    for p in parts:
        known = by_shape.get(p.shape)
        by_shape[p.shape] = Part((*known.paths, *p.paths), known.schema) if known else p
    return list(by_shape.values())
