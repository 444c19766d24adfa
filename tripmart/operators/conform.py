"""Conforming: renames, code domains, flags, units, mappings, null columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import flag_to_bool, miles_to_km, null_unless_in
from ..schema import (DATETIME_MARKER, FACT_MAPPING, LOAD_MAPPING,
                      PAYMENT_CODES, RATE_CODES, RENAMES, VENDOR_CODES)

_SQL_TYPES = {"string": "string", "int": "int", "long": "bigint", "float": "float",
              "double": "double", "boolean": "boolean"}


def rename(df: DataFrame, pairs: Sequence[tuple[str, str]] = RENAMES) -> DataFrame:
    """Rename columns; old names match case-insensitively, missing ones are
    skipped.  One projection (no chain of withColumnRenamed)."""
    lookup = {old.lower(): new for old, new in pairs}
    return df.select(*[F.col(f"`{c}`").alias(lookup.get(c.lower(), c)) for c in df.columns])


def conform_codes(df: DataFrame, vendor="vendor_id", rate="rate_code_id",
                  payment="payment_type_id", flag="store_and_forward") -> DataFrame:
    """Out-of-domain codes -> NULL; Y/N flag -> boolean."""
    return df.withColumns({
        vendor: null_unless_in(F.col(vendor), VENDOR_CODES),
        flag: flag_to_bool(F.col(flag)),
        rate: null_unless_in(F.col(rate), RATE_CODES),
        payment: null_unless_in(F.col(payment), PAYMENT_CODES),
    })


def distance_to_km(df: DataFrame, col: str = "trip_distance") -> DataFrame:
    return df.withColumn(col, miles_to_km(F.col(col)))


def conform(df: DataFrame) -> DataFrame:
    """Renamed raw trips -> conformed codes, flag and km distance."""
    return distance_to_km(conform_codes(df))


def drop_by_pattern(df: DataFrame, marker: str = DATETIME_MARKER) -> DataFrame:
    """Drop every column whose name contains `marker`."""
    return df.select(*[f"`{c}`" for c in df.columns if marker not in c])


def apply_mapping(df: DataFrame, mapping: Iterable[tuple[str, str, str, str]],
                  passthrough: Sequence[str] = ()) -> DataFrame:
    """Select + rename + cast; unmapped columns are dropped (except those
    named in `passthrough`, e.g. storage partition columns).

    Casts use try_cast, so a value that does not fit the target type becomes
    NULL instead of failing the job (double -> int truncates toward zero).  A
    FLOAT becomes a DOUBLE by its decimal digits (4.023, not 4.0229997...), as
    it would through a text file.
    """
    cols = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for src, _src_t, dst, dst_t in mapping:
        c = F.col(f"`{src}`")
        if isinstance(types[src], T.FloatType) and dst_t == "double":
            c = c.cast("string")
        cols.append(c.try_cast(_SQL_TYPES[dst_t]).alias(dst))
    cols += [F.col(f"`{c}`") for c in passthrough if c in df.columns]
    return df.select(*cols)


def fact_mapping(df: DataFrame, keep_fare_cents: bool = False,
                 passthrough: Sequence[str] = ()) -> DataFrame:
    """First mapping (transform output types).  The fare is cut to whole
    units as in the source; `keep_fare_cents=True` keeps it as double.  A
    frame without trip_id (the measures alone) is mapped without it."""
    mapping = [m for m in FACT_MAPPING if m[0] != "trip_id" or "trip_id" in df.columns]
    if keep_fare_cents:
        mapping = [(s, st, d, "double" if d == "fare_amount" else dt) for s, st, d, dt in mapping]
    return apply_mapping(df, mapping, passthrough)


def load_mapping(df: DataFrame, passthrough: Sequence[str] = ()) -> DataFrame:
    """Second mapping (zone types -> warehouse types); without trip_id if the
    frame has none."""
    mapping = [m for m in LOAD_MAPPING if m[0] != "trip_id" or "trip_id" in df.columns]
    return apply_mapping(df, mapping, passthrough)


# ---------------------------------------------------------------------------
# Null columns
# ---------------------------------------------------------------------------

# Every character that counts as white space.
_WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

_TESTED_NUMBERS = (T.IntegerType, T.LongType, T.DoubleType)


def _leaves(schema: T.StructType, prefix: str = "", in_array: bool = False):
    """(path, leaf type, inside array-of-struct) for every leaf field."""
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        dt = f.dataType
        if isinstance(dt, T.StructType):
            yield from _leaves(dt, path + ".", in_array)
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
            yield from _leaves(dt.elementType, path + ".", True)
        else:
            yield path, dt, in_array


def _strip(v):
    """Without white space of any kind at both ends."""
    return F.btrim(v, F.lit(_WHITE_SPACE))


def _in_set(value, values: list, dtype) -> F.Column:
    """`value` (already trimmed for strings) is one of `values`; None in the
    set matches NULL."""
    nonnull = [v for v in values if v is not None]
    conds = []
    if None in values:
        conds.append(value.isNull())
    if nonnull:
        conds.append(value.isin(nonnull))
    if not conds:
        return F.lit(False)
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return F.coalesce(out, F.lit(False))


def null_column_report(df: DataFrame, null_strings: Iterable = (None,),
                       null_numbers: Iterable = (None,)) -> DataFrame:
    """(column, dropped) for every leaf — ONE aggregate over the data.

    A string leaf (trimmed) or an int/long/double leaf is droppable when all
    its values are in the given set (None in the set stands for NULL).  NullType
    leaves are always droppable; other types never.  On an empty frame every
    tested leaf is droppable (vacuous truth).
    """
    null_strings, null_numbers = list(null_strings), list(null_numbers)
    tested, fixed = [], []
    for path, dtype, in_array in _leaves(df.schema):
        if isinstance(dtype, T.NullType):
            fixed.append((path, True))
        elif isinstance(dtype, (T.StringType,) + _TESTED_NUMBERS):
            tested.append((path, dtype, in_array))
        else:
            fixed.append((path, False))
    aggs = [F.coalesce(_agg_for(df, path, dtype, in_array, null_strings, null_numbers),
                       F.lit(True)).alias(f"c{i}")
            for i, (path, dtype, in_array) in enumerate(tested)]
    if not aggs:  # only fixed leaves: a one-row aggregate carries the stack
        aggs = [F.lit(True).alias("_none")]
    # Leaves that are never tested (or always dropped) go into the same stack
    # as literals, so the report stays ONE aggregate over the data.
    entries = [f"'{_sql_str(p)}', c{i}" for i, (p, _, _) in enumerate(tested)]
    entries += [f"'{_sql_str(p)}', {str(v).lower()}" for p, v in fixed]
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, dropped boolean")
    return df.agg(*aggs).selectExpr(
        f"stack({len(entries)}, {', '.join(entries)}) AS (column, dropped)")


def null_columns_of_files(spark: SparkSession, paths: str | Sequence[str], null_strings: Iterable = (None,), null_numbers: Iterable = (None,)) -> DataFrame:
    """`null_column_report` of a Parquet table, with as little data read as can be.

    A top-level leaf whose set holds None alone is droppable exactly if its
    count of values is 0, which the files' footers say: those leaves take one
    aggregate that Spark pushes to the footers.  Only the other leaves are read.
    (Pushed aggregates need the Parquet reader of another session setting: a
    session of its own is made for it, and yours keeps its settings.)
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    null_strings, null_numbers = list(null_strings), list(null_numbers)
    df = spark.read.parquet(*paths)
    by_footer = [path for path, dtype, in_array in _leaves(df.schema) if path in df.columns and not in_array
                 and isinstance(dtype, (T.StringType,) + _TESTED_NUMBERS) and (null_strings if isinstance(dtype, T.StringType) else null_numbers) == [None]]
    if not by_footer:
        return null_column_report(df, null_strings, null_numbers)
    counts = footer_counts(spark, paths, by_footer).first()
    known = spark.createDataFrame([(c, counts[f"n{i}"] == 0) for i, c in enumerate(by_footer)], "column string, dropped boolean")
    rest = df.drop(*by_footer)
    return known.unionByName(null_column_report(rest, null_strings, null_numbers)) if rest.columns else known


def footer_counts(spark: SparkSession, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(n0, n1, ...): values that are not null in each column of a Parquet table, from its footers."""
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return apart.read.parquet(*paths).agg(*(F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)))


def _sql_str(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def _agg_for(df, path, dtype, in_array, null_strings, null_numbers):
    is_string = isinstance(dtype, T.StringType)
    values = null_strings if is_string else null_numbers
    parts = path.split(".")
    if not in_array:
        v = F.col(".".join(f"`{p}`" for p in parts))
        return F.bool_and(_in_set(_strip(v) if is_string else v, values, dtype))
    # Inside an array of structs: walk to the first array, then test every
    # element's field with forall.
    schema = df.schema
    outer = []
    for i, p in enumerate(parts):
        f = schema[p]
        outer.append(p)
        if isinstance(f.dataType, T.ArrayType):
            arr = F.col(".".join(f"`{x}`" for x in outer))
            elem_test = _element_test(parts[i + 1:], is_string, values, dtype)
            # A NULL array is one NULL value; an empty one has no values.
            return F.bool_and(F.coalesce(F.forall(arr, elem_test), F.lit(None in values)))
        schema = f.dataType
    raise ValueError(path)


def _element_test(inner, is_string, values, dtype):
    def test(e):  # one-argument lambda for `forall`
        v = e
        for q in inner:
            v = v.getField(q)
        return _in_set(_strip(v) if is_string else v, values, dtype)
    return test


def drop_null_columns(df: DataFrame, null_strings: Iterable = (None,),
                      null_numbers: Iterable = (None,)) -> DataFrame:
    """Drop the leaves `null_column_report` marks; nested leaves are removed
    with `dropFields`.  Runs one aggregate job (the output schema depends on
    the data, so it cannot stay lazy)."""
    report = null_column_report(df, null_strings, null_numbers)
    to_drop = [r["column"] for r in report.where("dropped").collect()]  # one row per column
    out = df
    for path in to_drop:
        parts = path.split(".")
        if len(parts) == 1:
            out = out.drop(parts[0])
        else:
            out = out.withColumn(parts[0], _drop_nested(F.col(f"`{parts[0]}`"),
                                                        out.schema[parts[0]].dataType, parts[1:]))
    return out


def _drop_nested(col, dtype, parts):
    """Remove the field at `parts` below `col`, through structs and arrays of
    structs."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda e: _drop_nested(e, dtype.elementType, parts))
    if len(parts) == 1:
        return col.dropFields(parts[0])
    child = dtype[parts[0]].dataType
    return col.withField(parts[0], _drop_nested(col.getField(parts[0]), child, parts[1:]))
