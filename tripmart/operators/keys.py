"""Deterministic trip keys.

trip_id = uuid5(DNS, canonical_name(row) + '-' + occurrence), where
occurrence numbers the rows sharing one canonical name 1..n.  The name starts
with the storage (year, month) of the row where it has one: a month is always
processed in full, so its ids do not depend on which other months share the
run.  Identical rows are interchangeable, so the multiset of ids depends only
on the data: the same on every rerun, under any partitioning, after retries.

Scale: a naive `row_number() OVER (PARTITION BY name)` sends a group of
copies to one task; if one trip is copied into a third of the data, that
task gets a third of the data.  Here each row also carries a salt taken
from its source position (`_src_pos`), so a name group is split into
`salt_buckets` sub-groups.  A frame without positions is split by the rows'
content and then by a running number, which only tells equal rows apart.

  1. ONE shuffle of the rows by (name hash, salt) and ONE sort: `row_number`
     inside the sub-group gives the local index;
  2. the sizes are counted by hash aggregation over the same shuffled rows
     (Spark reuses the exchange, so the input is read once; nothing is sorted);
  3. a running sum over the salts of each name gives the sub-group's
     offset (at most `salt_buckets` rows per name, whatever the skew);
  4. offsets join back on (name hash, salt), big side already partitioned.

Names are grouped by a 96-bit hash (xxhash64 + murmur3); only the hashes
cross the shuffle and the ~150-byte name is rebuilt afterwards.  A hash
collision could only merge the numbering of two names — their ids stay
distinct because the names differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import uuid5
from ..functions.timekeys import format_ntz

# Columns of the canonical name, in the transform's column order at the
# point where ids are assigned (renamed, conformed, distance in km).
KEY_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "rate_code_id", "store_and_forward", "pickup_location_id",
    "dropoff_location_id", "payment_type_id", "fare_amount", "extra_amount",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge", "airport_fee_amount",
]

# Storage partition of a row; part of the name where the frame has it.
STORAGE_COLUMNS = ("year", "month")

DEFAULT_SALT_BUCKETS = 1024


def canonical_text(col: Column, dtype: T.DataType) -> Column:
    """Engine-independent text of one value; NULL -> 'None'.

    Floating values are written as integer thousandths (doubles print
    differently across engines: '1.0E16' vs '1e+16'), those beyond the BIGINT
    range as their shortest text; timestamps as
    'yyyy-MM-dd HH:mm:ss'; booleans 'true'/'false'.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        txt = F.coalesce(thousandths(col).cast("string"), col.cast("string"))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        txt = format_ntz(col)
    else:
        txt = col.cast("string")
    return F.coalesce(txt, F.lit("None"))


def thousandths(col: Column) -> Column:
    """round(x * 1000) half away from zero as BIGINT; NaN, infinities and
    values beyond the BIGINT range -> NULL.  Plain floor arithmetic: Spark's
    `round` on doubles goes through BigDecimal (~1 µs per value)."""
    v = col * F.lit(1000.0)
    r = F.when(v < 0, -F.floor(-v + F.lit(0.5))).otherwise(F.floor(v + F.lit(0.5)))
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(9.2e18)), r)


def canonical_name(df: DataFrame, columns: Sequence[str] = KEY_COLUMNS) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.concat_ws("-", *[canonical_text(F.col(c), types[c]) for c in columns])


def with_trip_id(df: DataFrame, columns: Sequence[str] = KEY_COLUMNS,
                 position: str | None = "_src_pos", id_col: str = "trip_id",
                 salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Add `id_col`; drops `position` from the output."""
    has_pos = position is not None and position in df.columns
    names = [*[c for c in STORAGE_COLUMNS if c in df.columns], *columns]
    rest = [c for c in df.columns if c != position]
    values = [F.col(f"`{c}`") for c in rest]
    pos = F.coalesce(F.col(position), F.lit(0).cast("bigint")) if has_pos else F.monotonically_increasing_id()
    name = canonical_name(df, names)
    # Without a position, rows of one name are numbered by their content first:
    # a salt that a rerun may change then only tells rows apart that are equal.
    content = F.lit(0).cast("bigint") if has_pos else F.xxhash64(*values)
    x = df.select(*values, pos.alias("_k_pos"),
                  F.xxhash64(name).alias("_k_h1"), F.hash(name).alias("_k_h2"), content.alias("_k_content"),
                  # (never NULL, or the join below would filter one branch and not the other)
                  F.coalesce(F.pmod(pos, F.lit(salt_buckets)).cast("int"), F.lit(0)).alias("_k_salt"))
    x = x if not has_pos else x.drop("_k_content")
    sub = ["_k_h1", "_k_h2", *([] if has_pos else ["_k_content"]), "_k_salt"]
    x = x.repartition(*sub)
    # Ordered by the position, so that rows that share a name but differ in a
    # sub-cent value get a deterministic number.
    w = Window.partitionBy(*sub).orderBy(F.col("_k_pos") if has_pos else F.lit(0), *[c.asc_nulls_first() for c in values])
    # Sizes are counted by hashing over the rows' own exchange: what the digest
    # of all columns is for is that this branch asks for the same columns.
    sizes = x.groupBy(*sub).agg(F.count(F.lit(1)).alias("_k_n"), F.max(F.xxhash64(*values, "_k_pos")).alias("_k_any"))
    sizes = sizes.where(F.col("_k_any").isNotNull()).select(*sub, "_k_n")
    w_name = (Window.partitionBy("_k_h1", "_k_h2").orderBy(*sub[2:])
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*sub, F.coalesce(F.sum("_k_n").over(w_name), F.lit(0)).alias("_k_off"))
    y = x.withColumn("_k_local", F.row_number().over(w)).join(offsets, on=sub, how="inner")
    occurrence = (F.col("_k_off") + F.col("_k_local")).cast("string")
    return y.select(
        uuid5(F.concat_ws("-", canonical_name(df, names), occurrence)).alias(id_col),
        *values,
    )
