"""Key constraints re-aimed as data-quality jobs (Spark enforces none)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FOREIGN_KEYS, PRIMARY_KEYS


#: Bits of the hash that a uniqueness check sends first: of 10^11 keys, under 1 % share theirs with another.
HASH_BITS = 44
#: Hashes of suspects that go to all tasks; more of them meet the keys in a join by hash.
MAX_BROADCAST = 1_000_000


def _short(key: str) -> Column:
    """A few bytes that stand for a key; null for null."""
    return F.when(F.col(key).isNotNull(), F.shiftrightunsigned(F.xxhash64(F.col(key)), 64 - HASH_BITS))


def _per_hash(df: DataFrame, key: str) -> DataFrame:
    return df.select(_short(key).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))


def _repeated(df: DataFrame, key: str, suspects: int) -> DataFrame:
    """(key, n) of non-null keys that occur more than once: only keys whose
    hash occurs more than once are shuffled whole and counted."""
    hashes = _per_hash(df, key).where("h is not null and n > 1").select("h")
    keys = df.select(F.col(key), _short(key).alias("h"))
    some = keys.join(F.broadcast(hashes) if suspects <= MAX_BROADCAST else hashes, "h", "left_semi")
    return some.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _totals(tables: dict[str, DataFrame], keys: Sequence[tuple[str, str]]) -> list[tuple]:
    """(table, rows, null keys, hashes that occur more than once) of each table, in one job."""
    parts = [_per_hash(tables[name], key).agg(
        F.lit(i).alias("i"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("h").isNotNull() & (F.col("n") > 1)).alias("suspects")) for i, (name, key) in enumerate(keys)]
    return sorted(tuple(r) for r in reduce(DataFrame.unionByName, parts).collect())


def pk_report(tables: dict[str, DataFrame],
              keys: Sequence[tuple[str, str]] = PRIMARY_KEYS) -> DataFrame:
    """Per table: rows, NULL keys, key values occurring more than once.

    First, in one job, only a short hash of every key is shuffled (counts are
    combined map-side, so a key repeated in a third of the rows still leaves
    one row per task).  Where all hashes differ, so do all keys.  Keys that
    share a hash are then counted exactly."""
    columns = "table_name string, key_column string, rows bigint, null_keys bigint, duplicate_keys bigint"
    spark = tables[keys[0][0]].sparkSession
    done, parts = [], []
    for i, rows, nulls, suspects in _totals(tables, keys):
        name, key = keys[i]
        if suspects:
            parts.append(_repeated(tables[name], key, suspects).agg(
                F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), F.lit(rows).cast("bigint").alias("rows"),
                F.lit(nulls).cast("bigint").alias("null_keys"), F.count(F.lit(1)).alias("duplicate_keys")))
        else:
            done.append((name, key, rows, nulls, 0))
    return reduce(DataFrame.unionByName, [spark.createDataFrame(done, columns), *parts])


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """The offending key values themselves: NULL or duplicated."""
    ((_, _, nulls, suspects),) = _totals({"t": df}, [("t", key)])
    out = df.where(F.col(key).isNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")) if nulls else None
    repeated = _repeated(df, key, suspects) if suspects else None
    found = [x for x in (out, repeated) if x is not None]
    return reduce(DataFrame.unionByName, found) if found else df.select(key, F.lit(0).cast("bigint").alias("n")).limit(0)


def fk_orphans(fact: DataFrame, dims: dict[str, DataFrame],
               fks: Sequence[tuple[str, str, str]] = FOREIGN_KEYS) -> DataFrame:
    """Per foreign key: non-NULL fact keys with no dimension row.

    One scan of the fact: each dimension's distinct keys are left-joined with
    a marker column, then a single aggregate counts the misses of all keys at
    once."""
    x = fact.select(*sorted({c for c, _, _ in fks}))
    for i, (col, dim, key) in enumerate(fks):
        keys = dims[dim].select(F.col(key).alias(col)).distinct().withColumn(f"_hit{i}", F.lit(True))
        x = x.join(keys, col, "left")
    aggs = []
    for i, (col, _, _) in enumerate(fks):
        aggs.append(F.count_if(F.col(col).isNotNull() & F.col(f"_hit{i}").isNull()).alias(f"o{i}"))
        aggs.append(F.count_if(F.col(col).isNotNull()).alias(f"c{i}"))
    wide = x.agg(*aggs)
    stack = ", ".join(f"'{c}', '{d}', o{i}, c{i}" for i, (c, d, _) in enumerate(fks))
    return wide.selectExpr(
        f"stack({len(fks)}, {stack}) AS (fk_column, dimension, orphans, checked)")
