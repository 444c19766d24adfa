"""Driver-table adapter: order line items shaped as raw taxi trips.

The test tables are TPC-H-like, not trip records.  `raw_trips` joins
lineitem -> orders -> customer -> supplier and derives each of the 19
raw-trip columns from them with a fixed formula, so that every cleaning
rule, code domain and dimension join is exercised on data that grows with
the tables.  The DuckDB form of the same adapter is `RAW_TRIPS_SQL`.

Each row also carries `_src_pos`, a hash of the line item's file position
(`_metadata.file_path`, `_metadata.row_index`): a deterministic identity
used to split groups of identical trips when keys are assigned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POSITION_COLUMN = "_src_pos"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (the DataFrame is built once per session: schema
    inference is a Spark job)."""
    from ..plans.memo import table as memo_table
    return memo_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_position(df: DataFrame) -> Column:
    """Deterministic 64-bit identity of a row's place in its source file."""
    return F.xxhash64(df["_metadata.file_path"], df["_metadata.row_index"])


def raw_trips_from(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                   supplier: DataFrame, with_position: bool = True) -> DataFrame:
    li = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag",
        *([file_position(lineitem).alias(POSITION_COLUMN)] if with_position else []),
    )
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = customer.select("c_custkey", "c_nationkey")
    s = supplier.select("s_suppkey", "s_nationkey")
    # No broadcast hints: customer and supplier grow with the data, so the
    # planner (and AQE at runtime) picks broadcast only under its size limit.
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, F.col("o_custkey") == c.c_custkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey))

    T = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 101
         + F.col("l_linenumber") * 31) % 86400
    U = T + (F.col("l_partkey") * 97 + F.col("l_suppkey") * 13) % 5400 - 120
    # round(price * 100) as BIGINT.  Prices carry two decimals, so price*100
    # is within 1e-9 of an integer and floor(v + 0.5) is the same integer
    # (checked on every row of sf0.001/0.01/0.1); Spark's `round` on a
    # double goes through BigDecimal, and the filter inlines X ~8 times.
    X = F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5))
    d = lambda c: c.cast("double")
    pk, sk, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    cols = [
        (sk % 4).alias("VendorID"),
        # (adding a day-time interval to a TIMESTAMP_NTZ is plain microsecond
        # arithmetic, cheaper than timestamp_add's calendar path)
        (F.col("o_orderdate") + F.make_dt_interval(secs=T)).alias("tpep_pickup_datetime"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=U)).alias("tpep_dropoff_datetime"),
        F.when(pk % 50 == 0, F.lit(None).cast("double"))
         .otherwise(d(F.col("l_quantity").cast("int") % 9)).alias("passenger_count"),
        (d(X % 12000) / 100).alias("trip_distance"),
        d(pk % 8).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y")
         .when(F.col("l_returnflag") == "A", "N").alias("store_and_fwd_flag"),
        F.when(ok % 200 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("c_nationkey").cast("bigint")).alias("PULocationID"),
        F.col("s_nationkey").cast("bigint").alias("DOLocationID"),
        (ok % 8).alias("payment_type"),
        (d(X % 9000 - 100) / 100).alias("fare_amount"),
        (d(F.col("l_linenumber") % 4) / 2).alias("extra"),
        F.when(pk % 97 == 0, F.lit(-0.5)).otherwise(F.lit(0.5)).alias("mta_tax"),
        (d(sk % 11) / 2).alias("tip_amount"),
        F.when(sk % 13 == 0, F.lit(6.55)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (d(X % 9000) / 100 + 1).alias("total_amount"),
        F.when(pk % 5 == 0, F.lit(0.0)).when(pk % 5 == 1, F.lit(-2.5))
         .otherwise(F.lit(2.5)).alias("congestion_surcharge"),
        F.when(ok % 10 == 0, F.lit(1.25)).when(ok % 10 == 1, F.lit(1.75))
         .when(ok % 10 == 2, F.lit(None).cast("double"))
         .otherwise(F.lit(0.0)).alias("airport_fee"),
    ]
    if with_position:
        cols.append(F.col(POSITION_COLUMN))
    return j.select(*cols)


def raw_trips(spark: SparkSession, sf_dir: str, with_position: bool = True) -> DataFrame:
    """Raw-trip-shaped rows (19 columns, plus `_src_pos`) from the driver tables."""
    return raw_trips_from(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"),
        with_position=with_position,
    )


# DuckDB form of the adapter (a CTE body over the pre-registered views).
RAW_TRIPS_SQL = """
SELECT
  l_suppkey % 4 AS VendorID,
  o_orderdate + to_seconds(((l_orderkey*7919 + l_partkey*101 + l_linenumber*31) % 86400)::BIGINT) AS tpep_pickup_datetime,
  o_orderdate + to_seconds((((l_orderkey*7919 + l_partkey*101 + l_linenumber*31) % 86400)
       + (l_partkey*97 + l_suppkey*13) % 5400 - 120)::BIGINT) AS tpep_dropoff_datetime,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE (CAST(l_quantity AS INTEGER) % 9)::DOUBLE END AS passenger_count,
  ((CAST(round(l_extendedprice*100) AS BIGINT) % 12000)::DOUBLE) / 100 AS trip_distance,
  (l_partkey % 8)::DOUBLE AS RatecodeID,
  CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END AS store_and_fwd_flag,
  CASE WHEN l_orderkey % 200 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS PULocationID,
  CAST(s_nationkey AS BIGINT) AS DOLocationID,
  l_orderkey % 8 AS payment_type,
  ((CAST(round(l_extendedprice*100) AS BIGINT) % 9000 - 100)::DOUBLE) / 100 AS fare_amount,
  ((l_linenumber % 4)::DOUBLE) / 2 AS extra,
  CASE WHEN l_partkey % 97 = 0 THEN -0.5::DOUBLE ELSE 0.5::DOUBLE END AS mta_tax,
  ((l_suppkey % 11)::DOUBLE) / 2 AS tip_amount,
  CASE WHEN l_suppkey % 13 = 0 THEN 6.55::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
  1.0::DOUBLE AS improvement_surcharge,
  ((CAST(round(l_extendedprice*100) AS BIGINT) % 9000)::DOUBLE) / 100 + 1 AS total_amount,
  CASE WHEN l_partkey % 5 = 0 THEN 0.0::DOUBLE WHEN l_partkey % 5 = 1 THEN -2.5::DOUBLE ELSE 2.5::DOUBLE END AS congestion_surcharge,
  CASE WHEN l_orderkey % 10 = 0 THEN 1.25::DOUBLE WHEN l_orderkey % 10 = 1 THEN 1.75::DOUBLE
       WHEN l_orderkey % 10 = 2 THEN NULL ELSE 0.0::DOUBLE END AS airport_fee
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey
"""
