"""The business questions over the star schema.

All of them aggregate to a handful of groups (weekday x hour, borough
pairs, payment types, passenger counts), so partial aggregation before the
shuffle keeps the exchanged data tiny even when one group holds most trips.
Shares and top-k are computed on the aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def demand_heatmap(fact: DataFrame, dim_dates: DataFrame, dim_times: DataFrame) -> DataFrame:
    """Trips by pickup weekday (0 = Monday) x pickup hour.  Weekday is NULL
    for trips whose date id has no calendar row."""
    dd = dim_dates.select(F.col("date_id").alias("pickup_date_id"), "weekday")
    dt = dim_times.select(F.col("time_id").alias("pickup_time_id"), F.col("hour").alias("pickup_hour"))
    return (fact.select("pickup_date_id", "pickup_time_id")
            .join(dd, "pickup_date_id", "left")
            .join(dt, "pickup_time_id", "left")
            .groupBy("weekday", "pickup_hour")
            .agg(F.count(F.lit(1)).alias("trips")))


def demand_peak(heatmap: DataFrame, k: int = 5) -> DataFrame:
    """The k busiest cells (ties broken by weekday, then hour; NULLs last)."""
    return heatmap.orderBy(F.col("trips").desc(), F.col("weekday").asc_nulls_last(),
                           F.col("pickup_hour").asc_nulls_last()).limit(k)


def borough_pairs(labelled: DataFrame) -> DataFrame:
    return (labelled.groupBy("pickup_borough", "dropoff_borough")
            .agg(F.count(F.lit(1)).alias("trips")))


def borough_pairs_topk(labelled: DataFrame, k: int = 10) -> DataFrame:
    """Most frequent pickup -> dropoff borough pairs."""
    return borough_pairs_ranked(borough_pairs(labelled), k)


def borough_pairs_ranked(pairs: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent of counted pairs (ties broken by name; NULLs last)."""
    return pairs.orderBy(
        F.col("trips").desc(), F.col("pickup_borough").asc_nulls_last(),
        F.col("dropoff_borough").asc_nulls_last()).limit(k)


def payment_share(labelled: DataFrame, decimals: int = 6) -> DataFrame:
    """Trips and share of trips per payment type name."""
    return shares(labelled.groupBy("payment_type_name").agg(F.count(F.lit(1)).alias("trips")), decimals)


def shares(counted: DataFrame, decimals: int = 6) -> DataFrame:
    """Share of all trips per payment type name.  The total is summed up from
    the (at most a few) aggregated rows and joined to them."""
    agg = counted.withColumn("_all", F.lit(1))
    total = agg.groupBy("_all").agg(F.sum("trips").alias("_total"))
    return agg.join(total, "_all").select(
        "payment_type_name", "trips", F.round(F.col("trips") / F.col("_total"), decimals).alias("share"))


def avg_total_by_passengers(fact: DataFrame, decimals: int = 4) -> DataFrame:
    return (fact.groupBy("passenger_count")
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.round(F.avg("total_amount"), decimals).alias("avg_total_amount")))


def passenger_premium(fact: DataFrame, more: int = 4, fewer: int = 1,
                      decimals: int = 4) -> DataFrame:
    """Average total with `more` passengers minus with `fewer` (one row)."""
    pc, tot = F.col("passenger_count"), F.col("total_amount")
    a_more = F.avg(F.when(pc == more, tot))
    a_fewer = F.avg(F.when(pc == fewer, tot))
    return fact.where(pc.isin(more, fewer)).agg(
        F.round(a_more, decimals).alias(f"avg_total_{more}"),
        F.round(a_fewer, decimals).alias(f"avg_total_{fewer}"),
        F.round(a_more - a_fewer, decimals).alias("premium"),
    )
