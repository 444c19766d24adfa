"""Insights from monthly states: partial aggregates per month, merged when they are read.

One pass over a month's facts gives its counts and sums by the groups that
the questions ask for; the states of all months add up to the answers.  After
a load only the months that it touched are aggregated again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.insights import borough_pairs_ranked, demand_peak, shares
from ..sources.manifest import missing_path, of_months
from . import ledger
from .ledger import EMPTY, STARTED, SUCCESS, Entry
from .star import fact_ledger, fact_table

INSIGHTS = "insights"
STATE_DDL = "kind string, a int, b int, trips bigint, amounts bigint, total decimal(38,6), year int, month int"
#: Groups that states are kept by: kind -> the two keys.
HEAT, PAIR, PAYMENT, PASSENGERS = "heat", "pair", "payment", "passengers"


def month_states(fact: DataFrame, dim_dates: DataFrame, dim_times: DataFrame) -> DataFrame:
    """States of the months of fact rows: one scan, one aggregate per group of columns.

    Locations and payment types stay codes, whose names are joined when the
    states are read; weekday and hour take the place of their ids.  Sums are
    exact to six decimals, so they don't depend on the order of rows or months."""
    days = dim_dates.select(F.col("date_id").alias("pickup_date_id"), "weekday")
    hours = dim_times.select(F.col("time_id").alias("pickup_time_id"), "hour")
    rows = fact.join(days, "pickup_date_id", "left").join(hours, "pickup_time_id", "left")
    group = lambda kind, a, b=None: F.struct(F.lit(kind).alias("kind"), a.cast("int").alias("a"), (b if b is not None else F.lit(None)).cast("int").alias("b"))
    groups = F.array(group(HEAT, F.col("weekday"), F.col("hour")), group(PAIR, F.col("pickup_location_id"), F.col("dropoff_location_id")),
                     group(PAYMENT, F.col("payment_type_id")), group(PASSENGERS, F.col("passenger_count")))
    each = rows.select("year", "month", F.col("total_amount").cast("decimal(28,6)").alias("amount"), F.explode(groups).alias("g"))
    return each.groupBy("year", "month", "g.kind", "g.a", "g.b").agg(
        F.count(F.lit(1)).alias("trips"), F.count("amount").alias("amounts"), F.coalesce(F.sum("amount").cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)")).alias("total")) \
        .select("kind", "a", "b", "trips", "amounts", "total", "year", "month")


def refresh_states(spark: SparkSession, folder: str, dim_dates: DataFrame, dim_times: DataFrame, database: str | None = None) -> list[tuple[int, int]]:
    """Aggregate the months of fact_trips that were loaded since their states were written; returns them.

    Each load of a month has an entry of its own in the table's ledger, whose
    time is the fingerprint here.  A month that was emptied loses its states."""
    loads = ledger.latest(spark, fact_ledger(spark, database)).where((F.col("stage") == "load") & F.col("status").isin(SUCCESS, EMPTY))
    inputs = {(r["year"], r["month"]): f"{r['fingerprint']}@{r['at']}" for r in loads.collect()}
    runs = f"{folder.rstrip('/')}/_runs"
    months = ledger.pending(spark, runs, INSIGHTS, inputs)
    if not months:
        return []
    ledger.record(spark, runs, (Entry(INSIGHTS, *k, inputs[k], STARTED) for k in months))
    fact = of_months(spark.table(fact_table(database)), months)
    states = month_states(fact, dim_dates, dim_times)
    # A marker for each month, so that one without facts is replaced too.
    marks = spark.createDataFrame([("none", None, None, 0, 0, None, *k) for k in months], STATE_DDL)
    states.unionByName(marks).repartition("year", "month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(folder)
    ledger.record(spark, runs, (Entry(INSIGHTS, *k, inputs[k], SUCCESS) for k in months))
    return months


def read_states(spark: SparkSession, folder: str) -> DataFrame:
    """The states of all months; none if none were written."""
    try:
        return spark.read.schema(STATE_DDL).parquet(folder)
    except AnalysisException as e:
        if not missing_path(e):
            raise
        return spark.createDataFrame([], STATE_DDL)


def _merged(states: DataFrame, kind: str, *columns: Column) -> DataFrame:
    return states.where(F.col("kind") == kind).groupBy(*columns).agg(
        F.sum("trips").cast("bigint").alias("trips"), F.sum("amounts").alias("amounts"), F.sum("total").alias("total"))


def heatmap(states: DataFrame) -> DataFrame:
    """I1 from states."""
    return _merged(states, HEAT, F.col("a").alias("weekday"), F.col("b").alias("pickup_hour")).select("weekday", "pickup_hour", "trips")


def peak(states: DataFrame, k: int = 5) -> DataFrame:
    """I2 from states."""
    return demand_peak(heatmap(states), k)


def borough_pairs_topk(states: DataFrame, dim_locations: DataFrame, k: int = 10) -> DataFrame:
    """I3 from states: pairs of locations become pairs of boroughs."""
    pairs = _merged(states, PAIR, F.col("a"), F.col("b"))
    for key, name in (("a", "pickup_borough"), ("b", "dropoff_borough")):
        pairs = pairs.join(dim_locations.select(F.col("location_id").alias(key), F.col("borough").alias(name)), key, "left")
    return borough_pairs_ranked(pairs.groupBy("pickup_borough", "dropoff_borough").agg(F.sum("trips").alias("trips")), k)


def payment_share(states: DataFrame, dim_payment_types: DataFrame, decimals: int = 6) -> DataFrame:
    """I4 from states."""
    named = _merged(states, PAYMENT, F.col("a").alias("payment_type_id")).join(dim_payment_types, "payment_type_id", "left")
    return shares(named.groupBy("payment_type_name").agg(F.sum("trips").alias("trips")), decimals)


def avg_total_by_passengers(states: DataFrame, decimals: int = 4) -> DataFrame:
    """I5 from states."""
    mean = F.col("total").cast("double") / F.when(F.col("amounts") > 0, F.col("amounts"))
    return _merged(states, PASSENGERS, F.col("a").alias("passenger_count")).select("passenger_count", "trips", F.round(mean, decimals).alias("avg_total_amount"))


def passenger_premium(states: DataFrame, more: int = 4, fewer: int = 1, decimals: int = 4) -> DataFrame:
    """I6 from states (one row)."""
    rows = states.where((F.col("kind") == PASSENGERS) & F.col("a").isin(more, fewer))
    mean = lambda n: F.sum(F.when(F.col("a") == n, F.col("total"))).cast("double") / F.sum(F.when((F.col("a") == n) & (F.col("amounts") > 0), F.col("amounts")))
    return rows.agg(F.round(mean(more), decimals).alias(f"avg_total_{more}"), F.round(mean(fewer), decimals).alias(f"avg_total_{fewer}"),
                    F.round(mean(more) - mean(fewer), decimals).alias("premium"))
