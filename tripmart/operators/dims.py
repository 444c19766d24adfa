"""Dimensions of the star schema.

Each is small by nature (calendar days, 86,400 seconds, a handful of codes,
the location list).  Joins carry no broadcast hint: the planner broadcasts a
dimension by its size in bytes, and AQE by the size it turns out to have.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import weekday
from ..schema import (CALENDAR_END, CALENDAR_START, HOLIDAY_DATE_IDS,
                      PAYMENT_TYPE_NAMES, RATE_CODE_NAMES, VENDORS)

SECONDS_PER_DAY = 86_400


def dim_times(spark: SparkSession) -> DataFrame:
    """time_id 0..86399 with hour, minute, second (h, m, s order)."""
    r = spark.range(SECONDS_PER_DAY, numPartitions=1)
    return r.select(
        F.col("id").cast("int").alias("time_id"),
        (F.col("id") / 3600).cast("int").alias("hour"),
        ((F.col("id") % 3600) / 60).cast("int").alias("minute"),
        (F.col("id") % 60).cast("int").alias("second"),
    )


def dim_dates(spark: SparkSession, start: _dt.date = CALENDAR_START,
              end: _dt.date = CALENDAR_END,
              holidays: Sequence[int] = HOLIDAY_DATE_IDS) -> DataFrame:
    """Daily calendar; date_id = position from `start`; is_holiday = date_id
    in `holidays`."""
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError(f"calendar ends before it starts: {start} .. {end}")
    r = spark.range(days, numPartitions=1)
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return r.select(
        F.col("id").cast("int").alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        weekday(d).alias("weekday"),
        F.col("id").isin(list(holidays)).alias("is_holiday"),
    )


def _code_table(spark: SparkSession, rows: Sequence[tuple[int, str]], key: str, name: str) -> DataFrame:
    """Literal rows as a local relation, whose size the planner knows."""
    items = F.array(*(F.struct(F.lit(k).cast("int").alias(key), F.lit(v).alias(name)) for k, v in rows))
    return spark.range(1, numPartitions=1).select(F.inline(items))


def dim_vendors(spark: SparkSession) -> DataFrame:
    return _code_table(spark, VENDORS, "vendor_id", "vendor_name")


def dim_rate_codes(spark: SparkSession) -> DataFrame:
    return _code_table(spark, RATE_CODE_NAMES, "rate_code_id", "rate_code_name")


def dim_payment_types(spark: SparkSession) -> DataFrame:
    return _code_table(spark, PAYMENT_TYPE_NAMES, "payment_type_id", "payment_type_name")


def dim_locations_from(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Driver stand-in for the location seed: nation = zone, region = borough."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("int").alias("location_id"),
                    F.col("r_name").alias("borough"),
                    F.col("n_name").alias("zone")))


def star_dims(spark: SparkSession, locations: DataFrame,
              calendar: tuple[_dt.date, _dt.date] = (CALENDAR_START, CALENDAR_END),
              holidays: Sequence[int] = HOLIDAY_DATE_IDS) -> dict[str, DataFrame]:
    """All six dimensions by table name."""
    return {
        "dim_vendors": dim_vendors(spark),
        "dim_dates": dim_dates(spark, calendar[0], calendar[1], holidays),
        "dim_times": dim_times(spark),
        "dim_locations": locations,
        "dim_rate_codes": dim_rate_codes(spark),
        "dim_payment_types": dim_payment_types(spark),
    }
