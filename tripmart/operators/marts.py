"""Fact-to-dimension joins (the reporting view and a fully labelled mart).

Dimensions this small are broadcast by the planner, so the fact is never
shuffled for these joins and the whole view runs as one map-side stage; one
over the broadcast threshold is joined by shuffle.  Left joins keep fact rows whose key
has no dimension row (e.g. date_id 365 of a leap year).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _role(dim: DataFrame, key: str, role_key: str, cols: dict[str, str]) -> DataFrame:
    """Role-playing copy of a dimension: key renamed to `role_key`, selected
    columns renamed per `cols` (dim column -> output name)."""
    return dim.select(F.col(key).alias(role_key), *[F.col(c).alias(o) for c, o in cols.items()])


def trips_datetime(fact: DataFrame, dim_dates: DataFrame, dim_times: DataFrame) -> DataFrame:
    """The reporting view: 13 columns, pickup/dropoff date and h/m/s.

    The source view also left-joins the location dimension twice without
    using a column; with unique location ids those joins change nothing, so
    they are left out."""
    j = (fact
         .join(_role(dim_dates, "date_id", "pickup_date_id", {"date": "pickup_date"}),
               "pickup_date_id", "left")
         .join(_role(dim_dates, "date_id", "dropoff_date_id", {"date": "dropoff_date"}),
               "dropoff_date_id", "left")
         .join(_role(dim_times, "time_id", "pickup_time_id",
                     {"hour": "pickup_hour", "minute": "pickup_minute", "second": "pickup_second"}),
               "pickup_time_id", "left")
         .join(_role(dim_times, "time_id", "dropoff_time_id",
                     {"hour": "dropoff_hour", "minute": "dropoff_minute", "second": "dropoff_second"}),
               "dropoff_time_id", "left"))
    return j.select(
        "trip_id", "trip_distance", "pickup_date", "pickup_hour", "pickup_minute",
        "pickup_second", "dropoff_date", "dropoff_hour", "dropoff_minute", "dropoff_second",
        F.col("passenger_count").cast("int").alias("passenger_count"),
        "payment_type_id", "total_amount",
    )


def trips_labelled(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact with every code resolved to its label: pickup date/weekday/hour,
    borough and zone at both ends, vendor, rate code and payment names (without
    trip_id if the fact has none)."""
    d = dims
    j = (fact
         .join(_role(d["dim_dates"], "date_id", "pickup_date_id",
                     {"date": "pickup_date", "weekday": "pickup_weekday"}), "pickup_date_id", "left")
         .join(_role(d["dim_times"], "time_id", "pickup_time_id", {"hour": "pickup_hour"}),
               "pickup_time_id", "left")
         .join(_role(d["dim_locations"], "location_id", "pickup_location_id",
                     {"borough": "pickup_borough", "zone": "pickup_zone"}), "pickup_location_id", "left")
         .join(_role(d["dim_locations"], "location_id", "dropoff_location_id",
                     {"borough": "dropoff_borough", "zone": "dropoff_zone"}), "dropoff_location_id", "left")
         .join(_role(d["dim_vendors"], "vendor_id", "vendor_id", {"vendor_name": "vendor_name"}),
               "vendor_id", "left")
         .join(_role(d["dim_rate_codes"], "rate_code_id", "rate_code_id",
                     {"rate_code_name": "rate_code_name"}), "rate_code_id", "left")
         .join(_role(d["dim_payment_types"], "payment_type_id", "payment_type_id",
                     {"payment_type_name": "payment_type_name"}), "payment_type_id", "left"))
    return j.select(
        *[c for c in ["trip_id"] if c in fact.columns], "pickup_date", "pickup_weekday", "pickup_hour",
        "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
        "vendor_name", "rate_code_name", "payment_type_name",
        "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount",
    )
