"""Schemas and the fixed values of the trip pipeline.

Everything in the block marked FIXED VALUES must stay equal to the
source pipeline's values for results to match (rule bounds, rename pairs,
code domains, mapping lists, seed rows, holiday ids).  Everything else
(date windows, patterns, sample sizes) is a parameter with a default.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the source pipeline; stated plainly, in order)
# --------------------------------------------------------------------------

# Raw trip columns, in file order.
RAW_COLUMNS = [
    ("VendorID", "bigint"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "double"),
]

# Rows with NULL (or NaN) in any of these are dropped first.
REQUIRED_COLUMNS = [
    "total_amount",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
]

# Range rules: (column, inclusive min, inclusive max); None = no bound.
# The two datetime rules take their bounds from the date window parameter.
RANGE_RULES = [
    ("passenger_count", 0, 6),
    ("fare_amount", 0.1, None),
    ("extra", 0, None),
    ("mta_tax", 0, None),
    ("tip_amount", 0, None),
    ("tolls_amount", 0, None),
    ("improvement_surcharge", 0, None),
    ("total_amount", 3, None),
    ("congestion_surcharge", 0, None),
    ("trip_distance", 0, 100),
]
PICKUP_COLUMN = "tpep_pickup_datetime"
DROPOFF_COLUMN = "tpep_dropoff_datetime"
FEE_COLUMN = "airport_fee"
FEE_BYPASS_VALUE = 1.25
FEE_CLEAN_VALUE = 0.0

# Rename pairs (old, new); matched case-insensitively.
RENAMES = [
    ("VendorID", "vendor_id"),
    ("tpep_pickup_datetime", "pickup_datetime"),
    ("tpep_dropoff_datetime", "dropoff_datetime"),
    ("RatecodeID", "rate_code_id"),
    ("store_and_fwd_flag", "store_and_forward"),
    ("PULocationID", "pickup_location_id"),
    ("DOLocationID", "dropoff_location_id"),
    ("extra", "extra_amount"),
    ("Airport_fee", "airport_fee_amount"),
    ("payment_type", "payment_type_id"),
]

# Code domains; values outside become NULL.
VENDOR_CODES = [1, 2]
RATE_CODES = [1, 2, 3, 4, 5, 6]
PAYMENT_CODES = [1, 2, 3, 4, 5, 6]

MILES_TO_KM = 1.60934
KM_DECIMALS = 3
DATETIME_MARKER = "_datetime"

# First mapping: (source, source type, target, target type), in output order.
FACT_MAPPING = [
    ("trip_id", "string", "trip_id", "string"),
    ("vendor_id", "long", "vendor_id", "int"),
    ("pickup_date_id", "int", "pickup_date_id", "int"),
    ("pickup_time_id", "int", "pickup_time_id", "int"),
    ("dropoff_date_id", "int", "dropoff_date_id", "int"),
    ("dropoff_time_id", "int", "dropoff_time_id", "int"),
    ("passenger_count", "double", "passenger_count", "int"),
    ("trip_distance", "float", "trip_distance", "float"),
    ("pickup_location_id", "long", "pickup_location_id", "int"),
    ("dropoff_location_id", "long", "dropoff_location_id", "int"),
    ("rate_code_id", "double", "rate_code_id", "int"),
    ("store_and_forward", "boolean", "store_and_forward", "boolean"),
    ("payment_type_id", "long", "payment_type_id", "int"),
    ("fare_amount", "double", "fare_amount", "int"),
    ("extra_amount", "double", "extra_amount", "float"),
    ("mta_tax", "double", "mta_tax", "float"),
    ("tip_amount", "double", "tip_amount", "float"),
    ("tolls_amount", "double", "tolls_amount", "float"),
    ("improvement_surcharge", "double", "improvement_surcharge", "float"),
    ("congestion_surcharge", "double", "congestion_surcharge", "float"),
    ("airport_fee_amount", "double", "airport_fee_amount", "float"),
    ("total_amount", "double", "total_amount", "float"),
]

# Second mapping (zone text types -> warehouse types), in output order.
LOAD_MAPPING = [
    ("trip_id", "string", "trip_id", "string"),
    ("vendor_id", "long", "vendor_id", "int"),
    ("pickup_date_id", "long", "pickup_date_id", "int"),
    ("pickup_time_id", "long", "pickup_time_id", "int"),
    ("dropoff_date_id", "long", "dropoff_date_id", "int"),
    ("dropoff_time_id", "long", "dropoff_time_id", "int"),
    ("passenger_count", "long", "passenger_count", "int"),
    ("trip_distance", "double", "trip_distance", "double"),
    ("pickup_location_id", "long", "pickup_location_id", "int"),
    ("dropoff_location_id", "long", "dropoff_location_id", "int"),
    ("rate_code_id", "long", "rate_code_id", "int"),
    ("store_and_forward", "boolean", "store_and_forward", "boolean"),
    ("payment_type_id", "long", "payment_type_id", "int"),
    ("fare_amount", "long", "fare_amount", "double"),
    ("extra_amount", "double", "extra_amount", "double"),
    ("mta_tax", "double", "mta_tax", "double"),
    ("tip_amount", "double", "tip_amount", "double"),
    ("tolls_amount", "double", "tolls_amount", "double"),
    ("improvement_surcharge", "double", "improvement_surcharge", "double"),
    ("congestion_surcharge", "double", "congestion_surcharge", "double"),
    ("airport_fee_amount", "double", "airport_fee_amount", "double"),
    ("total_amount", "double", "total_amount", "double"),
]

# Name-based UUID namespace (RFC 4122 DNS namespace).
UUID_NAMESPACE_DNS_HEX = "6ba7b8109dad11d180b400c04fd430c8"

# Seed dimension rows.
VENDORS = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc"),
]
RATE_CODE_NAMES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
]
PAYMENT_TYPE_NAMES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
# Calendar of the date dimension and its holiday positions (date_id).
CALENDAR_START = _dt.date(2023, 1, 1)
CALENDAR_END = _dt.date(2023, 12, 31)
HOLIDAY_DATE_IDS = [0, 15, 50, 118, 169, 184, 246, 326, 358]

# Link filter and period pattern of the source-file discovery.
SOURCE_LINK_PATTERN = r".*yellow_tripdata_2023.*"
PERIOD_PATTERN = r"\w{4}-\d\d"
ZONE_KEY_FORMAT = "year=%s/month=%s/data.parquet"

# Default cleaning window (string bounds compare as midnight timestamps).
DEFAULT_WINDOW = ("2023-01-01", "2023-12-31")

# --------------------------------------------------------------------------
# End of fixed values
# --------------------------------------------------------------------------

# Window used by queries over the driver tables (order dates 1995..2001).
DRIVER_WINDOW = ("1999-01-01", "1999-12-31")
DRIVER_CALENDAR = (_dt.date(1999, 1, 1), _dt.date(1999, 12, 31))

_TYPE_OBJECTS = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType(),
}


def spark_type(name: str) -> T.DataType:
    return _TYPE_OBJECTS[name]


RAW_SCHEMA = T.StructType(
    [T.StructField(n, spark_type(t), True) for n, t in RAW_COLUMNS]
)
RAW_NAMES = [n for n, _ in RAW_COLUMNS]

FACT_COLUMNS = [dst for _, _, dst, _ in FACT_MAPPING]

_SQL_TYPES = {"string": "string", "int": "int", "long": "bigint",
              "float": "float", "double": "double", "boolean": "boolean"}


def mapping_schema(mapping, side="target"):
    """StructType of a mapping's target (or source) columns."""
    fields = []
    for src, src_t, dst, dst_t in mapping:
        name, typ = (dst, dst_t) if side == "target" else (src, src_t)
        fields.append(T.StructField(name, spark_type(_SQL_TYPES[typ]), True))
    return T.StructType(fields)


# Warehouse fact schema (what the load mapping produces).
FACT_SCHEMA = mapping_schema(LOAD_MAPPING, "target")
# Text-zone schema: how the transformed zone is read back (the load
# mapping's source types).
ZONE_SCHEMA = mapping_schema(LOAD_MAPPING, "source")

# Foreign keys of the fact: (fact column, dimension, dimension key).
FOREIGN_KEYS = [
    ("vendor_id", "dim_vendors", "vendor_id"),
    ("pickup_date_id", "dim_dates", "date_id"),
    ("pickup_time_id", "dim_times", "time_id"),
    ("dropoff_date_id", "dim_dates", "date_id"),
    ("dropoff_time_id", "dim_times", "time_id"),
    ("pickup_location_id", "dim_locations", "location_id"),
    ("dropoff_location_id", "dim_locations", "location_id"),
    ("rate_code_id", "dim_rate_codes", "rate_code_id"),
    ("payment_type_id", "dim_payment_types", "payment_type_id"),
]

PRIMARY_KEYS = [
    ("fact_trips", "trip_id"),
    ("dim_vendors", "vendor_id"),
    ("dim_dates", "date_id"),
    ("dim_times", "time_id"),
    ("dim_locations", "location_id"),
    ("dim_rate_codes", "rate_code_id"),
    ("dim_payment_types", "payment_type_id"),
]
