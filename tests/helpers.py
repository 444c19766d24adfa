"""Hand-made raw trips for unit tests."""

import datetime as dt

from tripmart.schema import RAW_NAMES, RAW_SCHEMA

BASE = dict(
    VendorID=1, tpep_pickup_datetime=dt.datetime(2023, 3, 1, 10, 0, 0),
    tpep_dropoff_datetime=dt.datetime(2023, 3, 1, 10, 20, 0), passenger_count=1.0,
    trip_distance=2.5, RatecodeID=1.0, store_and_fwd_flag="N", PULocationID=4,
    DOLocationID=7, payment_type=1, fare_amount=12.5, extra=1.0, mta_tax=0.5,
    tip_amount=2.0, tolls_amount=0.0, improvement_surcharge=1.0, total_amount=17.0,
    congestion_surcharge=2.5, airport_fee=0.0,
)


def trip(**kw):
    d = dict(BASE)
    d.update(kw)
    return tuple(d[c] for c in RAW_NAMES)


def trips_df(spark, *rows_):
    return spark.createDataFrame(list(rows_), RAW_SCHEMA)
