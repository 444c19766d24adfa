"""Drifted monthly raw files written with pyarrow (types differ per month)."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq

from helpers import BASE
from tripmart.schema import RAW_NAMES


def _rows(month, n, seed):
    out = []
    for i in range(n):
        r = dict(BASE)
        r["tpep_pickup_datetime"] = dt.datetime(2023, month, 1 + i % 27, 8, i % 60, 0)
        r["tpep_dropoff_datetime"] = dt.datetime(2023, month, 1 + i % 27, 9, i % 60, 0)
        r["fare_amount"] = 10.0 + i + seed
        r["total_amount"] = 15.0 + i + seed
        out.append(r)
    return out


def write_month(root, month, n=5, variant="A", seed=0, name="data.parquet"):
    rows = _rows(month, n, seed)
    cols = {c: [r[c] for r in rows] for c in RAW_NAMES}
    fields = []
    for c in RAW_NAMES:
        v = cols[c]
        if c in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
            t = pa.timestamp("ns") if variant == "C" else pa.timestamp("us")
        elif c in ("VendorID",):
            t = pa.int32() if variant == "B" else pa.int64()
        elif c == "passenger_count":
            t = pa.int64() if variant == "B" else pa.float64()
            v = [int(x) for x in v] if variant == "B" else v
        elif c in ("PULocationID", "DOLocationID", "payment_type"):
            t = pa.int64()
        elif c == "store_and_fwd_flag":
            t = pa.string()
        else:
            t = pa.float64()
        name_ = "Airport_fee" if (c == "airport_fee" and variant == "B") else c
        fields.append((name_, pa.array(v, type=t)))
    table = pa.table({k: a for k, a in fields})
    d = os.path.join(root, "year=2023", f"month={month:02d}")
    os.makedirs(d, exist_ok=True)
    pq.write_table(table, os.path.join(d, name), version="2.6", compression="zstd")
    return d
