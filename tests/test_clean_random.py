"""Cleaning vs. an independent Python model of SQL three-valued logic on
random rows (NULLs, NaN, bounds, both precedences)."""

import datetime as dt
import math
import random

from helpers import trip, trips_df

from tripmart.operators import clean as C
from tripmart.schema import RANGE_RULES, RAW_NAMES, REQUIRED_COLUMNS

W = ("2023-01-01", "2023-12-31")
LO, HI = dt.datetime(2023, 1, 1), dt.datetime(2023, 12, 31)


def cmp(a, b, op):
    """SQL comparison: NULL -> None; NaN is equal to itself and above all."""
    if a is None or b is None:
        return None
    if isinstance(a, float) and math.isnan(a):
        return {">=": True, "<=": isinstance(b, float) and math.isnan(b), "=": False,
                "<": False}[op] if not (isinstance(b, float) and math.isnan(b)) else op in (">=", "<=", "=")
    return {">=": a >= b, "<=": a <= b, "=": a == b, "<": a < b}[op]


def AND(*xs):
    if any(x is False for x in xs):
        return False
    return None if any(x is None for x in xs) else True


def OR(*xs):
    if any(x is True for x in xs):
        return True
    return None if any(x is None for x in xs) else False


def model_keep(r, mode):
    notnull = all(r[c] is not None and not (isinstance(r[c], float) and math.isnan(r[c]))
                  for c in REQUIRED_COLUMNS)
    ranges = []
    for c, lo, hi in RANGE_RULES:
        if lo is not None:
            ranges.append(cmp(r[c], float(lo), ">="))
        if hi is not None:
            ranges.append(cmp(r[c], float(hi), "<="))
    ranges.append(cmp(r["tpep_pickup_datetime"], LO, ">="))
    ranges.append(cmp(r["tpep_dropoff_datetime"], HI, "<="))
    rest = AND(cmp(r["tpep_pickup_datetime"], r["tpep_dropoff_datetime"], "<"), *ranges)
    bypass, clean_fee = cmp(r["airport_fee"], 1.25, "="), cmp(r["airport_fee"], 0.0, "=")
    pred = OR(bypass, AND(clean_fee, rest)) if mode == "as_written" else AND(OR(bypass, clean_fee), rest)
    return notnull and pred is True


def random_rows(n, seed):
    rnd = random.Random(seed)
    def pick(valid, *edge):
        """The first value most of the time, else an edge case."""
        return valid if rnd.random() < 0.8 else rnd.choice(edge)
    rows = []
    for i in range(n):
        p = dt.datetime(pick(2023, 2022, 2024), rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 23))
        d = p + dt.timedelta(minutes=pick(rnd.randint(1, 90), -5, 0))
        if rnd.random() < 0.1:
            d = dt.datetime(2023, 12, 31, 0, 0, pick(0, 1))
        rows.append(trip(
            tpep_pickup_datetime=pick(p, None), tpep_dropoff_datetime=d,
            passenger_count=pick(1.0, 0.0, 6.0, 7.0, None, float("nan")),
            trip_distance=pick(0.0, 2.5, 100.0, 100.01, -1.0, None),
            fare_amount=pick(12.0, 0.09, 0.1, float("nan")),
            extra=pick(1.0, 0.0, -0.01), mta_tax=pick(0.5, -0.5),
            total_amount=pick(20.0, 2.99, 3.0, float("nan"), None),
            congestion_surcharge=pick(2.5, 0.0, -2.5, None),
            airport_fee=pick(0.0, 1.25, 1.75, None, float("nan")),
            PULocationID=pick(1, None), VendorID=i))
    return rows


def test_clean_matches_three_valued_model(spark):
    rows = random_rows(600, 11)
    df = trips_df(spark, *rows)
    for mode in ("as_written", "grouped"):
        got = sorted(r["VendorID"] for r in C.clean(df, W, mode).select("VendorID").collect())
        want = sorted(r[0] for r in rows if model_keep(dict(zip(RAW_NAMES, r)), mode))
        assert got == want, mode
        assert len(want) > 10
