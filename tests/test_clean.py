"""Cleaning semantics (one test per line of the semantics box)."""

import datetime as dt

from helpers import trip, trips_df

from tripmart.operators import clean as C

W = ("2023-01-01", "2023-12-31")


def kept(spark, mode, *rows_):
    df = trips_df(spark, *rows_)
    return C.clean(df, W, mode).count()


def test_precedence_bypass(spark):
    bad = trip(airport_fee=1.25, tpep_pickup_datetime=dt.datetime(2019, 5, 1, 12),
               tpep_dropoff_datetime=dt.datetime(2019, 5, 1, 11), total_amount=-5.0)
    assert kept(spark, "as_written", bad) == 1
    assert kept(spark, "grouped", bad) == 0


def test_null_and_other_fee_dropped(spark):
    for fee in (None, 1.75):
        assert kept(spark, "as_written", trip(airport_fee=fee)) == 0
        assert kept(spark, "grouped", trip(airport_fee=fee)) == 0


def test_null_passenger_count(spark):
    assert kept(spark, "as_written", trip(passenger_count=None, airport_fee=0.0)) == 0
    assert kept(spark, "as_written", trip(passenger_count=None, airport_fee=1.25)) == 1


def test_window_end_is_midnight(spark):
    p = dt.datetime(2023, 12, 30, 23, 0)
    assert kept(spark, "as_written", trip(tpep_pickup_datetime=p,
                tpep_dropoff_datetime=dt.datetime(2023, 12, 31, 0, 0, 0))) == 1
    assert kept(spark, "as_written", trip(tpep_pickup_datetime=p,
                tpep_dropoff_datetime=dt.datetime(2023, 12, 31, 0, 0, 1))) == 0


def test_window_start(spark):
    assert kept(spark, "as_written", trip(tpep_pickup_datetime=dt.datetime(2022, 12, 31, 23),
                tpep_dropoff_datetime=dt.datetime(2023, 1, 1, 1))) == 0


def test_equal_pickup_dropoff_dropped(spark):
    t = dt.datetime(2023, 3, 1, 10)
    assert kept(spark, "as_written", trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t)) == 0


def test_inclusive_bounds(spark):
    cases = [("passenger_count", 0.0, 1), ("passenger_count", 6.0, 1), ("passenger_count", 7.0, 0),
             ("trip_distance", 0.0, 1), ("trip_distance", 100.0, 1), ("trip_distance", 100.01, 0),
             ("fare_amount", 0.09, 0), ("fare_amount", 0.1, 1),
             ("total_amount", 2.99, 0), ("total_amount", 3.0, 1)]
    for col, v, want in cases:
        assert kept(spark, "as_written", trip(**{col: v})) == want, (col, v)


def test_negative_small_amounts_dropped(spark):
    for col in ("extra", "tip_amount", "tolls_amount", "improvement_surcharge",
                "mta_tax", "congestion_surcharge"):
        assert kept(spark, "as_written", trip(**{col: -0.01})) == 0, col


def test_nan_total_dropped_as_null(spark):
    assert C.required_not_null(trips_df(spark, trip(total_amount=float("nan")))).count() == 0
    assert kept(spark, "as_written", trip(total_amount=float("nan"), airport_fee=1.25)) == 0


def test_required_columns(spark):
    for col in ("PULocationID", "DOLocationID", "trip_distance", "total_amount"):
        assert C.required_not_null(trips_df(spark, trip(**{col: None}))).count() == 0


def test_as_written_superset_of_grouped(spark):
    from tripmart.plans.driver import driver_raw
    from tripmart.schema import DRIVER_WINDOW, RAW_NAMES
    raw = driver_raw(spark, "/root/testdata/sf0.001").select(*RAW_NAMES)
    g = C.clean(raw, DRIVER_WINDOW, "grouped")
    a = C.clean(raw, DRIVER_WINDOW, "as_written")
    assert g.exceptAll(a).count() == 0
    assert a.count() >= g.count() > 0


def test_rule_violations_counts(spark):
    df = trips_df(spark, trip(), trip(airport_fee=None), trip(passenger_count=9.0))
    r = {row["rule"]: (row["failing"], row["passing"]) for row in C.rule_violations(df, W).collect()}
    assert r["fee_domain"] == (1, 2)
    assert r["range_passenger_count"] == (1, 2)
    assert r["kept_as_written"] == (2, 1)


def test_rule_counts_golden_sf001(spark):
    """Counts published with the fixture (FIXTURES.md §3), checked there in
    two other engines."""
    import __spark_entry__ as E
    got = {r["rule"]: r["failing"] for r in
           E.queries()["rule_violations"](spark, "/root/testdata/sf0.01").collect()}
    want = {"required_not_null": 285, "fee_domain": 11889, "pickup_before_dropoff": 1357,
            "range_passenger_count": 12932, "range_fare_amount": 722, "range_mta_tax": 646,
            "range_total_amount": 1291, "range_congestion_surcharge": 12103,
            "range_trip_distance": 9994, "range_tpep_pickup_datetime": 36230,
            "range_tpep_dropoff_datetime": 14580, "range_extra": 0, "range_tip_amount": 0,
            "range_tolls_amount": 0, "range_improvement_surcharge": 0}
    assert {k: got[k] for k in want} == want
    assert 60000 - got["kept_as_written"] == 8787 and 60000 - got["kept_grouped"] == 3462
