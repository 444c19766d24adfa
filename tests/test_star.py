"""Star schema definition and idempotent load (catalog tables)."""

import pytest
from zone_fixture import write_month

from tripmart.operators import dims as D
from tripmart.plans.run import load_pending, process_months, run_pending
from tripmart.plans.star import create_star_schema, load_months, load_star
from tripmart.plans.transform import transform
from tripmart.sources.raw import read_raw
from tripmart.streaming.incremental import run_load_incremental

W = ("2023-01-01", "2023-12-31")


def test_create_and_load_star(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_month(raw, 1)
    write_month(raw, 2, variant="B")
    fact = transform(read_raw(spark, raw), W)
    dims = _dims(spark)
    create_star_schema(spark, str(tmp_path / "wh"), database="star_test")
    load_star(spark, fact, dims, database="star_test")
    load_star(spark, fact.where("month = 2"), dims, database="star_test")  # rerun one month
    f = spark.table("star_test.fact_trips")
    assert f.count() == 10 and f.select("trip_id").distinct().count() == 10
    assert spark.table("star_test.dim_dates").count() == 365
    assert spark.table("star_test.dim_times").count() == 86400
    spark.sql("DROP DATABASE star_test CASCADE")


def _dims(spark):
    return {"dim_dates": D.dim_dates(spark), "dim_times": D.dim_times(spark),
            "dim_vendors": D.dim_vendors(spark), "dim_rate_codes": D.dim_rate_codes(spark),
            "dim_payment_types": D.dim_payment_types(spark),
            "dim_locations": spark.createDataFrame([(4, "Manhattan", "Alphabet City")],
                                                   "location_id int, borough string, zone string")}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_load_stage(spark, tmp_path, fmt):
    """From the transformed zone, either format, to fact_trips: exact doubles, one copy, late months."""
    raw, zone, db = str(tmp_path / "raw"), str(tmp_path / "zone"), f"load_test_{fmt}"
    write_month(raw, 1)
    run_pending(spark, raw, zone, W, fmt=fmt)
    create_star_schema(spark, str(tmp_path / "wh"), database=db)
    assert load_pending(spark, zone, fmt, db) == [(2023, 1)]
    assert load_pending(spark, zone, fmt, db) == []
    write_month(raw, 2, variant="B")
    run_pending(spark, raw, zone, W, fmt=fmt)
    assert load_pending(spark, zone, fmt, db) == [(2023, 2)]
    f = spark.table(f"{db}.fact_trips")
    assert [r[0] for r in f.select("trip_distance").distinct().collect()] == [4.023]  # 2.5 miles
    assert f.count() == 10 and f.select("trip_id").distinct().count() == 10
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_load_stage_keeps_its_own_progress(spark, tmp_path):
    raw, zone, ck, db = str(tmp_path / "raw"), str(tmp_path / "zone"), str(tmp_path / "ck"), "load_test_inc"
    write_month(raw, 1)
    run_pending(spark, raw, zone, W)
    create_star_schema(spark, str(tmp_path / "wh"), database=db)
    assert run_load_incremental(spark, zone, ck, database=db) == [[(2023, 1)]]
    assert run_load_incremental(spark, zone, ck, database=db) in ([], [[]])
    write_month(raw, 1, n=2, seed=40, name="late.parquet")
    process_months(spark, raw, zone, [(2023, 1)], W)
    assert run_load_incremental(spark, zone, ck, database=db) == [[(2023, 1)]]
    assert spark.table(f"{db}.fact_trips").count() == 7
    process_months(spark, raw, zone, [(2023, 1)], ("2022-01-01", "2022-12-31"), "grouped")  # nothing is left
    load_months(spark, zone, [(2023, 1)], database=db)
    assert spark.table(f"{db}.fact_trips").count() == 0
    spark.sql(f"DROP DATABASE {db} CASCADE")
