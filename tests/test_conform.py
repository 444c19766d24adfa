"""Renames, mappings, null columns."""

from helpers import trip, trips_df
from pyspark.sql import functions as F

from tripmart.operators.conform import (apply_mapping, conform, drop_by_pattern,
                                        drop_null_columns, fact_mapping, null_column_report,
                                        rename)


def test_rename_case_insensitive_and_missing(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], "vendorid bigint, AIRPORT_FEE double, other int")
    assert rename(df).columns == ["vendor_id", "airport_fee_amount", "other"]


def test_conform_codes_flag_km(spark):
    df = rename(trips_df(spark, trip(VendorID=3, RatecodeID=99.0, payment_type=0,
                                     store_and_fwd_flag=None, trip_distance=25.0)))
    r = conform(df).first()
    assert (r["vendor_id"], r["rate_code_id"], r["payment_type_id"], r["store_and_forward"],
            r["trip_distance"]) == (None, None, None, False, 40.234)


def test_drop_by_pattern(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a_datetime int, b int, pickup_datetime int")
    assert drop_by_pattern(df).columns == ["b"]


def test_fare_truncates(spark):
    df = spark.createDataFrame([(17.9,), (0.99,), (-1.5,), (1e12,)], "fare_amount double")
    got = [r[0] for r in apply_mapping(df, [("fare_amount", "double", "fare_amount", "int")]).collect()]
    assert got == [17, 0, -1, None]  # out of range -> NULL, not a job failure


def test_fact_mapping_shape(spark):
    from tripmart.schema import FACT_COLUMNS
    from tripmart.plans.driver import driver_stages
    fact = driver_stages(spark, "/root/testdata/sf0.001")["fact"]
    assert fact.columns == FACT_COLUMNS
    assert dict(fact.dtypes)["fare_amount"] == "int"
    assert dict(fact.dtypes)["total_amount"] == "float"


def test_null_column_report_flat(spark):
    df = spark.createDataFrame(
        [(None, " ", None, 1.5, None, 0), (None, "", None, 2.5, None, 0)],
        "a string, b string, c float, d double, e int, z bigint")
    r = dict(null_column_report(df, null_strings=[None, ""], null_numbers=[None, 0]).collect())
    assert r == {"a": True, "b": True, "c": False, "d": False, "e": True, "z": True}
    # as configured in the source (empty sets): nothing is droppable
    r2 = dict(null_column_report(df, null_strings=[], null_numbers=[]).collect())
    assert not any(r2.values())


def test_drop_null_columns_nested(spark):
    df = spark.createDataFrame(
        [(1, (None, "x"), [(None, 5)]), (2, (None, "y"), [(None, 6), (None, 7)])],
        "id int, s struct<a:string,b:string>, arr array<struct<p:string,q:int>>")
    out = drop_null_columns(df, null_strings=[None], null_numbers=[None])
    assert out.schema.simpleString() == "struct<id:int,s:struct<b:string>,arr:array<struct<q:int>>>"
    assert out.count() == 2


def test_drop_null_columns_nulltype_and_empty(spark):
    df = spark.createDataFrame([(1,)], "id int").withColumn("n", F.lit(None))
    assert drop_null_columns(df).columns == ["id"]
    empty = spark.createDataFrame([], "a string, b double, c boolean")
    assert drop_null_columns(empty).columns == ["c"]


def test_null_columns_white_space_and_null_arrays(spark):
    from tripmart.operators.conform import null_column_report
    df = spark.createDataFrame([("\t\n ", None), (" \u00a0", [(None,)])], "s string, a array<struct<x:string>>")
    report = {r["column"]: r["dropped"] for r in null_column_report(df, null_strings=[""]).collect()}
    assert report == {"s": True, "a.x": False}  # a NULL array is a NULL value
    assert {r["column"]: r["dropped"] for r in null_column_report(df, null_strings=["", None]).collect()}["a.x"]


def test_float_becomes_double_by_its_digits(spark):
    from tripmart.operators.conform import load_mapping
    from tripmart.schema import ZONE_SCHEMA
    row = {f.name: None for f in ZONE_SCHEMA.fields} | {"trip_distance": 4.023}
    df = spark.createDataFrame([tuple(row.values())], ZONE_SCHEMA).withColumn("trip_distance", F.col("trip_distance").cast("float"))
    assert load_mapping(df).first()["trip_distance"] == 4.023
