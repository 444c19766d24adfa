"""Deterministic trip keys."""

import uuid

from helpers import trip, trips_df
from pyspark.sql import functions as F

from tripmart.operators.conform import conform, rename
from tripmart.operators.keys import KEY_COLUMNS, canonical_name, with_trip_id
from tripmart.plans.driver import driver_stages

SF = "/root/testdata/sf0.001"


def _conformed(spark, *rows_):
    return conform(rename(trips_df(spark, *rows_)))


def test_exact_duplicates_get_distinct_stable_ids(spark):
    df = _conformed(spark, trip(), trip(), trip(fare_amount=13.0))
    ids1 = sorted(r[0] for r in with_trip_id(df, position=None).select("trip_id").collect())
    ids2 = sorted(r[0] for r in with_trip_id(df.repartition(3), position=None)
                  .select("trip_id").collect())
    assert len(set(ids1)) == 3 and ids1 == ids2


def test_hot_group_split_by_salt_same_ids(spark):
    # 300 copies of one trip spread over salt buckets: same ids as one window.
    many = _conformed(spark, *[trip()] * 300).withColumn("_src_pos", F.monotonically_increasing_id())
    name = many.select(canonical_name(many)).first()[0]
    want = sorted(str(uuid.uuid5(uuid.NAMESPACE_DNS, f"{name}-{i}")) for i in range(1, 301))
    for df, position in ((many, "_src_pos"), (many.drop("_src_pos"), None)):
        got = with_trip_id(df, position=position, salt_buckets=16).select("trip_id")
        assert sorted(r[0] for r in got.collect()) == want


def test_trip_keys_unchanged_under_repartition(spark):
    st = driver_stages(spark, SF)
    timed = st["timed"]
    a = with_trip_id(timed, KEY_COLUMNS).select("trip_id")
    b = with_trip_id(timed.repartition(7), KEY_COLUMNS).select("trip_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.distinct().count() == a.count()


def test_rerun_gives_same_fact(spark):
    f1 = driver_stages(spark, SF)["fact"]
    from tripmart.plans.memo import clear
    clear(spark)
    f2 = driver_stages(spark, SF)["fact"]
    assert f1.exceptAll(f2).count() == 0 and f2.exceptAll(f1).count() == 0


def test_key_step_has_no_python(spark):
    plan = driver_stages(spark, SF)["keyed"]._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_ids_independent_of_shuffle_partitions(spark):
    timed = driver_stages(spark, SF)["timed"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = [r[0] for r in with_trip_id(timed).select("trip_id").collect()]
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = [r[0] for r in with_trip_id(timed).select("trip_id").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(a) == sorted(b) and len(set(a)) == len(a)


def test_ids_do_not_depend_on_the_other_months_of_a_run(spark):
    a = _conformed(spark, trip(), trip(), trip(fare_amount=3.0)).withColumns({"year": F.lit(2023), "month": F.lit(1)})
    b = a.withColumn("month", F.lit(2))  # the same file under another month
    together = sorted(r[0] for r in with_trip_id(a.unionByName(b)).select("trip_id").collect())
    apart = sorted(r[0] for x in (a, b) for r in with_trip_id(x).select("trip_id").collect())
    assert together == apart and len(set(together)) == 6


def test_values_beyond_the_range_are_written_out(spark):
    df = _conformed(spark, trip(fare_amount=1e18), trip(fare_amount=2e18))
    names = [r[0] for r in df.select(canonical_name(df)).collect()]
    assert len(set(names)) == 2 and not any("None" in n.split("-")[-9] for n in names)


def test_input_is_read_once(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        fresh = driver_stages(spark, SF)["keyed"].select("*")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert plan.count("FileScan parquet") == 4 and "ReusedExchange" in plan  # lineitem, orders, customer, supplier
