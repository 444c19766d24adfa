"""Pending-partition runs and the streaming incremental runner."""

import os
import shutil

from zone_fixture import write_month

from tripmart.plans.run import pending_months, process_months, run_pending
from tripmart.streaming.incremental import run_incremental

W = ("2023-01-01", "2023-12-31")


def test_run_pending(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_month(raw, 1)
    write_month(raw, 2, variant="B")
    assert pending_months(spark, raw, out) == [(2023, 1), (2023, 2)]
    a = {r["status"]: (r["partitions"], r["rows"]) for r in run_pending(spark, raw, out, W).collect()}
    assert a == {"success": (["year=2023/month=01", "year=2023/month=02"], 10)}
    assert pending_months(spark, raw, out) == []
    assert run_pending(spark, raw, out, W).count() == 0


def test_incremental_stream(spark, tmp_path):
    raw, out, ck = str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_month(raw, 1)
    write_month(raw, 2)
    assert run_incremental(spark, raw, out, ck, W) == [[(2023, 1), (2023, 2)]]
    assert spark.read.parquet(out).count() == 10
    assert run_incremental(spark, raw, out, ck, W) in ([], [[]])  # nothing new
    write_month(raw, 3, variant="C")
    assert run_incremental(spark, raw, out, ck, W) == [[(2023, 3)]]
    write_month(raw, 1, n=3, seed=100, name="late.parquet")  # a second file for January
    assert run_incremental(spark, raw, out, ck, W) == [[(2023, 1)]]
    back = spark.read.parquet(out)
    assert back.where("month = 1").count() == 8  # January rebuilt in full
    assert back.count() == 18
    assert back.groupBy("trip_id").count().where("count > 1").count() == 0


def test_incremental_equals_full_run(spark, tmp_path):
    raw = str(tmp_path / "raw")
    inc, full, ck = str(tmp_path / "inc"), str(tmp_path / "full"), str(tmp_path / "ck")
    write_month(raw, 1)
    run_incremental(spark, raw, inc, ck, W)
    write_month(raw, 2, variant="B")
    write_month(raw, 1, n=2, seed=50, name="late.parquet")
    run_incremental(spark, raw, inc, ck, W)
    run_pending(spark, raw, full, W)
    a, b = spark.read.parquet(inc), spark.read.parquet(full)
    assert a.count() == 12
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_months_without_survivors(spark, tmp_path):
    """Such a month is done, not pending for ever; reprocessed to no rows, its old rows go."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_month(raw, 1)
    write_month(raw, 2)
    only_january = ("2023-01-01", "2023-01-31")
    a = {r["status"]: (r["partitions"], r["rows"]) for r in run_pending(spark, raw, out, only_january, "grouped").collect()}
    assert a == {"success": (["year=2023/month=01"], 5), "empty": (["year=2023/month=02"], 0)}
    assert pending_months(spark, raw, out) == []
    assert process_months(spark, raw, out, [(2023, 1)], ("2023-02-01", "2023-02-28"), "grouped") == {(2023, 1): 0}
    assert spark.read.parquet(out).count() == 0
    assert process_months(spark, raw, out, [(2023, 2)], W) == {(2023, 2): 5}
    assert spark.read.parquet(out).count() == 5


def test_one_file_under_two_months(spark, tmp_path):
    """Ids are equal in one run over both months and in two runs."""
    raw, inc, full, ck = (str(tmp_path / d) for d in ("raw", "inc", "full", "ck"))
    write_month(raw, 1)
    run_incremental(spark, raw, inc, ck, W)
    january = os.path.join(raw, "year=2023", "month=01", "data.parquet")
    os.makedirs(os.path.join(raw, "year=2023", "month=02"))
    shutil.copy(january, os.path.join(raw, "year=2023", "month=02", "data.parquet"))
    run_incremental(spark, raw, inc, ck, W)
    run_pending(spark, raw, full, W)
    a, b = spark.read.parquet(inc), spark.read.parquet(full)
    assert a.select("trip_id").distinct().count() == a.count() == 10
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
