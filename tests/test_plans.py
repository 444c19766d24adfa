"""Plan shape: no Python in any query, broadcast dims, pushed filters,
partial aggregation, one row shuffle for the keys."""

import pytest
from zone_fixture import write_month

import __spark_entry__ as E
from tripmart.operators import clean as C
from tripmart.plans.queries import QUERIES
from tripmart.sources.raw import read_raw

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    """`explain("formatted")` text (scan details are not truncated there)."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plans(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_view_joins_are_broadcast(spark):
    p = plan(E.queries()["trips_datetime"](spark, SF))
    assert p.count("BroadcastHashJoin") >= 4
    # the only shuffles are the trip-key step's (rows once, plus narrow counts)
    assert "SortMergeJoin [pickup_date_id" not in p


def test_heatmap_partial_aggregation(spark):
    p = plan(E.queries()["demand_heatmap"](spark, SF))
    assert "partial_count" in p


def test_keys_shuffle_rows_once(spark):
    import re
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # reuse shows at planning time
        p = formatted(E.queries()["trip_keys"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    widths = sorted(len(m.group(1).split(", ")) for m in
                    re.finditer(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", p))
    # the rows cross one exchange (by name hash and salt), which the sizes
    # reuse; sizes and offsets carry 4 narrow columns
    assert len(widths) == 3 and widths[-1] > 10 and widths[:2] == [4, 4], widths
    assert "_k_name" not in p  # the name string is never shuffled


@pytest.mark.parametrize("name", ["demand_heatmap", "demand_peak", "borough_pairs_topk", "payment_share",
                                  "avg_total_by_passengers", "passenger_premium", "trips_by_date",
                                  "pickups_by_time", "trips_by_code", "trips_by_location", "fk_orphans"])
def test_queries_without_ids_skip_the_key_step(spark, name):
    p = formatted(E.queries()[name](spark, SF))
    assert "_k_h1" not in p
    if name == "passenger_premium":
        assert p.count("lineitem.parquet") == 1


def test_fee_domain_is_pushed_as_written(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_month(root, 1)
    p = formatted(C.clean(read_raw(spark, root), ("2023-01-01", "2023-12-31"), "as_written"))
    assert "In(airport_fee, [0.0,1.25])" in p[p.index("PushedFilters:"):].split("\n")[0]


def test_clean_filters_pushed_to_scan(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_month(root, 1)
    raw = read_raw(spark, root)
    p = formatted(C.clean(raw, ("2023-01-01", "2023-12-31"), "grouped"))
    pushed = p[p.index("PushedFilters:"):].split("\n")[0]
    for f in ("IsNotNull(total_amount)", "GreaterThanOrEqual(passenger_count,0.0)",
              "Or(EqualTo(airport_fee,1.25),EqualTo(airport_fee,0.0))",
              "LessThanOrEqual(tpep_dropoff_datetime,2023-12-31T00:00)"):
        assert f in pushed, f


def test_month_selection_reads_only_its_folder(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_month(root, 1)
    write_month(root, 2)
    p = formatted(read_raw(spark, root, months=[(2023, 2)]))
    assert "month=02" in p and "month=01" not in p
