"""Insights from monthly states, null columns from footers, two-phase keys, one-sort numbering."""

import re

from pyspark.sql import functions as F
from zone_fixture import write_month

import __spark_entry__ as E
from tripmart.operators import conform, dims, insights, keys, quality
from tripmart.operators.marts import trips_labelled
from tripmart.plans import insight_states as S
from tripmart.plans import run, star

SF = "/root/testdata/sf0.001"
W = ("2023-01-01", "2023-12-31")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_states_equal_the_full_queries_and_read_touched_months_only(spark, tmp_path):
    raw, zone, states, db = str(tmp_path / "raw"), str(tmp_path / "zone"), str(tmp_path / "states"), "states_test"
    for m in (1, 2):
        write_month(raw, m, n=5 + m, seed=m)
    run.run_pending(spark, raw, zone, W)
    star.create_star_schema(spark, str(tmp_path / "wh"), database=db)
    d = {"dim_dates": dims.dim_dates(spark), "dim_times": dims.dim_times(spark), "dim_vendors": dims.dim_vendors(spark), "dim_rate_codes": dims.dim_rate_codes(spark),
         "dim_payment_types": dims.dim_payment_types(spark), "dim_locations": spark.createDataFrame([(4, "Manhattan", "Alphabet City")], "location_id int, borough string, zone string")}

    def refresh():
        return S.refresh_states(spark, states, d["dim_dates"], d["dim_times"], db)

    def same():
        fact, s = spark.table(f"{db}.fact_trips"), S.read_states(spark, states)
        labelled = trips_labelled(fact, d)
        heat = insights.demand_heatmap(fact, d["dim_dates"], d["dim_times"])
        assert rows(S.heatmap(s)) == rows(heat)
        assert rows(S.peak(s)) == rows(insights.demand_peak(heat))
        assert rows(S.borough_pairs_topk(s, d["dim_locations"])) == rows(insights.borough_pairs_topk(labelled))
        assert rows(S.payment_share(s, d["dim_payment_types"])) == rows(insights.payment_share(labelled))
        assert rows(S.avg_total_by_passengers(s)) == rows(insights.avg_total_by_passengers(fact))
        assert rows(S.passenger_premium(s)) == rows(insights.passenger_premium(fact))

    assert refresh() == [] and S.read_states(spark, states).count() == 0
    run.load_pending(spark, zone, database=db)
    assert refresh() == [(2023, 1), (2023, 2)] and refresh() == []
    same()
    write_month(raw, 3, n=4, seed=9)
    run.run_pending(spark, raw, zone, W)
    run.load_pending(spark, zone, database=db)
    assert refresh() == [(2023, 3)]
    run.process_months(spark, raw, zone, [(2023, 1)], ("2022-01-01", "2022-12-31"), "grouped")  # January is emptied
    run.load_pending(spark, zone, database=db)
    assert refresh() == [(2023, 1)]
    assert S.heatmap(S.read_states(spark, states)).agg(F.sum("trips")).first()[0] == 11
    same()
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_null_columns_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = [(None, None, 1, "x", None, (None, 2), 1.5) if i % 3 else (None, "", 0, None, None, (None, 3), None) for i in range(50)]
    df = spark.createDataFrame(rows_, "a string, b string, c int, d string, e bigint, s struct<x: string, y: int>, f double")
    df.repartition(3).write.parquet(path)
    for sets in (((None,), (None,)), ((None, ""), (None,)), (("",), (0,))):
        want = rows(conform.null_column_report(spark.read.parquet(path), *sets))
        assert rows(conform.null_columns_of_files(spark, path, *sets)) == want
    plan = conform.footer_counts(spark, [path], ["a", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(a), COUNT(c)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_keys_that_share_a_hash_are_counted_exactly(spark, monkeypatch):
    ids = [f"id{i}" for i in range(400)] + ["id7"] * 300 + ["id8", None, None]
    df = spark.createDataFrame([(i,) for i in ids], "k string").repartition(5)
    want = [("t", "k", 703, 2, 2)]
    assert rows(quality.pk_report({"t": df}, [("t", "k")])) == want
    monkeypatch.setattr(quality, "HASH_BITS", 6)  # nearly every key shares its hash
    assert rows(quality.pk_report({"t": df}, [("t", "k")])) == want
    monkeypatch.setattr(quality, "MAX_BROADCAST", 0)
    assert rows(quality.pk_report({"t": df}, [("t", "k")])) == want
    assert rows(quality.pk_violations(df, "k")) == sorted([("id7", 301), ("id8", 2), (None, 2)], key=repr)
    unique = df.where("k is not null").distinct()
    monkeypatch.setattr(quality, "HASH_BITS", 44)
    assert rows(quality.pk_report({"t": unique}, [("t", "k")])) == [("t", "k", 400, 0, 0)]
    assert quality.pk_violations(unique, "k").collect() == []


def test_unique_keys_shuffle_their_short_hashes_only(spark):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("k"))
    p = quality._per_hash(df, "k")._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in p.splitlines() if "Exchange hashpartitioning" in line)
    assert "hashpartitioning(h" in exchange and "k#" not in exchange


def test_numbering_sorts_and_windows_the_rows_once(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        df = E.queries()["trip_keys"](spark, SF)
        text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sorts = [m.group(1).count("#") for m in re.finditer(r"\(\d+\) Sort[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", text)]
    windows = [m.group(1).count("#") for m in re.finditer(r"\(\d+\) Window[^\n]*\nInput \[\d+\]: \[([^\]]*)\]", text)]
    assert sum(n > 15 for n in windows) == 1
    wide = re.findall(r"\(\d+\) Sort[^\n]*\nInput \[\d+\]: \[[^\]]*_k_h1[^\]]*vendor_id[^\]]*\]|\(\d+\) Sort[^\n]*\nInput \[\d+\]: \[[^\]]*vendor_id[^\]]*_k_h1[^\]]*\]", text)
    assert len(wide) == 1, sorts


def test_ids_without_positions_do_not_depend_on_partitions(spark):
    data = [(1, "a", i % 3) for i in range(12)]
    df = spark.createDataFrame(data, "n int, s string, extra int")

    def ids(parts):
        return rows(keys.with_trip_id(df.repartition(parts), ["n", "s"]).select("trip_id", "extra"))

    assert ids(1) == ids(5) == ids(7) and len({i for i, _ in ids(1)}) == 12
