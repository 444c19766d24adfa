"""Raw-zone drift, text zone round trip, idempotent writes, re-encoding."""

import datetime as dt
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from zone_fixture import write_month

from tripmart.operators.conform import load_mapping
from tripmart.plans.transform import transform
from tripmart.schema import RAW_NAMES
from tripmart.sources import raw as R
from tripmart.sources import zones as Z

W = ("2023-01-01", "2023-12-31")


def _zone(tmp_path):
    root = str(tmp_path / "raw")
    write_month(root, 1, variant="A")
    write_month(root, 2, variant="B")
    write_month(root, 3, variant="C")
    return root


def test_read_raw_normalises_drift(spark, tmp_path):
    root = _zone(tmp_path)
    df = R.read_raw(spark, root)
    assert df.columns[:19] == RAW_NAMES and {"year", "month", "_src_pos"} <= set(df.columns)
    assert dict(df.dtypes)["VendorID"] == "bigint"
    assert dict(df.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert df.count() == 15
    got = sorted(tuple(r) for r in df.groupBy("month").agg(
        F.min("tpep_pickup_datetime"), F.count(F.col("airport_fee")), F.sum("passenger_count")).collect())
    assert got == [(1, dt.datetime(2023, 1, 1, 8, 0), 5, 5.0), (2, dt.datetime(2023, 2, 1, 8, 0), 5, 5.0),
                   (3, dt.datetime(2023, 3, 1, 8, 0), 5, 5.0)]
    assert df.select("_src_pos").distinct().count() == 15


def test_read_raw_selected_months(spark, tmp_path):
    root = _zone(tmp_path)
    df = R.read_raw(spark, root, months=[(2023, 2)])
    assert [tuple(r) for r in df.select("year", "month").distinct().collect()] == [(2023, 2)]


def test_text_zone_round_trip(spark, tmp_path):
    root = _zone(tmp_path)
    fact = transform(R.read_raw(spark, root), W)
    out = str(tmp_path / "text")
    Z.write_text_zone(fact, out)
    back = load_mapping(Z.read_text_zone(spark, out))
    mem = load_mapping(Z.through_text(fact))
    assert back.count() == 15
    assert back.exceptAll(mem).count() == 0 and mem.exceptAll(back).count() == 0
    assert "year=2023" in os.listdir(out)


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    root = _zone(tmp_path)
    fact = transform(R.read_raw(spark, root), W)
    out = str(tmp_path / "fact")
    Z.write_zone(fact, out)
    Z.write_zone(fact.where("month = 2"), out)  # rerun of one month
    back = spark.read.parquet(out)
    assert back.count() == 15
    assert back.groupBy("trip_id").count().where("count > 1").count() == 0


def test_recompress(spark, tmp_path):
    root = _zone(tmp_path)
    dst = str(tmp_path / "gz")
    done = Z.recompress(spark, root, dst, codec="gzip")
    assert sorted((r["year"], r["month"]) for r in done.collect()) == [(2023, 1), (2023, 2), (2023, 3)]
    files = [os.path.join(d, f) for d, _, fs in os.walk(dst) for f in fs if f.endswith(".parquet")]
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "GZIP"
                         for f in files)
    assert Z.recompress(spark, root, dst).count() == 0  # already converted: skipped
    assert R.read_raw(spark, dst, with_position=False).count() == 15


def test_listing_manifest(spark, tmp_path):
    root = _zone(tmp_path)
    m = R.list_partitions(spark, root)
    assert m.columns == ["path", "length", "year", "month"] and m.count() == 3


def test_register_zone_table(spark, tmp_path):
    root = _zone(tmp_path)
    out = str(tmp_path / "fact")
    Z.write_zone(transform(R.read_raw(spark, root), W), out)
    Z.register_zone_table(spark, "fact_zone_test", out)
    assert spark.table("fact_zone_test").count() == 15
    assert spark.sql("SHOW PARTITIONS fact_zone_test").count() == 3
    spark.sql("DROP TABLE fact_zone_test")


def test_seed_csv_quotes(spark, tmp_path):
    p = tmp_path / "dim_vendors.csv"
    p.write_text('vendor_id,vendor_name\n1,"Creative Mobile Technologies, LLC"\n2,"VeriFone Inc"')
    df = Z.read_seed_csv(spark, str(p), "vendor_id int, vendor_name string")
    assert [tuple(r) for r in df.collect()] == [(1, "Creative Mobile Technologies, LLC"), (2, "VeriFone Inc")]


def test_text_zone_positional_with_blank_lines(spark, tmp_path):
    from tripmart.schema import ZONE_SCHEMA
    d = tmp_path / "zone" / "year=2023" / "month=01"
    d.mkdir(parents=True)
    header = ",".join(f"h{i}" for i in range(len(ZONE_SCHEMA.fields)))  # names ignored
    row = "abc,1,2,3,4,5,1,1.609,4,7,1,false,1,17,1.0,0.5,2.0,0.0,1.0,2.5,0.0,21.0"
    (d / "part-0.csv").write_text(header + "\n" + row + "\n\n" + row + "\n\n")
    df = load_mapping(Z.read_text_zone(spark, str(tmp_path / "zone")))
    assert df.count() == 2
    r = df.first()
    assert (r["trip_id"], r["trip_distance"], r["fare_amount"], r["total_amount"]) == ("abc", 1.609, 17.0, 21.0)


def test_mixed_schemas_within_one_month(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_month(root, 1, variant="A")
    write_month(root, 1, n=3, variant="B", seed=50, name="late.parquet")  # int/bigint, Airport_fee
    write_month(root, 1, n=2, variant="C", seed=90, name="nanos.parquet")
    df = R.read_raw(spark, root)
    assert df.count() == 10
    assert df.where("airport_fee IS NULL OR tpep_pickup_datetime IS NULL").count() == 0
    assert sorted(r[0] for r in df.select("fare_amount").collect())[-1] == 10.0 + 1 + 90


def test_recompress_keeps_every_file(spark, tmp_path):
    """Two schemas in one month, and a file that comes after its month was converted."""
    root, dst = str(tmp_path / "raw"), str(tmp_path / "gz")
    write_month(root, 1, variant="A")
    write_month(root, 1, n=3, variant="B", seed=50, name="other.parquet")
    assert Z.recompress(spark, root, dst).count() == 2
    assert R.read_raw(spark, dst, with_position=False).count() == 8
    write_month(root, 1, n=2, seed=90, name="late.parquet")
    assert Z.recompress(spark, root, dst).count() == 1
    assert R.read_raw(spark, dst, with_position=False).count() == 10
    assert Z.recompress(spark, root, dst).count() == 0


def test_recompress_does_not_take_errors_for_an_empty_zone(spark, tmp_path):
    import pytest
    root = _zone(tmp_path)
    with pytest.raises(Exception, match="nosuchscheme"):
        Z.recompress(spark, root, "nosuchscheme://x/y")


def test_register_csv_zone(spark, tmp_path):
    root, out = _zone(tmp_path), str(tmp_path / "text")
    fact = transform(R.read_raw(spark, root), W)
    Z.write_text_zone(fact, out)
    Z.register_zone_table(spark, "csv_zone_test", out, fmt="csv")
    t = spark.table("csv_zone_test")
    assert t.count() == 15 and t.columns == [*[f.name for f in Z.ZONE_SCHEMA.fields], "year", "month"]
    assert t.where("trip_id = 'trip_id'").count() == 0 and t.where("total_amount > 0").count() == 15
    spark.sql("DROP TABLE csv_zone_test")


def test_schema_jobs_do_not_grow_with_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    for i in range(6):
        write_month(root, 1, n=1, seed=i, name=f"f{i}.parquet")
        write_month(root, 2, n=1, seed=i, name=f"f{i}.parquet")
    dirs = R.partition_dirs(spark, root)
    assert len(dirs) == 2 and R.schema_runs(spark, dirs) == [dirs]  # one run, read by folder
    write_month(root, 3, n=2, variant="B")
    runs = R.schema_runs(spark, R.partition_dirs(spark, root))
    assert sum(map(len, runs)) == 3 and len(runs) <= 3  # halving cuts at the change
    assert R.read_raw(spark, root).count() == 14
