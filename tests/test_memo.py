"""The plan memo follows the files that its plans read."""

from pyspark.sql import functions as F

from tripmart.plans.memo import files_of, memo, table


def test_rewritten_table_is_read_anew(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(5).write.parquet(path)
    first = table(spark, path)
    assert table(spark, path) is first and first.count() == 5
    assert table(spark, path) is first  # reading changes nothing
    spark.range(7).withColumn("x", F.lit(1)).write.mode("overwrite").parquet(path)
    assert table(spark, path).count() == 7 and table(spark, path).columns == ["id", "x"]


def test_tables_in_a_folder(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(2).write.parquet(str(tmp_path / name))
    built = []
    build = lambda: built.append(1) or len(built)
    assert [memo(spark, "folder test", build, str(tmp_path)) for _ in range(3)] == [1, 1, 1]
    spark.range(2).write.mode("append").parquet(str(tmp_path / "b"))
    assert memo(spark, "folder test", build, str(tmp_path)) == 2


def test_missing_folder(spark, tmp_path):
    assert files_of(spark, str(tmp_path / "none")) is None
    assert memo(spark, "missing test", lambda: "built", str(tmp_path / "none")) == "built"
