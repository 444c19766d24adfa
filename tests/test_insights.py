"""Golden facts published with the fixture (FIXTURES.md §3) at sf0.01."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tripmart.operators.insights import borough_pairs_topk
from tripmart.plans.driver import driver_dims, driver_raw

SF = "/root/testdata/sf0.01"


def test_heatmap_golden(spark):
    hm = E.queries()["demand_heatmap"](spark, SF)
    rows = hm.collect()
    assert len(rows) == 170 and sum(r["trips"] for r in rows) == 8787
    assert any(r["weekday"] is None for r in rows)  # date_id 365 of a leap year


def test_top_borough_pair_uncleaned(spark):
    loc = driver_dims(spark, SF)["dim_locations"]
    raw = driver_raw(spark, SF)
    pu = loc.select(F.col("location_id").alias("PULocationID"), F.col("borough").alias("pickup_borough"))
    do = loc.select(F.col("location_id").alias("DOLocationID"), F.col("borough").alias("dropoff_borough"))
    labelled = (raw.withColumn("PULocationID", F.col("PULocationID").cast("int"))
                .withColumn("DOLocationID", F.col("DOLocationID").cast("int"))
                .join(pu, "PULocationID", "left").join(do, "DOLocationID", "left"))
    top = borough_pairs_topk(labelled, k=1).first()
    assert (top["pickup_borough"], top["dropoff_borough"], top["trips"]) == ("ASIA", "MIDDLE EAST", 3296)
