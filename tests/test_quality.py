"""Primary/foreign key checks."""

from tripmart.operators import dims as D
from tripmart.operators import quality as Q


def test_fk_orphan_and_null_fk(spark):
    fact = spark.createDataFrame([(365, None), (0, 1), (3, 9)],
                                 "pickup_date_id int, vendor_id int")
    dims = {"dim_dates": D.dim_dates(spark), "dim_vendors": D.dim_vendors(spark)}
    fks = [("pickup_date_id", "dim_dates", "date_id"), ("vendor_id", "dim_vendors", "vendor_id")]
    r = {x["fk_column"]: (x["orphans"], x["checked"]) for x in Q.fk_orphans(fact, dims, fks).collect()}
    assert r == {"pickup_date_id": (1, 3), "vendor_id": (1, 2)}


def test_pk_report(spark):
    t = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "trip_id string")
    r = Q.pk_report({"fact_trips": t}, [("fact_trips", "trip_id")]).first()
    assert (r["rows"], r["null_keys"], r["duplicate_keys"]) == (4, 1, 1)
    assert sorted(x[0] or "" for x in Q.pk_violations(t, "trip_id").select("trip_id").collect()) == ["", "a"]


def test_dimensions_are_broadcast_by_their_size_only(spark):
    dd = D.dim_dates(spark)
    joined = spark.createDataFrame([(1,)], "date_id int").join(dd, "date_id")
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
