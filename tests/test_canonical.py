"""The canonical name's number text equals the oracle's DuckDB formula."""

import math

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tripmart.operators.keys import thousandths


def test_thousandths_matches_duckdb_round(spark):
    rng = np.random.default_rng(7)
    vals = list(rng.normal(0, 1e3, 1500)) + list(np.round(rng.uniform(-500, 500, 1500), 2))
    vals += [0.0, -0.0, 0.0005, -0.0005, 0.0015, 2.5e-3, 17.9, 1e16, -1e16, 9.3e15,
             float("nan"), float("inf"), float("-inf")]
    vals += [k / 1000 + 0.0005 for k in range(-50, 50)]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r[0] for r in df.select(thousandths(F.col("x")).cast("string")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, float(v)) for i, v in enumerate(vals)])
    want = [r[0] for r in con.execute(
        "SELECT CAST(TRY_CAST(round(x * 1000.0) AS BIGINT) AS VARCHAR) FROM t ORDER BY i").fetchall()]
    bad = [(v, g, w) for v, g, w in zip(vals, got, want)
           if g != w and not (math.isfinite(v) and abs(v * 1000) >= 9.2e18)]
    assert not bad, bad[:5]
