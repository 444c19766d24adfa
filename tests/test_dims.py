"""Golden facts of the dimensions (from the source's seed files)."""

import datetime as dt

from tripmart.operators import dims as D


def test_dim_dates_golden(spark):
    d = D.dim_dates(spark)
    rows = d.orderBy("date_id").collect()
    assert len(rows) == 365 and rows[0]["date_id"] == 0 and rows[-1]["date_id"] == 364
    assert rows[0]["date"] == dt.date(2023, 1, 1) and rows[0]["weekday"] == 6
    assert (rows[1]["weekday"], rows[0]["year"], rows[0]["month"], rows[0]["day"]) == (0, 2023, 1, 1)
    hol = [r["date_id"] for r in rows if r["is_holiday"]]
    assert hol == [0, 15, 50, 118, 169, 184, 246, 326, 358]
    assert rows[118]["date"] == dt.date(2023, 4, 29)


def test_dim_times_golden(spark):
    t = D.dim_times(spark)
    assert t.count() == 86400
    r = t.where("time_id = 86399").first()
    assert (r["hour"], r["minute"], r["second"]) == (23, 59, 59)
    r = t.where("time_id = 3661").first()
    assert (r["hour"], r["minute"], r["second"]) == (1, 1, 1)


def test_code_dims(spark):
    assert dict(D.dim_vendors(spark).collect())[1] == "Creative Mobile Technologies, LLC"
    assert D.dim_rate_codes(spark).count() == 6 and D.dim_payment_types(spark).count() == 6


def test_calendar_bound(spark):
    import pytest
    with pytest.raises(ValueError):
        D.dim_dates(spark, dt.date(2000, 1, 1), dt.date(1999, 1, 1))
