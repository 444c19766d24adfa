"""Date and time keys, computed natively (no Python UDF).

All functions take TIMESTAMP_NTZ (wall-clock) values, so they give the
same answer under any session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def date_id(ts: Column) -> Column:
    """Day of the year minus one (0..365); the year is ignored."""
    return (F.dayofyear(ts) - 1).cast("int")


def time_id(ts: Column) -> Column:
    """Seconds since midnight, 0..86399."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def weekday(d: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(d)


def ntz_from_epoch_seconds(secs: Column) -> Column:
    """Epoch seconds (numeric, may have a fraction) -> TIMESTAMP_NTZ in UTC
    wall clock.  Interval arithmetic on NTZ is plain microsecond addition;
    `timestamp_add` / casts through TIMESTAMP consult the session zone and
    shift wall-clock times that fall in a DST gap."""
    return _epoch_ntz() + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def epoch_seconds_of_ntz(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch seconds (decimal with microseconds), zone-free."""
    return (ts - _epoch_ntz()).cast("interval second").cast("decimal(20,6)")


def epoch_nanos_to_ntz(nanos: Column) -> Column:
    """Epoch nanoseconds (LONG) -> TIMESTAMP_NTZ in UTC wall clock, truncated
    to whole seconds toward zero (as converting through `from_unixtime` does)."""
    secs = F.call_function("div", nanos.cast("bigint"), F.lit(1_000_000_000).cast("bigint"))
    return ntz_from_epoch_seconds(secs)


def format_ntz(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' from the NTZ fields (zone-free, unlike
    date_format, which shifts DST-gap wall-clock times)."""
    def pad(c, n):
        return F.lpad(c.cast("string"), n, "0")
    return F.concat(pad(F.year(ts), 4), F.lit("-"), pad(F.month(ts), 2), F.lit("-"),
                    pad(F.dayofmonth(ts), 2), F.lit(" "), pad(F.hour(ts), 2), F.lit(":"),
                    pad(F.minute(ts), 2), F.lit(":"), pad(F.second(ts), 2))
