"""String functions of source discovery: periods, zone keys, folders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PERIOD_PATTERN, ZONE_KEY_FORMAT


def url_period(url: Column, pattern: str = PERIOD_PATTERN) -> Column:
    """First match of the period pattern (`yyyy-mm`), or NULL if none.
    Java's word class is ASCII-only (Python's `re` is Unicode): a period written
    with non-ASCII letters or digits does not match."""
    m = F.regexp_extract(url, pattern, 0)
    return F.when(m != "", m)


def partition_key(period: Column, fmt: str = ZONE_KEY_FORMAT) -> Column:
    """`yyyy-mm` -> `year=yyyy/month=mm/data.parquet`."""
    parts = F.split(period, "-")
    return F.format_string(fmt, parts.getItem(0), parts.getItem(1))


def key_year(key: Column) -> Column:
    """Year of a zone key by fixed offset (`year=YYYY/...`)."""
    return F.substring(key, 6, 4)


def key_month(key: Column) -> Column:
    """Month of a zone key by fixed offset (`year=YYYY/month=MM/...`)."""
    return F.substring(key, 17, 2)


def key_period(key: Column) -> Column:
    return F.concat(key_year(key), F.lit("-"), key_month(key))


def key_folder(key: Column) -> Column:
    """All but the last path segment ('' for a root-level key)."""
    return F.regexp_replace(key, r"/?[^/]*$", "")


def key_partition_value(key: Column, name: str) -> Column:
    """Value of a `name=value` path segment anywhere in a key, or NULL."""
    v = F.regexp_extract(key, rf"(?:^|/){name}=([^/]*)(?:/|$)", 1)
    return F.when(v != "", v)
