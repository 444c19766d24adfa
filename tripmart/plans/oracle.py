"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code as plain SQL over the driver's
views, so that a wrong Spark plan cannot hide behind shared code.  Only the
fixed values (rule table, renames, domains, mapping) are shared.
"""

from __future__ import annotations

from ..functions.uuid5 import uuid5_sql
from ..operators.keys import KEY_COLUMNS
from ..schema import (DRIVER_CALENDAR, DRIVER_WINDOW, FACT_MAPPING,
                      HOLIDAY_DATE_IDS, LOAD_MAPPING, PAYMENT_CODES,
                      PAYMENT_TYPE_NAMES, RANGE_RULES, RATE_CODE_NAMES,
                      RATE_CODES, RENAMES, REQUIRED_COLUMNS, VENDOR_CODES,
                      VENDORS)
from ..sources.adapter import RAW_TRIPS_SQL

_DUCK_TYPES = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "float": "FLOAT",
               "double": "DOUBLE", "boolean": "BOOLEAN"}
_DOUBLE_RAW = {"passenger_count", "trip_distance", "RatecodeID", "fare_amount", "extra",
               "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
               "total_amount", "congestion_surcharge", "airport_fee"}


def lit(v) -> str:
    if isinstance(v, str):
        return f"TIMESTAMP '{v} 00:00:00'" if len(v) == 10 else f"TIMESTAMP '{v}'"
    return f"{float(v)!r}::DOUBLE"


def not_null_sql() -> str:
    parts = []
    for c in REQUIRED_COLUMNS:
        parts.append(f"{c} IS NOT NULL")
        if c in _DOUBLE_RAW:
            parts.append(f"NOT isnan({c})")
    return " AND ".join(parts)


def ranges_sql(window=DRIVER_WINDOW) -> str:
    rules = list(RANGE_RULES) + [("tpep_pickup_datetime", window[0], None),
                                 ("tpep_dropoff_datetime", None, window[1])]
    parts = []
    for c, lo, hi in rules:
        if lo is not None:
            parts.append(f"{c} >= {lit(lo)}")
        if hi is not None:
            parts.append(f"{c} <= {lit(hi)}")
    return " AND ".join(parts)


def clean_sql(mode: str = "as_written", window=DRIVER_WINDOW) -> str:
    rest = f"tpep_pickup_datetime < tpep_dropoff_datetime AND {ranges_sql(window)}"
    if mode == "as_written":
        pred = f"(airport_fee = 1.25::DOUBLE OR (airport_fee = 0.0::DOUBLE AND {rest}))"
    else:
        pred = f"((airport_fee = 1.25::DOUBLE OR airport_fee = 0.0::DOUBLE) AND {rest})"
    return f"({not_null_sql()}) AND {pred}"


def renamed_select() -> str:
    lookup = {o.lower(): n for o, n in RENAMES}
    from ..schema import RAW_NAMES
    return ", ".join(f"{c} AS {lookup.get(c.lower(), c)}" for c in RAW_NAMES)


def conformed_select() -> str:
    from ..schema import RAW_NAMES
    lookup = {o.lower(): n for o, n in RENAMES}
    names = [lookup.get(c.lower(), c) for c in RAW_NAMES]
    exprs = {
        "vendor_id": f"CASE WHEN vendor_id IN ({', '.join(map(str, VENDOR_CODES))}) THEN vendor_id END",
        "rate_code_id": f"CASE WHEN rate_code_id IN ({', '.join(map(str, RATE_CODES))}) THEN rate_code_id END",
        "payment_type_id": f"CASE WHEN payment_type_id IN ({', '.join(map(str, PAYMENT_CODES))}) THEN payment_type_id END",
        "store_and_forward": "coalesce(store_and_forward = 'Y', false)",
        "trip_distance": "round(trip_distance * 1.60934::DOUBLE, 3)",
    }
    return ", ".join(f"{exprs.get(n, n)} AS {n}" for n in names)


_TS = {"pickup_datetime", "dropoff_datetime"}
_DBL = {"passenger_count", "trip_distance", "rate_code_id", "fare_amount", "extra_amount",
        "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
        "congestion_surcharge", "airport_fee_amount"}


def name_sql() -> str:
    parts = []
    for c in KEY_COLUMNS:
        if c in _DBL:
            t = f"CAST(TRY_CAST(round({c} * 1000.0) AS BIGINT) AS VARCHAR)"
        elif c in _TS:
            t = f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
        else:
            t = f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce({t}, 'None')")
    return " || '-' || ".join(parts)


def mapping_select(mapping) -> str:
    out = []
    for src, src_t, dst, dst_t in mapping:
        if dst_t in ("int", "long") and src_t in ("double", "float"):
            e = f"TRY_CAST(trunc({src}) AS {_DUCK_TYPES[dst_t]})"
        else:
            e = f"TRY_CAST({src} AS {_DUCK_TYPES[dst_t]})"
        out.append(f"{e} AS {dst}")
    return ", ".join(out)


def fact_ctes(mode: str = "as_written", window=DRIVER_WINDOW, copies: int = 1) -> str:
    """raw (each trip so many times), cleaned, renamed, conformed, timed, keyed, dropped, fact."""
    return f"""
raw AS ({" UNION ALL ".join([RAW_TRIPS_SQL] * copies)}),
cleaned AS (SELECT * FROM raw WHERE {clean_sql(mode, window)}),
renamed AS (SELECT {renamed_select()} FROM cleaned),
conformed AS (SELECT {conformed_select()} FROM renamed),
timed AS (SELECT *,
   (dayofyear(pickup_datetime) - 1)::INTEGER AS pickup_date_id,
   (dayofyear(dropoff_datetime) - 1)::INTEGER AS dropoff_date_id,
   (hour(pickup_datetime)*3600 + minute(pickup_datetime)*60 + second(pickup_datetime))::INTEGER AS pickup_time_id,
   (hour(dropoff_datetime)*3600 + minute(dropoff_datetime)*60 + second(dropoff_datetime))::INTEGER AS dropoff_time_id
  FROM conformed),
named AS (SELECT *, {name_sql()} AS k_name FROM timed),
keyed AS (SELECT {uuid5_sql("k_name || '-' || CAST(row_number() OVER (PARTITION BY k_name) AS VARCHAR)")} AS trip_id, * EXCLUDE (k_name) FROM named),
dropped AS (SELECT * EXCLUDE (pickup_datetime, dropoff_datetime) FROM keyed),
fact AS (SELECT {mapping_select(FACT_MAPPING)} FROM dropped),
zone AS (SELECT {text_zone_select()} FROM fact),
loaded AS (SELECT {mapping_select(LOAD_MAPPING)} FROM zone)
"""


def text_zone_select() -> str:
    """What a text-file round trip does to the fact: every value printed and
    read back with the zone's types."""
    out = []
    for src, src_t, dst, _ in LOAD_MAPPING:
        out.append(f"CAST(CAST({src} AS VARCHAR) AS {_DUCK_TYPES[src_t]}) AS {src}")
    return ", ".join(out)


def rule_sqls(window=DRIVER_WINDOW) -> list[tuple[str, str]]:
    rules = list(RANGE_RULES) + [("tpep_pickup_datetime", window[0], None),
                                 ("tpep_dropoff_datetime", None, window[1])]
    out = [("required_not_null", not_null_sql()),
           ("fee_domain", "(airport_fee = 1.25::DOUBLE OR airport_fee = 0.0::DOUBLE)"),
           ("pickup_before_dropoff", "tpep_pickup_datetime < tpep_dropoff_datetime")]
    for c, lo, hi in rules:
        parts = []
        if lo is not None:
            parts.append(f"{c} >= {lit(lo)}")
        if hi is not None:
            parts.append(f"{c} <= {lit(hi)}")
        out.append((f"range_{c}", " AND ".join(parts)))
    out.append(("kept_as_written", clean_sql("as_written", window)))
    out.append(("kept_grouped", clean_sql("grouped", window)))
    return out


def dims_ctes(calendar=DRIVER_CALENDAR, holidays=HOLIDAY_DATE_IDS) -> str:
    start, end = calendar
    hol = ", ".join(map(str, holidays))

    def values(rows, k, n):
        vals = ", ".join(f"({i}, '{s}')" for i, s in rows)
        return f"SELECT CAST(col0 AS INTEGER) AS {k}, col1 AS {n} FROM (VALUES {vals})"
    return f"""
dim_dates AS (
  SELECT CAST(d::DATE - DATE '{start}' AS INTEGER) AS date_id, d::DATE AS date,
         year(d)::INTEGER AS year, month(d)::INTEGER AS month, day(d)::INTEGER AS day,
         (isodow(d) - 1)::INTEGER AS weekday,
         (d::DATE - DATE '{start}') IN ({hol}) AS is_holiday
  FROM range(TIMESTAMP '{start}', TIMESTAMP '{end}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
dim_times AS (
  SELECT i::INTEGER AS time_id, (i // 3600)::INTEGER AS hour,
         ((i % 3600) // 60)::INTEGER AS minute, (i % 60)::INTEGER AS second
  FROM range(86400) t(i)),
dim_locations AS (
  SELECT CAST(n_nationkey AS INTEGER) AS location_id, r_name AS borough, n_name AS zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
dim_vendors AS ({values(VENDORS, 'vendor_id', 'vendor_name')}),
dim_rate_codes AS ({values(RATE_CODE_NAMES, 'rate_code_id', 'rate_code_name')}),
dim_payment_types AS ({values(PAYMENT_TYPE_NAMES, 'payment_type_id', 'payment_type_name')})
"""


def with_fact(select: str, mode: str = "as_written", dims: bool = False, copies: int = 1) -> str:
    ctes = fact_ctes(mode, copies=copies)
    if dims:
        ctes += "," + dims_ctes()
    return f"WITH {ctes}\n{select}"
