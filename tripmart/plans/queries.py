"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with oracles.

Every query reads the driver tables (or what Spark derives from them) in
full; none runs on made-up input alone.  Each has a DuckDB twin in
`ORACLE` (see oracle.py) except where noted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_id, epoch_nanos_to_ntz, flag_to_bool, miles_to_km, time_id
from ..functions.timekeys import epoch_seconds_of_ntz
from ..operators import clean as C
from ..operators import discover as D
from ..operators import insights as I
from ..operators import quality as Q
from ..operators.conform import (conform_codes, load_mapping, null_column_report,
                                 rename)
from ..operators.keys import KEY_COLUMNS
from ..operators.marts import trips_datetime, trips_labelled
from ..schema import DRIVER_WINDOW, FOREIGN_KEYS, LOAD_MAPPING, RAW_NAMES
from ..sources.adapter import POSITION_COLUMN, table
from ..sources.raw import normalise
from ..sources.zones import layout_for_write, read_text_zone, through_text, write_text_zone
from . import insight_states
from . import oracle as O
from .driver import driver_dims, driver_raw, driver_stages
from .memo import memo
from .run import run_pending
from .scratch import scratch_folder
from .transform import stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_RAW_COLS = ", ".join(RAW_NAMES)
_RAW = f"WITH raw AS ({O.RAW_TRIPS_SQL})\n"


def warehouse_fact(spark, sf) -> DataFrame:
    """The fact as the warehouse holds it: mapped, then loaded with the second
    mapping (amounts are 2-decimal doubles again)."""
    return memo(spark, ("warehouse_fact", sf),
                lambda: load_mapping(driver_stages(spark, sf)["fact"]), sf)


def warehouse_measures(spark, sf) -> DataFrame:
    """The warehouse fact without trip_id, for whatever does not ask for the
    ids: no key step, so no shuffle of the trips."""
    return memo(spark, ("warehouse_measures", sf),
                lambda: load_mapping(driver_stages(spark, sf)["measures"]), sf)


# =================================================================== A. scans

@register("raw_scan", f"{_RAW} SELECT {_RAW_COLS} FROM raw")
def q_raw_scan(spark, sf):
    return driver_raw(spark, sf).select(*RAW_NAMES)


def drifted_trips(spark, sf) -> DataFrame:
    """The adapter rows as a drifted month would store them: vendor as int,
    passenger count as bigint, `Airport_fee` capitalised, both timestamps as
    LONG epoch nanoseconds."""
    raw = driver_raw(spark, sf, with_position=False)

    def nanos(c):
        return (epoch_seconds_of_ntz(F.col(c)) * 1_000_000_000).cast("bigint") + 999
    return raw.select(
        F.col("VendorID").cast("int").alias("VendorID"),
        nanos("tpep_pickup_datetime").alias("tpep_pickup_datetime"),
        nanos("tpep_dropoff_datetime").alias("tpep_dropoff_datetime"),
        F.col("passenger_count").cast("bigint").alias("passenger_count"),
        *[c for c in RAW_NAMES[4:-1]],
        F.col("airport_fee").alias("Airport_fee"),
    )


@register("raw_normalised", f"{_RAW} SELECT {_RAW_COLS} FROM raw")
def q_raw_normalised(spark, sf):
    return normalise(drifted_trips(spark, sf)).select(*RAW_NAMES)


@register("epoch_nanos_to_ts", f"""{_RAW}
SELECT epoch_us(tpep_pickup_datetime) * 1000 + 999 AS pickup_nanos,
       tpep_pickup_datetime AS pickup_datetime
FROM raw""")
def q_epoch_nanos_to_ts(spark, sf):
    d = drifted_trips(spark, sf)
    return d.select(F.col("tpep_pickup_datetime").alias("pickup_nanos"),
                    epoch_nanos_to_ntz(F.col("tpep_pickup_datetime")).alias("pickup_datetime"))


_ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_NAMES)


@register("dev_sample", f"{_RAW} SELECT {_RAW_COLS} FROM raw ORDER BY {_ORDER_ALL} LIMIT 1000")
def q_dev_sample(spark, sf):
    """A reproducible sample: first 1,000 rows in full-row order (a top-k)."""
    raw = driver_raw(spark, sf).select(*RAW_NAMES)
    return raw.orderBy(*[F.col(c).asc_nulls_first() for c in RAW_NAMES]).limit(1000)


# =================================================================== C. clean

@register("required_not_null", f"{_RAW} SELECT {_RAW_COLS} FROM raw WHERE {O.not_null_sql()}")
def q_required_not_null(spark, sf):
    return C.required_not_null(driver_raw(spark, sf)).select(*RAW_NAMES)


@register("range_rules", f"{_RAW} SELECT {_RAW_COLS} FROM raw WHERE {O.ranges_sql()}")
def q_range_rules(spark, sf):
    return C.range_rules(driver_raw(spark, sf), DRIVER_WINDOW).select(*RAW_NAMES)


@register("clean_as_written", O.with_fact(f"SELECT {_RAW_COLS} FROM cleaned"))
def q_clean_as_written(spark, sf):
    return C.clean(driver_raw(spark, sf), DRIVER_WINDOW, "as_written").select(*RAW_NAMES)


@register("clean_grouped", O.with_fact(f"SELECT {_RAW_COLS} FROM cleaned", mode="grouped"))
def q_clean_grouped(spark, sf):
    return C.clean(driver_raw(spark, sf), DRIVER_WINDOW, "grouped").select(*RAW_NAMES)


@register("rule_violations", _RAW + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, CAST(count_if(NOT coalesce({p}, false)) AS BIGINT) AS failing, "
    f"CAST(count_if(coalesce({p}, false)) AS BIGINT) AS passing FROM raw" for n, p in O.rule_sqls()))
def q_rule_violations(spark, sf):
    return C.rule_violations(driver_raw(spark, sf), DRIVER_WINDOW)


# =================================================================== C. conform

@register("renamed", f"{_RAW} SELECT {O.renamed_select()} FROM raw")
def q_renamed(spark, sf):
    return rename(driver_raw(spark, sf).select(*RAW_NAMES))


@register("domain_nulls", f"""{_RAW}
SELECT CASE WHEN VendorID IN (1, 2) THEN VendorID END AS vendor_id,
       CASE WHEN RatecodeID IN (1, 2, 3, 4, 5, 6) THEN RatecodeID END AS rate_code_id,
       CASE WHEN payment_type IN (1, 2, 3, 4, 5, 6) THEN payment_type END AS payment_type_id
FROM raw""")
def q_domain_nulls(spark, sf):
    return conform_codes(rename(driver_raw(spark, sf).select(*RAW_NAMES))) \
        .select("vendor_id", "rate_code_id", "payment_type_id")


@register("flag_bool", f"""{_RAW}
SELECT store_and_fwd_flag, coalesce(store_and_fwd_flag = 'Y', false) AS store_and_forward FROM raw""")
def q_flag_bool(spark, sf):
    r = driver_raw(spark, sf)
    return r.select("store_and_fwd_flag",
                    flag_to_bool(F.col("store_and_fwd_flag")).alias("store_and_forward"))


@register("miles_to_km", f"""{_RAW}
SELECT trip_distance AS trip_distance_miles,
       round(trip_distance * 1.60934::DOUBLE, 3) AS trip_distance_km FROM raw""")
def q_miles_to_km(spark, sf):
    r = driver_raw(spark, sf)
    return r.select(F.col("trip_distance").alias("trip_distance_miles"),
                    miles_to_km(F.col("trip_distance")).alias("trip_distance_km"))


@register("trip_date_ids", f"""{_RAW}
SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
       (dayofyear(tpep_pickup_datetime) - 1)::INTEGER AS pickup_date_id,
       (dayofyear(tpep_dropoff_datetime) - 1)::INTEGER AS dropoff_date_id FROM raw""")
def q_trip_date_ids(spark, sf):
    r = driver_raw(spark, sf)
    return r.select("tpep_pickup_datetime", "tpep_dropoff_datetime",
                    date_id(F.col("tpep_pickup_datetime")).alias("pickup_date_id"),
                    date_id(F.col("tpep_dropoff_datetime")).alias("dropoff_date_id"))


@register("trip_time_ids", f"""{_RAW}
SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
 (hour(tpep_pickup_datetime)*3600 + minute(tpep_pickup_datetime)*60 + second(tpep_pickup_datetime))::INTEGER AS pickup_time_id,
 (hour(tpep_dropoff_datetime)*3600 + minute(tpep_dropoff_datetime)*60 + second(tpep_dropoff_datetime))::INTEGER AS dropoff_time_id
FROM raw""")
def q_trip_time_ids(spark, sf):
    r = driver_raw(spark, sf)
    return r.select("tpep_pickup_datetime", "tpep_dropoff_datetime",
                    time_id(F.col("tpep_pickup_datetime")).alias("pickup_time_id"),
                    time_id(F.col("tpep_dropoff_datetime")).alias("dropoff_time_id"))


# =================================================================== E / C. keys, fact

@register("trip_keys", O.with_fact(f"SELECT trip_id, {', '.join(KEY_COLUMNS)} FROM keyed"))
def q_trip_keys(spark, sf):
    return driver_stages(spark, sf)["keyed"].select("trip_id", *KEY_COLUMNS)


@register("trip_keys_repeated", O.with_fact(f"SELECT trip_id, {', '.join(KEY_COLUMNS)} FROM keyed", copies=2))
def q_trip_keys_repeated(spark, sf):
    """Ids where every trip occurs twice: occurrence numbers go beyond 1."""
    raw = driver_raw(spark, sf)
    again = raw.withColumn(POSITION_COLUMN, F.xxhash64(POSITION_COLUMN, F.lit(1)))
    return stages(raw.unionByName(again), DRIVER_WINDOW)["keyed"].select("trip_id", *KEY_COLUMNS)


@register("drop_by_pattern", O.with_fact("SELECT * FROM dropped"))
def q_drop_by_pattern(spark, sf):
    return driver_stages(spark, sf)["dropped"]


@register("fact_mapped", O.with_fact("SELECT * FROM fact"))
def q_fact_mapped(spark, sf):
    return driver_stages(spark, sf)["fact"]


@register("fact_loaded", O.with_fact("SELECT * FROM loaded"))
def q_fact_loaded(spark, sf):
    return load_mapping(through_text(driver_stages(spark, sf)["fact"]))


def raw_by_month(spark, sf) -> DataFrame:
    """The raw trips with the storage month that their file would be in, and their position."""
    pickup = F.col("tpep_pickup_datetime")
    return driver_raw(spark, sf).withColumns({"year": F.year(pickup), "month": F.month(pickup)})


@register("fact_loaded_text", O.with_fact("SELECT * FROM loaded"))
def q_fact_loaded_text(spark, sf):
    """The load through a real text zone: written as CSV by month, read back
    by position, lines that don't parse left out, mapped."""
    zone = scratch_folder(spark, "text-zone")
    fact = driver_stages(spark, sf)["fact"]
    month = (F.floor(F.col("pickup_date_id") / 31) + 1).cast("int")
    write_text_zone(fact.withColumns({"year": F.lit(1999), "month": month}), zone)
    return load_mapping(read_text_zone(spark, zone))


def _null_report_sql() -> str:
    parts = []
    for _, src_t, dst, dst_t in LOAD_MAPPING:
        if dst_t == "string":
            cond = f"trim({dst}) IS NULL OR trim({dst}) IN ('')"
        elif dst_t in ("int", "long", "double"):
            cond = f"{dst} IS NULL OR {dst} IN (0)"
        else:
            parts.append(f"SELECT '{dst}' AS column, false AS dropped")
            continue
        parts.append(f"SELECT '{dst}' AS column, coalesce(bool_and(coalesce({cond}, false)), true)"
                     f" AS dropped FROM loaded")
    return "\nUNION ALL\n".join(parts)


@register("drop_null_columns", O.with_fact(_null_report_sql()))
def q_drop_null_columns(spark, sf):
    """Which warehouse columns `drop_null_columns` would drop with null sets
    {NULL, ''} and {NULL, 0}: the one-aggregate report behind the drop."""
    return null_column_report(warehouse_fact(spark, sf), null_strings=[None, ""],
                              null_numbers=[None, 0])


# =================================================================== F. dimensions (by use)

@register("trips_by_date", O.with_fact("""
SELECT coalesce(d.date_id, c.pickup_date_id) AS date_id, d.date, d.year, d.month, d.day, d.weekday,
       d.is_holiday, coalesce(c.pickups, 0) AS pickups
FROM dim_dates d
FULL OUTER JOIN (SELECT pickup_date_id, count(*) AS pickups FROM loaded GROUP BY 1) c
  ON c.pickup_date_id = d.date_id""", dims=True))
def q_trips_by_date(spark, sf):
    """The date dimension with pickups per day: every calendar row, and every
    pickup date without one."""
    dd = driver_dims(spark, sf)["dim_dates"]
    c = warehouse_measures(spark, sf).groupBy(F.col("pickup_date_id").alias("date_id")) \
        .agg(F.count(F.lit(1)).alias("pickups"))
    return dd.join(c, "date_id", "full_outer").select(
        *dd.columns, F.coalesce("pickups", F.lit(0)).alias("pickups"))


@register("pickups_by_time", O.with_fact("""
SELECT coalesce(t.time_id, c.pickup_time_id) AS time_id, t.hour, t.minute, t.second,
       coalesce(c.pickups, 0) AS pickups
FROM dim_times t
FULL OUTER JOIN (SELECT pickup_time_id, count(*) AS pickups FROM loaded GROUP BY 1) c
  ON c.pickup_time_id = t.time_id""", dims=True))
def q_pickups_by_time(spark, sf):
    """The time dimension with pickups per second of the day."""
    dt = driver_dims(spark, sf)["dim_times"]
    c = warehouse_measures(spark, sf).groupBy(F.col("pickup_time_id").alias("time_id")) \
        .agg(F.count(F.lit(1)).alias("pickups"))
    return dt.join(c, "time_id", "full_outer").select(
        *dt.columns, F.coalesce("pickups", F.lit(0)).alias("pickups"))


_CODE_DIMS = [("vendor", "dim_vendors", "vendor_id", "vendor_name"),
              ("rate_code", "dim_rate_codes", "rate_code_id", "rate_code_name"),
              ("payment_type", "dim_payment_types", "payment_type_id", "payment_type_name")]


@register("trips_by_code", O.with_fact("\nUNION ALL\n".join(f"""
SELECT '{k}' AS dimension, coalesce(d.{key}, c.code) AS code, d.{name} AS name,
       coalesce(c.trips, 0) AS trips
FROM {dim} d FULL OUTER JOIN (SELECT {key} AS code, count(*) AS trips FROM loaded GROUP BY 1) c
  ON c.code = d.{key}""" for k, dim, key, name in _CODE_DIMS), dims=True))
def q_trips_by_code(spark, sf):
    """Vendor, rate-code and payment dimensions with trips per code; codes
    missing from a dimension (NULL after conforming) show with NULL name.
    The fact is aggregated ONCE to (vendor, rate, payment) combinations (at
    most a few hundred rows); each dimension's counts come from that shared
    aggregate, so the fact pipeline runs once, not once per dimension."""
    fact, dims = warehouse_measures(spark, sf), driver_dims(spark, sf)
    combos = fact.groupBy(*[key for _, _, key, _ in _CODE_DIMS]) \
        .agg(F.count(F.lit(1)).alias("n"))
    out = None
    for k, dim, key, name in _CODE_DIMS:
        c = combos.groupBy(F.col(key).alias("code")).agg(F.sum("n").alias("trips"))
        d = dims[dim].select(F.col(key).alias("dcode"), F.col(name).alias("name"))
        part = d.join(c, d.dcode == c.code, "full_outer").select(
            F.lit(k).alias("dimension"), F.coalesce("dcode", "code").alias("code"), "name",
            F.coalesce("trips", F.lit(0)).alias("trips"))
        out = part if out is None else out.unionByName(part)
    return out


@register("trips_by_location", O.with_fact("""
SELECT coalesce(l.location_id, c.k) AS location_id, l.borough, l.zone,
       CAST(coalesce(c.p, 0) AS BIGINT) AS pickups, CAST(coalesce(c.d, 0) AS BIGINT) AS dropoffs
FROM dim_locations l
FULL OUTER JOIN (SELECT k, sum(p) AS p, sum(d) AS d FROM (
  SELECT pickup_location_id AS k, 1 AS p, 0 AS d FROM loaded
  UNION ALL SELECT dropoff_location_id, 0, 1 FROM loaded) GROUP BY k) c ON c.k = l.location_id
""", dims=True))
def q_trips_by_location(spark, sf):
    """The location dimension with pickups and dropoffs per location, and
    locations without a row in it (the fact is aggregated once to location
    pairs, then to each end)."""
    fact, loc = warehouse_measures(spark, sf), driver_dims(spark, sf)["dim_locations"]
    pairs = fact.groupBy("pickup_location_id", "dropoff_location_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    ends = F.array(F.struct(F.col("pickup_location_id").alias("location_id"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("d")),
                   F.struct(F.col("dropoff_location_id").alias("location_id"), F.lit(0).cast("bigint").alias("p"), F.col("n").alias("d")))
    c = pairs.select(F.inline(ends)).groupBy("location_id") \
        .agg(F.sum("p").alias("pickups"), F.sum("d").alias("dropoffs"))
    return (loc.join(c, "location_id", "full_outer")
            .select("location_id", "borough", "zone",
                    F.coalesce("pickups", F.lit(0)).alias("pickups"),
                    F.coalesce("dropoffs", F.lit(0)).alias("dropoffs")))


# =================================================================== G. quality

_PK_TABLES = [("fact_trips", "loaded", "trip_id"), ("dim_vendors", "dim_vendors", "vendor_id"),
              ("dim_dates", "dim_dates", "date_id"), ("dim_times", "dim_times", "time_id"),
              ("dim_locations", "dim_locations", "location_id"),
              ("dim_rate_codes", "dim_rate_codes", "rate_code_id"),
              ("dim_payment_types", "dim_payment_types", "payment_type_id")]


@register("pk_violations", O.with_fact("\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, '{k}' AS key_column, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
       CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys,
       CAST(count_if(k IS NOT NULL AND n > 1) AS BIGINT) AS duplicate_keys
FROM (SELECT {k} AS k, count(*) AS n FROM {src} GROUP BY 1)""" for t, src, k in _PK_TABLES),
    dims=True))
def q_pk_violations(spark, sf):
    tables = dict(driver_dims(spark, sf))
    tables["fact_trips"] = warehouse_fact(spark, sf)
    return Q.pk_report(tables)


@register("fk_orphans", O.with_fact("\nUNION ALL\n".join(f"""
SELECT '{c}' AS fk_column, '{d}' AS dimension,
       CAST(count_if(f.{c} IS NOT NULL AND k.key IS NULL) AS BIGINT) AS orphans,
       CAST(count_if(f.{c} IS NOT NULL) AS BIGINT) AS checked
FROM loaded f LEFT JOIN (SELECT DISTINCT {dk} AS key FROM {d}) k ON k.key = f.{c}"""
    for c, d, dk in FOREIGN_KEYS), dims=True))
def q_fk_orphans(spark, sf):
    return Q.fk_orphans(warehouse_measures(spark, sf), driver_dims(spark, sf))


# =================================================================== H. marts

_TRIPS_DATETIME_SQL = """
SELECT trip_id, trip_distance, pd.date AS pickup_date, pt.hour AS pickup_hour,
       pt.minute AS pickup_minute, pt.second AS pickup_second, dd.date AS dropoff_date,
       dt.hour AS dropoff_hour, dt.minute AS dropoff_minute, dt.second AS dropoff_second,
       CAST(passenger_count AS INTEGER) AS passenger_count, payment_type_id, total_amount
FROM loaded
LEFT JOIN dim_dates pd ON pd.date_id = pickup_date_id
LEFT JOIN dim_dates dd ON dd.date_id = dropoff_date_id
LEFT JOIN dim_times pt ON pt.time_id = pickup_time_id
LEFT JOIN dim_times dt ON dt.time_id = dropoff_time_id
"""


@register("trips_datetime", O.with_fact(_TRIPS_DATETIME_SQL, dims=True))
def q_trips_datetime(spark, sf):
    dims = driver_dims(spark, sf)
    return trips_datetime(warehouse_fact(spark, sf), dims["dim_dates"], dims["dim_times"])


_LABELLED_CTE = """,
labelled AS (
SELECT trip_id, pd.date AS pickup_date, pd.weekday AS pickup_weekday, pt.hour AS pickup_hour,
       pl.borough AS pickup_borough, pl.zone AS pickup_zone,
       dl.borough AS dropoff_borough, dl.zone AS dropoff_zone,
       v.vendor_name, r.rate_code_name, p.payment_type_name,
       passenger_count, trip_distance, fare_amount, tip_amount, total_amount
FROM loaded f
LEFT JOIN dim_dates pd ON pd.date_id = f.pickup_date_id
LEFT JOIN dim_times pt ON pt.time_id = f.pickup_time_id
LEFT JOIN dim_locations pl ON pl.location_id = f.pickup_location_id
LEFT JOIN dim_locations dl ON dl.location_id = f.dropoff_location_id
LEFT JOIN dim_vendors v ON v.vendor_id = f.vendor_id
LEFT JOIN dim_rate_codes r ON r.rate_code_id = f.rate_code_id
LEFT JOIN dim_payment_types p ON p.payment_type_id = f.payment_type_id)
"""


def _with_labelled(select: str) -> str:
    return "WITH " + O.fact_ctes() + "," + O.dims_ctes() + _LABELLED_CTE + select


def _labelled(spark, sf) -> DataFrame:
    """The labelled mart without trip_id."""
    return trips_labelled(warehouse_measures(spark, sf), driver_dims(spark, sf))


@register("trips_labelled", _with_labelled("SELECT * FROM labelled"))
def q_trips_labelled(spark, sf):
    return trips_labelled(warehouse_fact(spark, sf), driver_dims(spark, sf))


# =================================================================== I. insights

_HEATMAP_SQL = """
SELECT d.weekday AS weekday, t.hour AS pickup_hour, count(*) AS trips
FROM loaded
LEFT JOIN dim_dates d ON d.date_id = pickup_date_id
LEFT JOIN dim_times t ON t.time_id = pickup_time_id
GROUP BY 1, 2
"""


def _heatmap(spark, sf) -> DataFrame:
    dims = driver_dims(spark, sf)
    return I.demand_heatmap(warehouse_measures(spark, sf), dims["dim_dates"], dims["dim_times"])


@register("demand_heatmap", O.with_fact(_HEATMAP_SQL, dims=True))
def q_demand_heatmap(spark, sf):
    return _heatmap(spark, sf)


@register("demand_peak", O.with_fact(
    f"SELECT * FROM ({_HEATMAP_SQL}) ORDER BY trips DESC, weekday ASC NULLS LAST, "
    "pickup_hour ASC NULLS LAST LIMIT 5", dims=True))
def q_demand_peak(spark, sf):
    return I.demand_peak(_heatmap(spark, sf), k=5)


@register("borough_pairs_topk", _with_labelled("""
SELECT pickup_borough, dropoff_borough, count(*) AS trips FROM labelled GROUP BY 1, 2
ORDER BY trips DESC, pickup_borough ASC NULLS LAST, dropoff_borough ASC NULLS LAST LIMIT 10"""))
def q_borough_pairs_topk(spark, sf):
    return I.borough_pairs_topk(_labelled(spark, sf), k=10)


@register("payment_share", _with_labelled("""
SELECT payment_type_name, count(*) AS trips,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM labelled GROUP BY 1"""))
def q_payment_share(spark, sf):
    return I.payment_share(_labelled(spark, sf))


@register("avg_total_by_passengers", O.with_fact("""
SELECT passenger_count, count(*) AS trips, round(avg(total_amount), 4) AS avg_total_amount
FROM loaded GROUP BY 1"""))
def q_avg_total_by_passengers(spark, sf):
    return I.avg_total_by_passengers(warehouse_measures(spark, sf))


@register("passenger_premium", O.with_fact("""
SELECT round(avg(total_amount) FILTER (WHERE passenger_count = 4), 4) AS avg_total_4,
       round(avg(total_amount) FILTER (WHERE passenger_count = 1), 4) AS avg_total_1,
       round(avg(total_amount) FILTER (WHERE passenger_count = 4)
             - avg(total_amount) FILTER (WHERE passenger_count = 1), 4) AS premium
FROM loaded WHERE passenger_count IN (4, 1)"""))
def q_passenger_premium(spark, sf):
    return I.passenger_premium(warehouse_measures(spark, sf))


def _states(spark, sf) -> DataFrame:
    """The fact's monthly states (storage months from the pickup dates)."""
    dims = driver_dims(spark, sf)
    month = (F.floor(F.col("pickup_date_id") / 31) + 1).cast("int")
    fact = warehouse_measures(spark, sf).withColumns({"year": F.lit(1999), "month": month})
    return insight_states.month_states(fact, dims["dim_dates"], dims["dim_times"])


@register("demand_heatmap_merged", O.with_fact(_HEATMAP_SQL, dims=True))
def q_demand_heatmap_merged(spark, sf):
    """The heat map put together from the states of all months."""
    return insight_states.heatmap(_states(spark, sf))


@register("avg_total_merged", O.with_fact("""
SELECT passenger_count, count(*) AS trips, round(avg(total_amount), 4) AS avg_total_amount
FROM loaded GROUP BY 1"""))
def q_avg_total_merged(spark, sf):
    return insight_states.avg_total_by_passengers(_states(spark, sf))


# =================================================================== B. discovery

# Pattern used on the driver pages (their links are site-relative words).
DRIVER_LINK_PATTERN = r"^/[A-Z]"

_LINKS_SQL = r"""
b AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'),
        '(?is)<(script|style)\b.*?</(script|style)\s*>', ' ', 'g') AS body FROM pages),
t AS (SELECT page_id, unnest(regexp_extract_all(body, '(?i)<a(?:[\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 0)) AS t FROM b),
v AS (SELECT page_id, regexp_extract(t, '(?i)^<a(?:[\s/]+[^\s/>=]+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s>"'']+))?)*?[\s/]+href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1) AS v
      FROM t WHERE v <> ''),
links AS (SELECT page_id, replace(replace(replace(replace(replace(
        CASE WHEN left(v, 1) IN ('"', '''') THEN substr(v, 2, length(v) - 2) ELSE v END,
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS href FROM v)
"""


@register("page_links", f"WITH {_LINKS_SQL} SELECT page_id, href FROM links")
def q_page_links(spark, sf):
    return D.links(table(spark, sf, "pages"))


@register("page_links_filtered",
          f"WITH {_LINKS_SQL} SELECT page_id, href FROM links "
          f"WHERE regexp_matches(href, '{DRIVER_LINK_PATTERN}')")
def q_page_links_filtered(spark, sf):
    return D.filter_links(D.links(table(spark, sf, "pages")), DRIVER_LINK_PATTERN)


_LISTING_SQL = r"""
listing AS (SELECT DISTINCT 'https://data.example/trip-data/yellow_tripdata_'
                   || strftime(o_orderdate, '%Y-%m') || '.parquet' AS url FROM orders),
periods AS (SELECT url, nullif(regexp_extract(url, '\w{4}-\d\d', 0), '') AS period FROM listing),
raw_keys AS (SELECT 'year=' || split_part(period, '-', 1) || '/month=' || split_part(period, '-', 2)
                    || '/data.parquet' AS key FROM periods),
target_keys AS (SELECT 'year=' || split_part(period, '-', 1) || '/month=' || split_part(period, '-', 2)
                       || '/part-0000' || i || '.csv' AS key
                FROM periods, range(2) t(i) WHERE split_part(period, '-', 1) <= '1998')
"""


def _listing(spark, sf) -> DataFrame:
    return D.source_listing(table(spark, sf, "orders"))


def _raw_keys(spark, sf) -> DataFrame:
    return D.with_partition_key(D.with_period(_listing(spark, sf), on_missing="drop")).select("key")


def _target_keys(spark, sf) -> DataFrame:
    """Transformed-zone stand-in: two part files for every month up to 1998."""
    p = D.with_period(_listing(spark, sf), on_missing="drop") \
        .where(F.substring("period", 1, 4) <= "1998")
    p = p.select("period", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"))
    return p.select(F.format_string("year=%s/month=%s/part-0000%d.csv",
                                    F.split("period", "-")[0], F.split("period", "-")[1],
                                    "part").alias("key"))


@register("url_period", "WITH " + _LISTING_SQL + r"""
SELECT url, nullif(regexp_extract(url, '\w{4}-\d\d', 0), '') AS period
FROM (SELECT url FROM listing UNION ALL SELECT url FROM pages)""")
def q_url_period(spark, sf):
    urls = _listing(spark, sf).unionByName(table(spark, sf, "pages").select("url"))
    return D.with_period(urls)


@register("partition_path", f"""WITH {_LISTING_SQL}
SELECT url, period, 'year=' || split_part(period, '-', 1) || '/month=' || split_part(period, '-', 2)
       || '/data.parquet' AS key FROM periods""")
def q_partition_path(spark, sf):
    return D.with_partition_key(D.with_period(_listing(spark, sf), on_missing="error"))


@register("period_from_key", f"""WITH {_LISTING_SQL}
SELECT key, substr(key, 6, 4) AS year, substr(key, 17, 2) AS month,
       substr(key, 6, 4) || '-' || substr(key, 17, 2) AS period FROM raw_keys""")
def q_period_from_key(spark, sf):
    return D.keys_by_offset(_raw_keys(spark, sf))


@register("key_folder", f"""WITH {_LISTING_SQL}
SELECT key, regexp_replace(key, '/?[^/]*$', '') AS folder
FROM (SELECT key FROM raw_keys UNION ALL SELECT key FROM target_keys)""")
def q_key_folder(spark, sf):
    from ..functions.paths import key_folder
    keys = _raw_keys(spark, sf).unionByName(_target_keys(spark, sf))
    return keys.select("key", key_folder(F.col("key")).alias("folder"))


@register("new_source_files", f"""WITH {_LISTING_SQL}
SELECT p.period, p.url FROM periods p
WHERE p.period NOT IN (SELECT substr(key, 6, 4) || '-' || substr(key, 17, 2) FROM raw_keys
                       WHERE substr(key, 6, 4) <= '1998')""")
def q_new_source_files(spark, sf):
    existing = _raw_keys(spark, sf).where(F.substring("key", 6, 4) <= "1998")
    return D.new_sources(_listing(spark, sf), existing)


_UNPROCESSED_SQL = """
src AS (SELECT key, nullif(regexp_extract(key, '(?:^|/)year=([^/]*)(?:/|$)', 1), '') AS year,
               nullif(regexp_extract(key, '(?:^|/)month=([^/]*)(?:/|$)', 1), '') AS month
        FROM raw_keys),
tgt AS (SELECT DISTINCT nullif(regexp_extract(key, '(?:^|/)year=([^/]*)(?:/|$)', 1), '') AS year,
               nullif(regexp_extract(key, '(?:^|/)month=([^/]*)(?:/|$)', 1), '') AS month
        FROM target_keys),
pending AS (SELECT s.key, s.year, s.month FROM src s
            WHERE s.year IS NOT NULL AND s.month IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.year = s.year AND t.month = s.month))
"""


@register("unprocessed_partitions", f"WITH {_LISTING_SQL}, {_UNPROCESSED_SQL} SELECT * FROM pending")
def q_unprocessed_partitions(spark, sf):
    return D.unprocessed(_raw_keys(spark, sf), _target_keys(spark, sf))


@register("load_audit", f"""WITH {_LISTING_SQL}, {_UNPROCESSED_SQL},
raw AS ({O.RAW_TRIPS_SQL}),
counts AS (SELECT year(tpep_pickup_datetime) AS y, month(tpep_pickup_datetime) AS m, count(*) AS n
           FROM raw GROUP BY 1, 2),
results AS (SELECT p.key, CASE WHEN coalesce(c.n, 0) > 0 THEN 'success' ELSE 'failed' END AS status,
                   coalesce(c.n, 0) AS rows
            FROM pending p LEFT JOIN counts c
              ON c.y = CAST(p.year AS INTEGER) AND c.m = CAST(p.month AS INTEGER))
SELECT status, list_sort(list(key)) AS partitions, count(*) AS n_partitions,
       CAST(sum(rows) AS BIGINT) AS rows
FROM results GROUP BY status""")
def q_load_audit(spark, sf):
    """Outcome of loading the pending partitions: a partition succeeds when
    the raw trips hold rows for its month."""
    pending = D.unprocessed(_raw_keys(spark, sf), _target_keys(spark, sf))
    raw = driver_raw(spark, sf, with_position=False)
    counts = raw.groupBy(F.year("tpep_pickup_datetime").alias("y"),
                         F.month("tpep_pickup_datetime").alias("m")) \
        .agg(F.count(F.lit(1)).alias("n"))
    j = pending.join(counts, (counts.y == pending.year.cast("int"))
                     & (counts.m == pending.month.cast("int")), "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    results = j.select("key", F.when(n > 0, "success").otherwise("failed").alias("status"),
                       n.alias("rows"))
    return D.audit(results)


@register("load_audit_kept", f"""WITH {_LISTING_SQL}, {_UNPROCESSED_SQL}, {O.fact_ctes()},
counts AS (SELECT year(tpep_pickup_datetime) AS y, month(tpep_pickup_datetime) AS m, count(*) AS n
           FROM cleaned GROUP BY 1, 2),
results AS (SELECT p.key, CASE WHEN coalesce(c.n, 0) > 0 THEN 'success' ELSE 'empty' END AS status,
                   coalesce(c.n, 0) AS rows
            FROM pending p LEFT JOIN counts c
              ON c.y = CAST(p.year AS INTEGER) AND c.m = CAST(p.month AS INTEGER))
SELECT status, list_sort(list(key)) AS partitions, count(*) AS n_partitions,
       CAST(sum(rows) AS BIGINT) AS rows
FROM results GROUP BY status""")
def q_load_audit_kept(spark, sf):
    """Outcome of cleaning the pending partitions: months of which no trip
    survives are empty."""
    pending = D.unprocessed(_raw_keys(spark, sf), _target_keys(spark, sf))
    cleaned = driver_stages(spark, sf)["cleaned"]
    counts = cleaned.groupBy(F.year("tpep_pickup_datetime").alias("y"),
                             F.month("tpep_pickup_datetime").alias("m")) \
        .agg(F.count(F.lit(1)).alias("n"))
    j = pending.join(counts, (counts.y == pending.year.cast("int"))
                     & (counts.m == pending.month.cast("int")), "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    results = j.select("key", F.when(n > 0, "success").otherwise("empty").alias("status"),
                       n.alias("rows"))
    return D.audit(results)


@register("run_audit", f"""WITH {O.fact_ctes(mode="grouped")},
months AS (SELECT year(tpep_pickup_datetime) AS y, month(tpep_pickup_datetime) AS m FROM ({O.RAW_TRIPS_SQL}) GROUP BY 1, 2),
counts AS (SELECT year(tpep_pickup_datetime) AS y, month(tpep_pickup_datetime) AS m, count(*) AS n FROM cleaned GROUP BY 1, 2),
results AS (SELECT 'year=' || months.y || '/month=' || lpad(CAST(months.m AS VARCHAR), 2, '0') AS key,
                   CASE WHEN months.y = 1999 AND months.m = 3 THEN 'failed' WHEN coalesce(n, 0) > 0 THEN 'success' ELSE 'empty' END AS status,
                   CASE WHEN months.y = 1999 AND months.m = 3 THEN 0 ELSE coalesce(n, 0) END AS rows
            FROM months LEFT JOIN counts ON months.y = counts.y AND months.m = counts.m)
SELECT status, list_sort(list(key)) AS partitions, count(*) AS n_partitions, CAST(sum(rows) AS BIGINT) AS rows
FROM results GROUP BY status""")
def q_run_audit(spark, sf):
    """A whole run over a raw zone of all months, one of which has a file that
    can't be read as trips: it fails alone, months outside the window are empty."""
    folder = scratch_folder(spark, "run-audit")
    # A month goes to as many tasks as its rows ask for, also where they share one instant.
    raw = layout_for_write(raw_by_month(spark, sf), sort_cols=("tpep_pickup_datetime",), tie_breaker=POSITION_COLUMN).drop(POSITION_COLUMN)
    raw.write.partitionBy("year", "month").parquet(f"{folder}/raw")
    # The broken files hold the month's rows as its files have them now, so that the trips are not joined again.
    written = spark.read.schema(raw.schema).parquet(f"{folder}/raw")
    broken = written.where("year = 1999 and month = 3").withColumn("fare_amount", F.array("fare_amount"))
    broken.write.mode("append").partitionBy("year", "month").parquet(f"{folder}/raw")
    return run_pending(spark, f"{folder}/raw", f"{folder}/out", DRIVER_WINDOW, "grouped")
