"""The transform chain: raw trips -> fact rows, as one lazy plan.

clean -> rename -> conform -> trip keys -> date/time ids -> drop datetime
columns -> mapping.  Everything except the key step is a Filter/Project
that whole-stage codegen fuses into the scan stage; the key step adds one
shuffle (see operators/keys.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_id, time_id
from ..operators.clean import clean
from ..operators.conform import conform, drop_by_pattern, fact_mapping, rename
from ..operators.keys import KEY_COLUMNS, STORAGE_COLUMNS, with_trip_id
from ..schema import DEFAULT_WINDOW, RAW_NAMES
from ..sources.adapter import POSITION_COLUMN


def add_time_keys(df: DataFrame) -> DataFrame:
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return df.withColumns({
        "pickup_date_id": date_id(p),
        "dropoff_date_id": date_id(d),
        "pickup_time_id": time_id(p),
        "dropoff_time_id": time_id(d),
    })


def stages(raw: DataFrame, window=DEFAULT_WINDOW, mode: str = "as_written",
           keep_fare_cents: bool = False) -> dict[str, DataFrame]:
    """Every intermediate of the chain, by name (all lazy).

    "measures" is the fact without trip_id: no shuffle, for whatever does not
    ask for the ids."""
    keep = [c for c in raw.columns if c in RAW_NAMES or c.lower() == "airport_fee"
            or c == POSITION_COLUMN or c in STORAGE_COLUMNS]
    cleaned = clean(raw.select(*[f"`{c}`" for c in keep]), window, mode)
    renamed = rename(cleaned)
    conformed = conform(renamed)
    timed = add_time_keys(conformed)
    # Ids are assigned before the time keys, so that only the columns of the
    # name cross the key step's shuffle.
    keyed = add_time_keys(with_trip_id(conformed, KEY_COLUMNS, position=POSITION_COLUMN))
    dropped = drop_by_pattern(keyed)
    # Storage partitions (from the file path) ride along untouched; they are
    # never derived from the row's own dates.
    fact = fact_mapping(dropped, keep_fare_cents=keep_fare_cents, passthrough=STORAGE_COLUMNS)
    measures = fact_mapping(drop_by_pattern(timed), keep_fare_cents=keep_fare_cents, passthrough=STORAGE_COLUMNS)
    return {"cleaned": cleaned, "renamed": renamed, "conformed": conformed, "timed": timed,
            "keyed": keyed, "dropped": dropped, "fact": fact, "measures": measures}


def transform(raw: DataFrame, window=DEFAULT_WINDOW, mode: str = "as_written",
              keep_fare_cents: bool = False) -> DataFrame:
    """Raw trips (19 columns, optional `_src_pos`) -> 22 fact columns."""
    return stages(raw, window, mode, keep_fare_cents)["fact"]
