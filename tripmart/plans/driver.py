"""Inputs of the registered queries, derived from the driver tables.

raw trips  = the adapter over lineitem/orders/customer/supplier;
fact       = the transform over them with the 1999 window;
dimensions = calendar 1999, times, codes, locations = nation x region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dims import dim_locations_from, star_dims
from ..schema import DRIVER_CALENDAR, DRIVER_WINDOW, HOLIDAY_DATE_IDS
from ..sources.adapter import raw_trips, table
from .memo import memo
from .transform import stages


def driver_raw(spark: SparkSession, sf_dir: str, with_position: bool = True) -> DataFrame:
    return memo(spark, ("raw", sf_dir, with_position),
                lambda: raw_trips(spark, sf_dir, with_position=with_position), sf_dir)


def driver_stages(spark: SparkSession, sf_dir: str, mode: str = "as_written") -> dict[str, DataFrame]:
    return memo(spark, ("stages", sf_dir, mode),
                lambda: stages(driver_raw(spark, sf_dir), DRIVER_WINDOW, mode), sf_dir)


def driver_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_locations_from(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def driver_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return memo(spark, ("dims", sf_dir), lambda: star_dims(
        spark, driver_locations(spark, sf_dir), DRIVER_CALENDAR, HOLIDAY_DATE_IDS), sf_dir)
