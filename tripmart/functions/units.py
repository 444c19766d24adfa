from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import KM_DECIMALS, MILES_TO_KM


def miles_to_km(miles: Column, decimals: int = KM_DECIMALS) -> Column:
    """Miles -> kilometres rounded HALF_UP to `decimals` places."""
    return F.round(miles * F.lit(MILES_TO_KM), decimals)
