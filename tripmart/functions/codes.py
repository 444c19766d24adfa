from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_unless_in(col: Column, values: Iterable) -> Column:
    """Keep `col` when it is one of `values`, else NULL."""
    return F.when(col.isin(list(values)), col)


def flag_to_bool(col: Column, true_value: str = "Y") -> Column:
    """'Y' -> true; anything else, NULL included, -> false."""
    return F.coalesce(col == F.lit(true_value), F.lit(False))
