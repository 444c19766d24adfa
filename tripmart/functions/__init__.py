"""Column functions (Column -> Column), all built from Spark SQL functions."""

from .codes import flag_to_bool, null_unless_in
from .timekeys import date_id, epoch_nanos_to_ntz, time_id, weekday
from .units import miles_to_km
from .uuid5 import uuid5

__all__ = [
    "date_id", "epoch_nanos_to_ntz", "flag_to_bool", "miles_to_km",
    "null_unless_in", "time_id", "uuid5", "weekday",
]
