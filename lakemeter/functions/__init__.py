"""Column-level helpers; all built-in Spark expressions (JVM side, codegen)."""

from lakemeter.functions.hashing import checksum, surrogate_key
from lakemeter.functions.text import clean_number, normalise_label
from lakemeter.functions.timeutil import (
    date_key,
    epoch_micros,
    floor_hours,
    hours_between,
    local_hour,
    local_to_utc,
    parse_local_timestamp,
    utc_now,
    utc_to_local,
)

__all__ = [
    "checksum", "surrogate_key", "clean_number", "normalise_label", "date_key", "epoch_micros",
    "floor_hours", "hours_between", "local_hour", "local_to_utc", "parse_local_timestamp",
    "utc_now", "utc_to_local",
]
