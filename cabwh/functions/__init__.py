"""Column-level helpers: all built-in Spark expressions (JVM side, no Python UDF)."""

from cabwh.functions.keys import client_key, format_card, personnel_key, transaction_key, trim_plate
from cabwh.functions.time import (
    add_seconds,
    day_bounds,
    epoch_micros,
    epoch_seconds,
    parse_dayfirst,
    seconds_between,
    speed_hundredths,
    speed_over_limit,
    ts_lit,
)

__all__ = [
    "add_seconds",
    "client_key",
    "day_bounds",
    "epoch_micros",
    "epoch_seconds",
    "format_card",
    "parse_dayfirst",
    "personnel_key",
    "seconds_between",
    "speed_hundredths",
    "speed_over_limit",
    "transaction_key",
    "trim_plate",
    "ts_lit",
]
