"""Timestamp helpers (F7-F15). All timestamps are TIMESTAMP_NTZ; nothing depends on the session zone."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabwh.constants import SPEED_LIMIT_KMH

_EPOCH = "1970-01-01 00:00:00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from 'yyyy-MM-dd[ HH:mm:ss]', a date or a datetime."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(value)).cast("timestamp_ntz")


def add_seconds(ts, seconds) -> Column:
    """ts + seconds (a column or an int); stays NTZ."""
    secs = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return _c(ts) + secs.cast("bigint") * F.expr("INTERVAL '1' SECOND")


def seconds_between(start, end) -> Column:
    """Whole seconds from start to end (BIGINT); the same as EXTRACT(EPOCH ...) on whole-second data."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 of an NTZ timestamp (numeric order key for RANGE frames)."""
    return F.timestamp_diff("SECOND", ts_lit(_EPOCH), _c(ts))


def epoch_micros(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", ts_lit(_EPOCH), _c(ts))


def day_bounds(day) -> tuple[Column, Column]:
    """[midnight, next midnight) of a date: a half-open range keeps Parquet min/max pruning usable."""
    d = _dt.date.fromisoformat(str(day)) if not isinstance(day, _dt.date) else day
    return ts_lit(d), ts_lit(d + _dt.timedelta(days=1))


_CLOCK = r"(?:[ T](\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?)\d*)?)?\s*(?:Z|[+-]\d{2}:?\d{2})?\s*$"
_DAYFIRST = r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{4})" + _CLOCK
_ISO = r"^\s*(\d{4})[./-](\d{1,2})[./-](\d{1,2})" + _CLOCK
#: The form nearly all payment rows have: its parts stand at fixed places.
_FIXED = r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}$"


def parse_dayfirst(text) -> Column:
    """Day-first text (``dd.MM.yyyy``, also with ``/`` or ``-``) or year-first text, with or without a time.

    A missing time is midnight, missing seconds are 0, a fraction keeps six digits. A zone offset is accepted and
    the wall-clock time as written is kept, like all times here. Junk and impossible dates are NULL.

    Built from ``try_make_timestamp_ntz`` so the wall-clock value never passes through the
    session time zone (``try_to_timestamp`` yields LTZ). Text of the usual form is matched once and cut at its fixed
    places; the general patterns are matched anew for each of their groups.
    """
    t = _c(text)

    def part(pattern, idx, kind="int"):
        return F.regexp_extract(t, pattern, idx).try_cast(kind)

    def build(pattern, y, m, d):
        clock = [F.coalesce(part(pattern, i), F.lit(0)) for i in (4, 5)]
        sec = F.coalesce(part(pattern, 6, "decimal(16,6)"), F.lit(0).cast("decimal(16,6)"))
        return F.when(
            t.rlike(pattern),
            F.try_make_timestamp_ntz(part(pattern, y), part(pattern, m), part(pattern, d), *clock, sec),
        )

    def cut(start, length):
        return F.substring(t, start, length).try_cast("int")

    fixed = F.try_make_timestamp_ntz(cut(7, 4), cut(4, 2), cut(1, 2), cut(12, 2), cut(15, 2),
                                     cut(18, 2).cast("decimal(16,6)"))
    return F.when(t.rlike(_FIXED), fixed).otherwise(F.coalesce(build(_DAYFIRST, 3, 2, 1), build(_ISO, 1, 2, 3)))


def speed_over_limit(distance, seconds, limit: Decimal = SPEED_LIMIT_KMH) -> Column:
    """round(distance / (seconds / 3600), 2) > limit, without a division.

    Half-up rounding to hundredths exceeds ``limit`` exactly when the speed is at least
    limit + 0.005, i.e. distance * 3600 >= (limit + 0.005) * seconds. Zero or negative
    durations are never violations (the original raised a division error there).
    """
    s = _c(seconds)
    bound = F.lit(Decimal(limit) + Decimal("0.005"))
    return (s > 0) & (_c(distance) * F.lit(3600) >= bound * s)


def speed_hundredths(distance, seconds) -> Column:
    """Average speed in km/h rounded half-up to 2 decimals, as DECIMAL(18,2); NULL for zero time.

    With N = distance * 360000 (an integer for 2-decimal distances) the rounded value in
    hundredths is (2N + s) div 2s; integer arithmetic is identical in every engine.
    """
    s = _c(seconds)
    n = (_c(distance) * F.lit(360000)).cast("bigint")
    hundredths = F.when(s > 0, int_div(F.lit(2) * n + s, F.lit(2) * s))
    return (hundredths.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def int_div(a, b) -> Column:
    """Exact floor division of integer columns (decimal quotient, then floor)."""
    return F.floor(_c(a).cast("decimal(18,0)") / _c(b).cast("decimal(18,0)")).cast("bigint")
