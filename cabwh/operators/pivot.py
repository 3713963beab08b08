"""Long event rows -> one row per key with a timestamp column per event type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_columns(type_col: str, ts_col: str, mapping: Mapping[str, str]) -> list[Column]:
    """``max(ts) FILTER (type = v)`` per mapped value.

    This is exactly what ``groupBy().pivot(col, values).agg(max)`` computes; written as
    conditional aggregates it stays one hash aggregate (partial on the map side, one
    shuffle) and can share the pass with further aggregates. A repeated (key, type)
    keeps its latest time instead of failing.
    """
    return [F.max(F.when(F.col(type_col) == F.lit(v), F.col(ts_col))).alias(out) for v, out in mapping.items()]


def pivot_events(events: DataFrame, key: str, type_col: str, ts_col: str, mapping: Mapping[str, str],
                 fallback: Mapping[str, str] | None = None) -> DataFrame:
    """One row per ``key`` with ``mapping[value]`` columns; ``fallback`` = {col: col used when NULL}.

    Values missing from the data give NULL columns, so the output schema never depends on
    which events happen to be in a delta.
    """
    out = events.groupBy(key).agg(*pivot_columns(type_col, ts_col, mapping))
    for col, other in (fallback or {}).items():
        out = out.withColumn(col, F.coalesce(F.col(col), F.col(other)))
    return out


def pivot_events_grouped(events: DataFrame, key: str, type_col: str, ts_col: str,
                         mapping: Mapping[str, str]) -> DataFrame:
    """The same result through Spark's own ``pivot`` (used in tests as a cross-check)."""
    wide = events.groupBy(key).pivot(type_col, list(mapping)).agg(F.max(ts_col))
    return wide.select(key, *[F.col(f"`{v}`").alias(out) for v, out in mapping.items()])
