"""Slowly changing dimensions, type 2.

A version is valid on ``[start_dt, end_dt]``, both ends inclusive; the open version has
``end_dt = 9999-01-01 00:00:00`` and a closed one ends one second before its successor.
Parquet has no UPDATE/MERGE, so "close and append" is a join and a union; at scale the
closed versions are never rewritten (they are not read by the plans here), only the open
ones and the delta.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabwh.constants import LEAD_DEFAULT, OPEN_END
from cabwh.functions.time import add_seconds, ts_lit


def open_end() -> Column:
    return ts_lit(OPEN_END)


def _differs_sql(a: Column, b: Column) -> Column:
    """SQL ``a != b``: NULL on either side never counts as a difference."""
    return F.coalesce(a != b, F.lit(False))


def scd2_apply(dim: DataFrame, delta: DataFrame, key: str | Sequence[str], tracked: str | Sequence[str],
               start: str = "start_dt", end: str = "end_dt", mode: str = "strict") -> DataFrame:
    """The dimension after applying ``delta`` (rows with the dimension's columns, ``end`` = open).

    ``mode="parity"``: as the original load: an open version is closed at (earliest
    differing delta start - 1 s) when a delta row of its key differs in a tracked column
    (SQL ``!=``, NULL never differs), and every delta row is appended as an open version.

    ``mode="strict"``: a delta row is appended only if a tracked column differs null-safely
    from the version before it; versions of a key are chained so that each ends one second
    before the next starts. Delta rows not newer than the open version are ignored, so
    re-applying the same delta changes nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    tracked = [tracked] if isinstance(tracked, str) else list(tracked)
    cols = dim.columns
    delta = delta.select(*cols)
    is_open = F.col(end) == open_end()
    closed = dim.filter(~is_open)
    opened = dim.filter(is_open)

    if mode == "parity":
        d = delta.select(*keys, *[F.col(t).alias(f"_d_{t}") for t in tracked], F.col(start).alias("_d_start"))
        differs = F.lit(False)
        for t in tracked:
            differs = differs | _differs_sql(F.col(f"_d_{t}"), F.col(t))
        close_at = (
            opened.select(*keys, start, *tracked)
            .join(d, keys, "inner")
            .filter(differs)
            .groupBy(*keys, start)
            .agg(F.min("_d_start").alias("_close"))
        )
        updated = (
            opened.join(close_at, [*keys, start], "left")
            .withColumn(end, F.when(F.col("_close").isNotNull(), add_seconds(F.col("_close"), -1))
                        .otherwise(F.col(end)))
            .select(*cols)
        )
        # a delta with several versions of a key (client cards) brings their ends; only the last one is open
        return closed.unionByName(updated).unionByName(delta.withColumn(end, F.coalesce(F.col(end), open_end())))

    if mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    # a NULL key identifies nothing: such rows are never chained, only kept / appended
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    passthrough = opened.filter(null_key).unionByName(delta.filter(null_key).withColumn(end, open_end()))
    seq = (opened.filter(~null_key).withColumn("_src", F.lit(0))
           .unionByName(delta.filter(~null_key).withColumn("_src", F.lit(1))))
    w = Window.partitionBy(*keys).orderBy(F.col(start), F.col("_src"), *[F.col(t) for t in tracked])
    # delta rows not newer than the open version are already part of the history (a
    # re-run) or would rewrite closed versions: they are not applied
    open_start = F.max(F.when(F.col("_src") == 0, F.col(start))).over(Window.partitionBy(*keys))
    seq = (seq.withColumn("_open_start", open_start)
           .filter((F.col("_src") == 0) | F.col("_open_start").isNull() | (F.col(start) > F.col("_open_start")))
           .drop("_open_start"))
    same_as_prev = F.lit(True)
    for t in tracked:
        same_as_prev = same_as_prev & F.col(t).eqNullSafe(F.lag(t).over(w))
    kept = (
        seq.withColumn("_pos", F.row_number().over(w))
        .withColumn("_same", same_as_prev)
        .filter((F.col("_pos") == 1) | ~F.col("_same"))
        .withColumn(end, F.coalesce(add_seconds(F.lead(start).over(w), -1), open_end()))
        .select(*cols)
    )
    return closed.unionByName(passthrough).unionByName(kept)


def versions_from_history(history: DataFrame, key: str, attr: str, ts: str, watermark: Column | None = None,
                          key_out: str | None = None, attr_out: str | None = None,
                          start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """Versions from a fact history: each (key, attr) pair starts when first seen.

    ``end = LEAD(start, 1, 9999-01-01 00:00:01) OVER (PARTITION BY key ORDER BY start) - 1 s``.
    As in the original load the LEAD runs after the watermark filter (it sees only the
    new pairs); closing the previously open version is the job of :func:`scd2_apply`.
    A pair seen again later (A -> B -> A) does not start a new version.

    Rows without a key are one chain, as in SQL, but not one task: they are ordered day by day, and a day's last row
    ends where the next day that has rows begins.
    """
    first = history.groupBy(key, attr).agg(F.min(ts).alias(start))
    if watermark is not None:
        first = first.filter(F.col(start) > watermark)
    day = F.when(F.col(key).isNull(), F.to_date(start))
    first = first.withColumn("_day", day)
    days = (first.filter(F.col(key).isNull()).groupBy("_day").agg(F.min(start).alias("_first"))
            .select("_day", F.lead("_first").over(Window.orderBy("_day")).alias("_next_day")))   # one row per day
    first = first.join(F.broadcast(days), "_day", "left")     # as many rows as there are days
    w = Window.partitionBy(key, "_day").orderBy(start)
    nxt = F.coalesce(F.lead(start).over(w), F.col("_next_day"), ts_lit(LEAD_DEFAULT))
    return first.select(
        F.col(key).alias(key_out or key),
        F.col(start),
        F.col(attr).alias(attr_out or attr),
        add_seconds(nxt, -1).alias(end),
    )


def versions_on_change(history: DataFrame, key: str, attr: str, ts: str, tiebreak: str,
                       key_out: str | None = None, start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """Versions that start at every change of ``attr`` in time order (A -> B -> A gives three).

    The previous value per key comes from a lag split by (key, day) (see ``split_lag``), so
    one key with a huge history is not one task; the change rows (few per key) are then
    chained with ``LEAD - 1 s`` like :func:`versions_from_history`.
    """
    from cabwh.operators.windows import split_lag

    rows = history.select(key, attr, ts, tiebreak)
    prev = split_lag(rows, key, ts, tiebreak, "_prev", value=attr)
    starts = prev.filter(F.col("_prev").isNull() | ~F.col(attr).eqNullSafe(F.col("_prev")))
    w = Window.partitionBy(key).orderBy(F.col(ts), F.col(tiebreak))
    nxt = F.coalesce(F.lead(ts).over(w), ts_lit(LEAD_DEFAULT))
    return starts.select(F.col(key).alias(key_out or key), F.col(ts).alias(start), F.col(attr),
                         add_seconds(nxt, -1).alias(end))


def as_of(dim: DataFrame, when, start: str = "start_dt", end: str = "end_dt") -> DataFrame:
    """Versions valid at ``when`` (a date compares as its midnight), both bounds inclusive."""
    point = when if isinstance(when, Column) else ts_lit(when)
    return dim.filter(point.between(F.col(start), F.col(end)))
