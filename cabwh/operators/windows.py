"""Window operators that stay split when one key holds a large share of the rows.

A window ``PARTITION BY key`` sends every row of a key to one task. For running counts
and sliding sums over time the work can instead be split by (key, time bucket): each
bucket is processed on its own and the contribution of earlier buckets is added from a
small per-(key, bucket) summary table (the classic two-level prefix sum).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabwh.functions.time import epoch_micros

_HOUR_US = 3600 * 1_000_000


def running_index(df: DataFrame, key: str, chunk: str, order: str, out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY chunk, order) - 1`` computed per (key, chunk).

    A window over (key, chunk) gives the local number. A chunk's last row tells how many rows it has; the offset of
    (key, chunk) is their sum over the key's earlier chunks (one row per chunk), joined back on (key, chunk), the
    partitioning the local window has already. The last row is taken whole, so that both sides of that join need the
    same columns of the input and share one shuffle of it: the input is evaluated once. Rows without key or chunk vanish.
    """
    # said here, or the join would say it of one side only
    df = df.filter(F.col(key).isNotNull() & F.col(chunk).isNotNull())
    local = df.withColumn("_i", F.row_number().over(Window.partitionBy(key, chunk).orderBy(order)) - 1)
    rest = [c for c in df.columns if c not in (key, chunk)]
    last = local.groupBy(key, chunk).agg(F.max(F.struct("_i", *rest)).alias("_last"))
    before = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = last.select(key, chunk, F.coalesce(F.sum(F.col("_last._i") + 1).over(before), F.lit(0)).alias("_off"))
    return (local.join(offsets, [key, chunk], "inner")
            .withColumn(out, (F.col("_i") + F.col("_off")).cast("bigint")).drop("_i", "_off"))


def sliding_sum_simple(df: DataFrame, key: str, ts: str, value: Column | str, span_us: int, out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key ORDER BY ts RANGE span PRECEDING)``, one window per key."""
    v = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(key).orderBy(epoch_micros(ts)).rangeBetween(-span_us, 0)
    return df.withColumn(out, F.sum(v).over(w).cast("bigint"))


def sliding_sum(df: DataFrame, key: str, ts: str, value: Column | str, span_us: int, out: str,
                id_col: str | None = None, strategy: str = "halo", bucket_us: int = _HOUR_US) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key ORDER BY ts RANGE span PRECEDING)``, split by time bucket.

    ``strategy="halo"`` (default): buckets one span wide; every row goes to its own bucket
    and, as a halo copy, to the next one. The frame [ts - span, ts] of a row in bucket b
    lies in buckets b - 1 and b, which are both in partition (key, b), so one window per
    (key, bucket) is exact; halo rows are dropped afterwards. One shuffle of 2x the rows.
    ``strategy="prefix"``: two-level prefix sums with ``bucket_us`` buckets (see
    :func:`sliding_sum_prefix`), for splits finer than one span.
    """
    if strategy == "prefix":
        return sliding_sum_prefix(df, key, ts, value, span_us, out, bucket_us=bucket_us, id_col=id_col)
    if strategy != "halo":
        raise ValueError(f"unknown strategy {strategy!r}")
    return range_sum(df, key, ts, value, -span_us, 0, out)


def range_sum(df: DataFrame, key: str, ts: str, value: Column | str, lower_us: int, upper_us: int,
              out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN lower AND upper)`` (offsets in
    microseconds, both inclusive), split by (key, bucket) with a halo.

    Buckets are as wide as the farthest offset; the frame of a row in bucket b then lies in
    buckets b - 1 .. b + 1. A row is copied into the neighbouring bucket that needs it: the
    next one when frames look back (lower < 0), the previous one when they look forward
    (upper > 0). One shuffle; only the rows in their own bucket are kept.
    """
    width = max(-lower_us, upper_us, 1)
    v = F.col(value) if isinstance(value, str) else value
    t = epoch_micros(ts)
    shifts = [F.lit(0)]
    if lower_us < 0:
        shifts.append(F.lit(1))
    if upper_us > 0:
        shifts.append(F.lit(-1))
    rows = (df.withColumn("_t", t).withColumn("_v", v.cast("bigint"))
            .withColumn("_own", F.floor(F.col("_t") / F.lit(width)).cast("bigint"))
            .withColumn("_shift", F.explode(F.array(*shifts)))
            .withColumn("_b", F.col("_own") + F.col("_shift")))
    w = Window.partitionBy(key, "_b").orderBy("_t").rangeBetween(lower_us, upper_us)
    return (rows.withColumn(out, F.sum("_v").over(w).cast("bigint"))
            .filter(F.col("_shift") == 0)
            .drop("_t", "_v", "_own", "_shift", "_b"))


def sliding_sum_prefix(df: DataFrame, key: str, ts: str, value: Column | str, span_us: int, out: str,
                       bucket_us: int = _HOUR_US, id_col: str | None = None) -> DataFrame:
    """The same sliding sum, split by (key, time bucket) of any width.

    sum over [ts - span, ts] = P(ts, inclusive) - P(ts - span, exclusive), where P is the
    per-key prefix sum of ``value`` in time order. Each row becomes a data row at ts and a
    probe row at ts - span (value 0). Within (key, bucket) a window gives the local prefix
    sums; the sum of all earlier buckets comes from a per-(key, bucket) total table (one row
    per active hour of a key). The probe's result meets its data row again by ``id_col``.
    No partition holds more than one bucket of one key, and no row is copied per bucket
    (unlike a halo of the whole span).
    """
    if id_col is None:
        raise ValueError("sliding_sum needs a unique row id column")
    v = F.col(value) if isinstance(value, str) else value
    payload = F.struct(*[F.col(c) for c in df.columns])
    base = df.select(F.col(id_col).alias("_id"), F.col(key).alias("_k"), epoch_micros(ts).alias("_t"),
                     v.cast("bigint").alias("_v"), payload.alias("_row"))
    data = base.withColumn("_probe", F.lit(False))
    probe = base.select("_id", "_k", (F.col("_t") - F.lit(span_us)).alias("_t"), F.lit(0).cast("bigint").alias("_v"),
                        F.lit(None).cast(base.schema["_row"].dataType).alias("_row"), F.lit(True).alias("_probe"))
    both = data.unionByName(probe).withColumn("_b", F.floor(F.col("_t") / F.lit(bucket_us)).cast("bigint"))
    # per (key, bucket) totals (probe buckets included, with 0) -> sum of all earlier buckets
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (both.groupBy("_k", "_b").agg(F.sum("_v").alias("_tot"))
               .select("_k", "_b", F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off")))
    wl = Window.partitionBy("_k", "_b").orderBy("_t")
    local = (both.withColumn("_incl", F.sum("_v").over(wl.rangeBetween(Window.unboundedPreceding, 0)))
             .withColumn("_excl", F.coalesce(F.sum("_v").over(wl.rangeBetween(Window.unboundedPreceding, -1)),
                                             F.lit(0)))
             .join(offsets, ["_k", "_b"], "inner"))
    incl = local.filter(~F.col("_probe")).select("_id", "_row", (F.col("_incl") + F.col("_off")).alias("_p_incl"))
    excl = local.filter(F.col("_probe")).select("_id", (F.col("_excl") + F.col("_off")).alias("_p_excl"))
    return incl.join(excl, "_id", "inner").select(
        "_row.*", (F.col("_p_incl") - F.col("_p_excl")).cast("bigint").alias(out))


def split_lag(df: DataFrame, key: str, ts: str, tiebreak: str, out: str, value: str | None = None) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY key ORDER BY ts, tiebreak)`` computed per (key, day).

    ``value`` defaults to ``ts``. Inside a day the window gives the previous row; the first
    row of a day takes the last row's value of the key's nearest earlier day that has rows,
    from a per-(key, day) summary (one row per active day of a key).
    """
    value = value or ts
    local = df.withColumn("_day", F.to_date(ts)).withColumn(
        "_prev_in_day", F.lag(value).over(Window.partitionBy(key, "_day").orderBy(ts, tiebreak)))
    last = (local.groupBy(key, "_day")
            .agg(F.max_by(F.col(value), F.struct(F.col(ts), F.col(tiebreak))).alias("_last"),
                 F.count(F.lit(1)).alias("_n"))
            .withColumn("_prev_day_last", F.lag("_last").over(Window.partitionBy(key).orderBy("_day")))
            .select(key, "_day", "_prev_day_last"))
    first_in_day = F.row_number().over(Window.partitionBy(key, "_day").orderBy(ts, tiebreak)) == 1
    return (local.join(last, [key, "_day"], "inner")
            .withColumn(out, F.when(first_in_day, F.col("_prev_day_last")).otherwise(F.col("_prev_in_day")))
            .drop("_day", "_prev_in_day", "_prev_day_last"))
