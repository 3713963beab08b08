"""Write algebra on DataFrames: insert-ignore (C11), upsert (C21), keep-last de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order`` (deterministic, unlike ``dropDuplicates``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def one_per_key(df: DataFrame, keys: Sequence[str], first_by: Sequence[str] | None = None,
                last: bool = False) -> DataFrame:
    """One row per key: the smallest (or, ``last=True``, the largest) by ``first_by`` then by
    the remaining columns, as an aggregation: ``min``/``max`` of a struct is combined on the
    map side, so a key repeated a million times ships one row per map partition instead of
    being sorted in one task as a window would."""
    keys = list(keys)
    lead = [c for c in (first_by or []) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    packed = F.struct(*[F.col(c) for c in lead + rest])
    agg = F.max(packed) if last else F.min(packed)
    return df.groupBy(*keys).agg(agg.alias("_row")).select(*keys, *[F.col(f"_row.{c}") for c in lead + rest]) \
        .select(*df.columns)


def insert_ignore(target: DataFrame, delta: DataFrame, keys: Sequence[str],
                  order: Sequence[Column | str] | None = None) -> DataFrame:
    """The rows of ``delta`` whose key is not yet in ``target`` (one per key).

    The result is what gets *appended*; existing rows are never touched. Only the key
    columns of ``target`` are read (the anti-join prunes the rest at the scan).
    """
    # a key repeated inside the delta keeps one row chosen by an explicit order, never by
    # arrival order (dropDuplicates would keep an arbitrary one); by default the smallest row
    d = first_per_key(delta, keys, list(order)) if order else one_per_key(delta, keys)
    return d.join(target.select(*keys), list(keys), "left_anti")


def insert_ignore_result(target: DataFrame, delta: DataFrame, keys: Sequence[str],
                         order: Sequence[Column | str] | None = None) -> DataFrame:
    """``target`` after the insert-ignore: target ∪ new rows."""
    return target.unionByName(insert_ignore(target, delta, keys, order))


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols = EXCLUDED.update_cols.

    New keys are inserted whole; for existing keys only ``update_cols`` take the delta's
    value, all other columns keep the target's. One full outer join by key: each input is read
    and shuffled once, and keys are unique on both sides, so no key is hot. As in SQL, a NULL
    key conflicts with nothing: such rows of both sides stay.
    """
    keys = list(keys)

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{mark}{c}") for c in target.columns], F.lit(True).alias(f"{mark}in"))

    j = side(target, "_t_").join(side(delta, "_d_"), [F.col(f"_t_{k}") == F.col(f"_d_{k}") for k in keys], "full")

    def value(c: str) -> Column:
        first, other, given = ("_d_", "_t_", "_d_in") if c in update_cols else ("_t_", "_d_", "_t_in")
        return F.when(F.col(given), F.col(first + c)).otherwise(F.col(other + c)).alias(c)

    return j.select(*[value(c) for c in target.columns])


def dedupe_keep_last(df: DataFrame, keys: Sequence[str], load_order: str) -> DataFrame:
    """Of rows equal on ``keys`` keep the one loaded last (highest ``load_order``; equal loads:
    the largest row), combined map-side like :func:`one_per_key`."""
    return one_per_key(df, keys, [load_order], last=True)
