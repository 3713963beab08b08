"""Incremental extraction (C1, C2, C23): batch ledger watermark and look-back filters."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabwh.constants import NO_WATERMARK, STATUS_SUCCESS
from cabwh.functions.time import add_seconds, ts_lit

LEDGER_SCHEMA = T.StructType([
    T.StructField("loaded_until", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), True),
])


def last_success_df(ledger: DataFrame) -> DataFrame:
    """C1 as a one-row frame: newest ``loaded_until`` of a successful batch, else 1900-01-01."""
    return ledger.filter(F.col("status") == STATUS_SUCCESS).agg(
        F.coalesce(F.max("loaded_until"), ts_lit(NO_WATERMARK)).alias("watermark"))


def last_success(ledger: DataFrame) -> _dt.datetime:
    """C1 as a driver-side scalar (the ledger is one row per run; the aggregate is one row)."""
    return last_success_df(ledger).first()["watermark"]


def extract_since(df: DataFrame, ts_col: str, watermark, lookback_hours: int = 0) -> DataFrame:
    """Rows strictly newer than ``watermark - lookback``.

    ``watermark`` is a literal (datetime / text) so the predicate reaches the Parquet or
    JDBC scan as a pushed filter; a Column works too.
    """
    wm: Column = watermark if isinstance(watermark, Column) else ts_lit(watermark)
    if lookback_hours:
        wm = add_seconds(wm, -lookback_hours * 3600)
    return df.filter(F.col(ts_col) > wm)


def record_batch(spark: SparkSession, ledger: DataFrame | None, started_at, status: str) -> DataFrame:
    """The ledger with one more run. The *start* time is stored, so rows that arrive
    while a run is in progress are picked up by the next one."""
    if isinstance(started_at, str):
        started_at = _dt.datetime.fromisoformat(started_at)
    row = spark.createDataFrame([(started_at, status)], LEDGER_SCHEMA)
    return row if ledger is None else ledger.select("loaded_until", "status").unionByName(row)
