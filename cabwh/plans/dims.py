"""Dimension loads (C12-C15): cars, drivers, clients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabwh.functions import personnel_key, trim_plate
from cabwh.operators.scd2 import open_end, scd2_apply, versions_from_history
from cabwh.operators.writes import dedupe_keep_last

CARS_COLUMNS = ["plate_num", "start_dt", "model_name", "revision_dt", "end_dt"]
DRIVERS_COLUMNS = ["personnel_num", "start_dt", "last_name", "first_name", "middle_name", "birth_dt", "card_num",
                   "driver_license_num", "driver_license_dt", "end_dt"]
CLIENTS_COLUMNS = ["phone_num", "start_dt", "card_num", "end_dt", "deleted_flag"]


def _since(df: DataFrame, col: str, watermark: Column | None) -> DataFrame:
    return df if watermark is None else df.filter(F.col(col) > watermark)


def cars_delta(car_pool: DataFrame, watermark: Column | None = None) -> DataFrame:
    return _since(car_pool, "update_dt", watermark).select(
        trim_plate("plate_num").alias("plate_num"),
        F.col("update_dt").alias("start_dt"),
        F.col("model").alias("model_name"),
        "revision_dt",
        open_end().alias("end_dt"),
    )


def drivers_delta(drivers: DataFrame, watermark: Column | None = None) -> DataFrame:
    return _since(drivers, "update_dt", watermark).select(
        personnel_key().alias("personnel_num"),
        F.col("update_dt").alias("start_dt"),
        "last_name", "first_name", "middle_name", "birth_dt", "card_num",
        F.col("driver_license").alias("driver_license_num"),
        F.col("driver_valid_to").alias("driver_license_dt"),
        open_end().alias("end_dt"),
    )


def clients_delta(rides: DataFrame, watermark: Column | None = None) -> DataFrame:
    v = versions_from_history(rides, "client_phone", "card_num", "dt", watermark, key_out="phone_num")
    return v.withColumn("deleted_flag", F.lit(False))


def apply_cars(dim: DataFrame | None, delta: DataFrame, mode: str = "strict") -> DataFrame:
    if dim is None:
        return delta.select(*CARS_COLUMNS)
    return scd2_apply(dim, delta, "plate_num", "revision_dt", mode=mode)


def apply_drivers(dim: DataFrame | None, delta: DataFrame, mode: str = "strict") -> DataFrame:
    if dim is None:
        return delta.select(*DRIVERS_COLUMNS)
    return scd2_apply(dim, delta, "personnel_num", "card_num", mode=mode)


def apply_clients(dim: DataFrame | None, delta: DataFrame, mode: str = "parity") -> DataFrame:
    """Close-and-append on card_num, then keep the last loaded of rows equal on (phone, start)."""
    if dim is None:
        return delta.select(*CLIENTS_COLUMNS)
    merged = scd2_apply(dim.withColumn("_seq", F.lit(0)), delta.withColumn("_seq", F.lit(1)),
                        "phone_num", "card_num", mode=mode)
    return dedupe_keep_last(merged, ["phone_num", "start_dt"], "_seq").select(*CLIENTS_COLUMNS)
