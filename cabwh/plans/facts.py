"""Fact tables (C5-C10): rides, waybills, payments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabwh.constants import EVENT_BEGIN, EVENT_CANCEL, EVENT_END, EVENT_READY
from cabwh.functions import parse_dayfirst, personnel_key, transaction_key, trim_plate
from cabwh.operators.lookup import point_in_time_lookup
from cabwh.operators.pivot import pivot_columns

TIMES = {EVENT_READY: "ride_arrival_dt", EVENT_BEGIN: "ride_start_dt", EVENT_END: "_end_dt", EVENT_CANCEL: "_cancel_dt"}

FACT_RIDES_COLUMNS = ["ride_id", "point_from_txt", "point_to_txt", "distance_val", "price_amt", "client_phone_num",
                      "driver_pers_num", "car_plate_num", "ride_arrival_dt", "ride_start_dt", "ride_end_dt"]


def ride_times(movement: DataFrame) -> DataFrame:
    """One row per ride with arrival / start / end times; END falls back to CANCEL."""
    wide = movement.groupBy("ride").agg(*pivot_columns("event", "dt", TIMES))
    return wide.select("ride", "ride_arrival_dt", "ride_start_dt",
                       F.coalesce("_end_dt", "_cancel_dt").alias("ride_end_dt"))


def finished_rides(movement: DataFrame, rides: DataFrame) -> DataFrame:
    """Rides with a terminal event (END or CANCEL) whose header is in ``rides``.

    One aggregation over the events gives the times *and* the plate of the terminal event
    (END wins over CANCEL, then the latest), replacing the original's self-join of the
    terminal rows with the pivot. The header join is inner: a ride whose header is outside
    the extract is dropped here (and retried by the next load's look-back).
    """
    terminal = F.col("event").isin(EVENT_END, EVENT_CANCEL)
    prio = F.when(terminal, F.struct((F.col("event") == EVENT_END).alias("_is_end"), F.col("dt"), F.col("movement_id")))
    times = movement.groupBy("ride").agg(
        *pivot_columns("event", "dt", TIMES),
        F.max_by(trim_plate("car_plate_num"), prio).alias("car_plate_num"),
    ).filter(F.col("_end_dt").isNotNull() | F.col("_cancel_dt").isNotNull())
    hdr = rides.filter(F.col("client_phone").isNotNull())
    return times.join(hdr, times.ride == hdr.ride_id, "inner").select(
        "ride_id", "dt",
        F.col("point_from").alias("point_from_txt"),
        F.col("point_to").alias("point_to_txt"),
        F.col("distance").alias("distance_val"),
        F.col("price").alias("price_amt"),
        F.col("client_phone").alias("client_phone_num"),
        "car_plate_num", "ride_arrival_dt", "ride_start_dt",
        F.coalesce("_end_dt", "_cancel_dt").alias("ride_end_dt"),
    )


def keyed_drivers(drivers: DataFrame) -> DataFrame:
    return drivers.withColumn("personnel_num", personnel_key())


def build_fact_waybills(waybills: DataFrame, drivers: DataFrame, parity_dropna: bool = False) -> DataFrame:
    """Licence -> personnel number; rows with a NULL in the output (or, with
    ``parity_dropna``, in any joined column) are dropped."""
    d = keyed_drivers(drivers).select("personnel_num", "driver_license")
    j = waybills.join(d, waybills.license == d.driver_license, "left")
    out_cols = {"number": "waybill_num", "personnel_num": "driver_pers_num", "car": "car_plate_num",
                "start": "work_start_dt", "stop": "work_end_dt", "issuedt": "issue_dt"}
    j = j.dropna(how="any") if parity_dropna else j.dropna(how="any", subset=list(out_cols))
    return j.select(*[F.col(a).alias(b) for a, b in out_cols.items()])


def ride_driver_lookup(finished: DataFrame, fact_waybills: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Driver of each finished ride = first waybill of the car containing the order time.

    The order times of the ``headers`` (a one-column scan) bound the span waybills are cut to."""
    return point_in_time_lookup(
        finished, fact_waybills,
        fact_id="ride_id", fact_key="car_plate_num", fact_ts="dt",
        iv_key="car_plate_num", iv_start="work_start_dt", iv_end="work_end_dt",
        order=["work_start_dt", "waybill_num"], take=["waybill_num", "driver_pers_num"],
        times=headers,
    )


@dataclass
class FactRides:
    rides: DataFrame        # with a driver
    quarantine: DataFrame   # no waybill matched: retried by the next load
    looked: DataFrame       # every finished ride with its lookup result (both of the above)


def split_lookup(looked: DataFrame) -> FactRides:
    """Matched rides (fact rows) and unmatched ones (quarantine) of one lookup result."""
    matched = looked.filter(F.col("driver_pers_num").isNotNull()).select(*FACT_RIDES_COLUMNS)
    unmatched = looked.filter(F.col("driver_pers_num").isNull()).select("ride_id", "car_plate_num", "dt")
    return FactRides(matched, unmatched, looked)


def build_fact_rides(movement: DataFrame, rides: DataFrame, fact_waybills: DataFrame,
                     where: Column | None = None) -> FactRides:
    """C8 = C5 -> C6 -> C7 -> projection; unmatched rides go to quarantine instead of aborting.

    ``where`` restricts the finished rides *before* the lookup (e.g. to rides that ended on
    a report day). The ranking of C7 is per ride, so this equals filtering the result, but
    Catalyst cannot push a filter on a non-partition column through that window itself.
    """
    finished = finished_rides(movement, rides)
    if where is not None:
        finished = finished.filter(where)
    return split_lookup(ride_driver_lookup(finished, fact_waybills, rides))


def build_fact_payments(payments: DataFrame) -> DataFrame:
    """md5 key over the raw text, then the parsed day-first timestamp."""
    return payments.select(
        transaction_key("transaction_dt", "card_num").alias("transaction_id"),
        parse_dayfirst("transaction_dt").alias("transaction_dt"),
        F.col("card_num").cast("string").alias("card_num"),
        F.col("transaction_amt").cast("decimal(18,2)").alias("transaction_amt"),
    )
