"""The four reports (C17-C20)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabwh.constants import COST_PER_KM, DRIVER_SHARE, OVERTIME_LIMIT_S, OVERTIME_SPAN_S
from cabwh.functions import (
    add_seconds,
    client_key,
    day_bounds,
    epoch_seconds,
    format_card,
    seconds_between,
    speed_hundredths,
    speed_over_limit,
    ts_lit,
)
from cabwh.operators.lookup import bucket, explode_buckets, interval_join
from cabwh.operators.scd2 import as_of
from cabwh.operators.windows import range_sum, running_index, sliding_sum, split_lag
from cabwh.session import stored


def _day(report_dt) -> _dt.date:
    return report_dt if isinstance(report_dt, _dt.date) else _dt.date.fromisoformat(str(report_dt))


def ended_on(df: DataFrame, col: str, report_dt) -> DataFrame:
    lo, hi = day_bounds(_day(report_dt))
    return df.filter((F.col(col) >= lo) & (F.col(col) < hi))


# --- C17 driver payouts -------------------------------------------------------------------

def payout_amount(price_sum, distance_sum):
    """round(0.8 * price - 47.26 * 7 / 100 * distance - 5 * distance, 2), exact in decimals."""
    return F.round(F.col(price_sum) * F.lit(DRIVER_SHARE) - F.col(distance_sum) * F.lit(COST_PER_KM), 2) \
        .cast("decimal(18,2)")


def driver_day_totals(fact_rides: DataFrame, report_dt=None) -> DataFrame:
    """A2: per (driver, end date) distance, cash and payout for rides that started."""
    src = fact_rides.filter(F.col("ride_start_dt").isNotNull())
    if report_dt is not None:
        src = ended_on(src, "ride_end_dt", report_dt)
    return (
        src.groupBy("driver_pers_num", F.to_date("ride_end_dt").alias("report_dt"))
        .agg(F.sum("distance_val").cast("decimal(18,2)").alias("total_distance"),
             F.sum("price_amt").cast("decimal(18,2)").alias("total_cash"))
        .withColumn("amount", payout_amount("total_cash", "total_distance"))
    )


def drivers_payments(fact_rides: DataFrame, dim_drivers: DataFrame, report_dt, version_at: str = "start") -> DataFrame:
    """rep_drivers_payments for one day: payout per driver joined to the driver version valid at
    the start of the day (as the original report; a driver registered during the day gets no
    row) or, with ``version_at="end"``, at its last second."""
    day = _day(report_dt)
    fr = driver_day_totals(fact_rides, day)
    point = ts_lit(day) if version_at == "start" else add_seconds(ts_lit(day + _dt.timedelta(days=1)), -1)
    dd = as_of(dim_drivers, point).select("personnel_num", "last_name", "first_name", "middle_name", "card_num")
    return fr.join(dd, fr.driver_pers_num == dd.personnel_num, "inner").select(
        "personnel_num", "last_name", "first_name", "middle_name", "card_num", "amount",
        F.lit(day).alias("report_dt"))


# --- C18 speeding ---------------------------------------------------------------------------

def violations(fact_rides: DataFrame, report_dt=None) -> DataFrame:
    """Rides that started and whose rounded average speed exceeds the limit."""
    src = fact_rides.filter(F.col("ride_start_dt").isNotNull())
    if report_dt is not None:
        src = ended_on(src, "ride_end_dt", report_dt)
    sec = seconds_between("ride_start_dt", "ride_end_dt")
    return src.filter(speed_over_limit(F.col("distance_val"), sec)).select(
        F.col("driver_pers_num").alias("personnel_num"),
        F.col("ride_id").alias("ride"),
        speed_hundredths(F.col("distance_val"), sec).alias("speed"),
        F.to_date("ride_end_dt").alias("report_dt"),
    )


RIDE_CHUNK = 1 << 20  # ride ids per chunk of the split numbering


def day_violation_counts(fact_rides: DataFrame, report_dt) -> DataFrame:
    """The day's violations numbered per driver by ride id, from 0.

    ``ROW_NUMBER() OVER (PARTITION BY driver ORDER BY ride) - 1``, split by ride-id chunk
    (ordering by (chunk, ride) is ordering by ride), so a driver with a huge day is not
    numbered in one task.
    """
    v = violations(fact_rides, report_dt).withColumn("_chunk", F.floor(F.col("ride") / RIDE_CHUNK))
    return running_index(v, "personnel_num", "_chunk", "ride", "violations_cnt").drop("_chunk")


def prior_violations(prior: DataFrame, report_dt) -> DataFrame:
    """A3: per driver max(count) + 1 over report rows of earlier days (never the day being written)."""
    return (prior.filter(F.col("report_dt") < F.lit(_day(report_dt)))
            .groupBy("personnel_num").agg((F.max("violations_cnt") + 1).cast("bigint").alias("prior_cnt")))


def drivers_violations(fact_rides: DataFrame, prior: DataFrame | None, report_dt) -> DataFrame:
    """rep_drivers_violations for one day: day count carried over from the prior report rows."""
    day = day_violation_counts(fact_rides, report_dt)
    if prior is None:  # the first report ever
        return day.select("personnel_num", "ride", "speed", "violations_cnt", "report_dt")
    q2 = prior_violations(prior, report_dt)
    return day.join(q2, "personnel_num", "left").select(
        "personnel_num", "ride", "speed",
        F.coalesce(F.col("violations_cnt") + F.col("prior_cnt"), F.col("violations_cnt")).alias("violations_cnt"),
        "report_dt")


def _numbered_violations(v: DataFrame) -> DataFrame:
    """``v`` with the number of the driver's earlier rows of it in (end date, ride id) order.

    Numbered per (driver, day, ride-id range) and offset by the driver's earlier chunks, so a
    driver with a huge history (or a huge day) is split instead of sorted in one task; the
    chunk order (day, range) is the (day, ride) order.
    """
    v = v.withColumn("_chunk", F.struct(F.col("report_dt"), F.floor(F.col("ride") / RIDE_CHUNK).alias("r")))
    return running_index(v, "personnel_num", "_chunk", "ride", "violations_cnt").select(
        "personnel_num", "ride", "speed", "violations_cnt", "report_dt")


def drivers_violations_full(fact_rides: DataFrame) -> DataFrame:
    """All days at once: count of earlier violations per driver in (end date, ride id) order."""
    return _numbered_violations(violations(fact_rides))


def drivers_violations_from(fact_rides: DataFrame, state: DataFrame | None, first: _dt.date | None,
                            last: _dt.date) -> DataFrame:
    """The days ``first`` (None: all before) to ``last``, counted on from ``state`` (personnel_num, violations): each
    driver's number of violations before ``first``."""
    rows = fact_rides.filter(F.col("ride_end_dt") < ts_lit(last + _dt.timedelta(days=1)))
    if first is not None:
        rows = rows.filter(F.col("ride_end_dt") >= ts_lit(first))
    rows = _numbered_violations(violations(rows))
    if state is None:
        return rows
    return rows.join(state, "personnel_num", "left").select(
        "personnel_num", "ride", "speed",
        (F.col("violations_cnt") + F.coalesce("violations", F.lit(0))).cast("bigint").alias("violations_cnt"),
        "report_dt")


# --- C19 overtime -----------------------------------------------------------------------------

def shifts_since(fact_waybills: DataFrame, report_dt) -> DataFrame:
    lo, _ = day_bounds(_day(report_dt))
    return fact_waybills.filter(F.col("work_start_dt") >= lo).select(
        "waybill_num", "driver_pers_num", "work_start_dt", "work_end_dt",
        seconds_between("work_start_dt", "work_end_dt").alias("work_s"),
        epoch_seconds("work_start_dt").alias("_start_s"))


def shift_windows(shifts: DataFrame, split: bool = True) -> DataFrame:
    """W3 + W4: 24 h sliding work sum (peers included) and the previous shift start per driver.

    ``split=True`` computes both per (driver, time bucket) with ``sliding_sum`` and
    ``split_lag`` (a driver with a huge history is not one task); ``split=False`` is the
    plain ``PARTITION BY driver`` window of the same definition.
    """
    if split:
        summed = sliding_sum(shifts, "driver_pers_num", "work_start_dt", "work_s", OVERTIME_SPAN_S * 1_000_000,
                             "cum_work_s", id_col="waybill_num")
        return split_lag(summed, "driver_pers_num", "work_start_dt", "waybill_num", "prev_start")
    by_driver = Window.partitionBy("driver_pers_num")
    span = by_driver.orderBy("_start_s").rangeBetween(-OVERTIME_SPAN_S, 0)
    seq = by_driver.orderBy("work_start_dt", "waybill_num")
    return (shifts.withColumn("cum_work_s", F.sum("work_s").over(span).cast("bigint"))
            .withColumn("prev_start", F.lag("work_start_dt").over(seq)))


def drivers_overtime(fact_waybills: DataFrame, report_dt) -> DataFrame:
    """rep_drivers_overtime, parity formula: the period start is the previous shift."""
    day = _day(report_dt)
    lo, hi = day_bounds(day)
    w = shift_windows(shifts_since(fact_waybills, day))
    delta = epoch_seconds("prev_start") + F.lit(OVERTIME_SPAN_S) - F.col("_start_s")
    total = F.when(F.col("work_s") > delta, F.col("cum_work_s") - F.col("work_s") + delta).otherwise(F.col("cum_work_s"))
    return (w.withColumn("total_work_time", total.cast("bigint"))
            .filter((F.col("total_work_time") > OVERTIME_LIMIT_S) & (F.col("prev_start") >= lo) & (F.col("prev_start") < hi))
            .select(F.col("driver_pers_num").alias("personnel_num"), "total_work_time",
                    F.col("prev_start").alias("period_start"), F.lit(day).alias("report_dt")))


def drivers_overtime_clipped(fact_waybills: DataFrame, report_dt) -> DataFrame:
    """Corrected overtime: for each shift i starting on the day, the work done in [start_i, start_i + 24 h).

    total_i = sum over shifts j with start_i <= start_j < T_i (T_i = start_i + 24 h) of
    min(end_j, T_i) - start_j = work_j - max(0, end_j - T_i), so

    * A_i = sum of work_j over the forward frame [start_i, T_i): a split RANGE window, and
    * B_i = sum of (end_j - T_i) over the shifts that are still open at T_i
      (start_i <= start_j < T_i < end_j): an interval-containment join on (driver, day of T_i)
      like the waybill lookup, whose pairs are bounded by how many shifts of a driver are
      open at one instant, not by how many fall into a day.

    No pair of shifts inside a 24 h window is ever materialised.
    """
    day = _day(report_dt)
    lo, hi = day_bounds(day)
    span_us = OVERTIME_SPAN_S * 1_000_000
    # every shift that can fall into the 24 h after a shift starting on the day
    cand = (fact_waybills.filter((F.col("work_start_dt") >= lo) & (F.col("work_start_dt") < ts_lit(day + _dt.timedelta(days=2))))
            .select("waybill_num", "driver_pers_num", "work_start_dt", "work_end_dt",
                    seconds_between("work_start_dt", "work_end_dt").alias("work_s")))
    a = range_sum(cand, "driver_pers_num", "work_start_dt", "work_s", 0, span_us - 1, "_a") \
        .filter((F.col("work_start_dt") >= lo) & (F.col("work_start_dt") < hi))
    a = a.withColumn("_limit", add_seconds(F.col("work_start_dt"), OVERTIME_SPAN_S))
    day_s = 24 * 3600
    open_at = explode_buckets(cand.select(F.col("driver_pers_num").alias("_drv"), F.col("work_start_dt").alias("_s"),
                                       F.col("work_end_dt").alias("_e")), "_s", "_e", "_day", day_s,
                              ts_lit(day + _dt.timedelta(days=1)), ts_lit(day + _dt.timedelta(days=2)))
    straddle = (a.select("waybill_num", "driver_pers_num", "work_start_dt", "_limit",
                         bucket(F.col("_limit"), day_s).alias("_lday"))
                .join(open_at, (F.col("driver_pers_num") == F.col("_drv")) & (F.col("_lday") == F.col("_day"))
                      & (F.col("_s") >= F.col("work_start_dt")) & (F.col("_s") < F.col("_limit"))
                      & (F.col("_e") > F.col("_limit")))
                .groupBy("waybill_num", "driver_pers_num")
                .agg(F.sum(seconds_between(F.col("_limit"), F.col("_e"))).alias("_b")))
    total = (F.col("_a") - F.coalesce(F.col("_b"), F.lit(0))).cast("bigint")
    return (a.join(straddle, ["waybill_num", "driver_pers_num"], "left")
            .withColumn("total_work_time", total)
            .filter(F.col("total_work_time") > OVERTIME_LIMIT_S)
            .select(F.col("driver_pers_num").alias("personnel_num"), "total_work_time",
                    F.col("work_start_dt").alias("period_start"), F.lit(day).alias("report_dt")))


#: What a later report changes in a row of the client history.
HISTORY_UPDATE_COLS = ["rides_cnt", "cancelled_cnt", "spent_amt", "debt_amt", "end_dt", "deleted_flag"]


# --- C20 client history -------------------------------------------------------------------------

def paid_by_card(fact_payments: DataFrame) -> DataFrame:
    """A4: all-time paid amount per card, card formatted to four groups after grouping."""
    return (fact_payments.groupBy("card_num").agg(F.sum("transaction_amt").cast("decimal(18,2)").alias("paid_amt"))
            .select(format_card("card_num").alias("card_num"), "paid_amt"))


#: What the client history reads of the fact rides.
CLIENT_RIDE_COLS = ["ride_id", "client_phone_num", "ride_arrival_dt", "ride_start_dt", "price_amt"]


def rides_by_client_card(fact_rides: DataFrame, dim_clients: DataFrame, half_open: bool = False) -> DataFrame:
    """A5 over J8: rides of a phone counted for the card version valid at arrival time (``fact_rides`` is read twice)."""
    dc = dim_clients.select(F.col("phone_num").alias("_phone"), F.col("start_dt").alias("_start"),
                            F.col("end_dt").alias("_end"), F.col("card_num"))
    j = interval_join(fact_rides.select(*CLIENT_RIDE_COLS), dc, "client_phone_num", "ride_arrival_dt",
                      "_phone", "_start", "_end", half_open=half_open)
    cancelled = F.col("ride_start_dt").isNull()
    return j.groupBy("client_phone_num", "card_num").agg(
        F.count("ride_id").alias("total_rides_cnt"),
        F.count(F.when(cancelled, F.lit(1))).alias("cancelled_cnt"),
        F.sum(F.when(~cancelled, F.col("price_amt"))).cast("decimal(18,2)").alias("total_amt"),
    )


def restrict_to_phones(affected: DataFrame, dim_clients: DataFrame, fact_payments: DataFrame,
                       fact_rides: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The inputs of the client history for the phones in ``affected`` (column ``phone_num``) only.

    Semi-joins keep the plans' shapes: the versions of those phones, their rides, and all
    payments of any card one of those versions uses (a card shared with another phone
    brings that card's whole payment sum, as in the full report).
    """
    a = affected.select("phone_num").distinct()
    dc = dim_clients.join(a, "phone_num", "left_semi")
    fr = fact_rides.join(a.withColumnRenamed("phone_num", "client_phone_num"), "client_phone_num", "left_semi")
    cards = dc.select(F.col("card_num").alias("_card")).distinct()
    fp = fact_payments.join(cards, format_card("card_num") == F.col("_card"), "left_semi")
    return dc, fp, fr


def affected_phones(dim_clients: DataFrame, new_versions: DataFrame, new_rides: DataFrame,
                    new_payments: DataFrame) -> DataFrame:
    """Phones whose history rows can change in a batch: new versions, new fact rides, or a new
    payment on a card one of their versions uses."""
    by_card = (dim_clients.select("phone_num", "card_num")
               .join(new_payments.select(format_card("card_num").alias("_card")).distinct(),
                     F.col("card_num") == F.col("_card"), "left_semi")
               .select("phone_num"))
    return (new_versions.select("phone_num")
            .unionByName(new_rides.select(F.col("client_phone_num").alias("phone_num")))
            .unionByName(by_card).distinct())


def clients_hist(dim_clients: DataFrame, fact_payments: DataFrame, fact_rides: DataFrame,
                 affected: DataFrame | None = None, half_open: bool = False) -> DataFrame:
    """rep_clients_hist: per client version rides, cancellations, running paid and running debt.

    With ``affected`` (phones, see :func:`affected_phones`) only those phones' rows are
    recomputed; upserted into the stored history they give the full report, so a daily run
    shuffles the batch's phones instead of every client.
    """
    if affected is not None:
        dim_clients, fact_payments, fact_rides = restrict_to_phones(affected, dim_clients, fact_payments, fact_rides)
    fact_rides = stored(fact_rides.select(*CLIENT_RIDE_COLS), "client-rides")
    return history_rows(dim_clients, paid_by_card(fact_payments), rides_by_client_card(fact_rides, dim_clients, half_open))


def history_rows(dim_clients: DataFrame, paid: DataFrame, rides: DataFrame) -> DataFrame:
    """The history of the client versions in ``dim_clients`` (all of each phone's) from the sums of :func:`paid_by_card`
    and :func:`rides_by_client_card`."""
    fp = paid.withColumnRenamed("card_num", "_fp_card")
    frg = rides.withColumnRenamed("card_num", "_frg_card")
    base = (dim_clients.join(fp, dim_clients.card_num == fp._fp_card, "left")
            .join(frg, (F.col("phone_num") == F.col("client_phone_num")) & (F.col("card_num") == F.col("_frg_card")),
                  "left"))
    w = Window.partitionBy("phone_num").orderBy("start_dt")  # default frame: RANGE up to the current row
    paid = F.coalesce(F.col("paid_amt"), F.lit(0).cast("decimal(18,2)"))
    owed = F.coalesce(F.col("total_amt"), F.lit(0).cast("decimal(18,2)"))
    cancelled = F.coalesce(F.col("cancelled_cnt"), F.lit(0))
    return base.select(
        client_key("phone_num", "start_dt").alias("client_id"),
        "phone_num",
        (F.coalesce(F.col("total_rides_cnt"), F.lit(0)) - cancelled).cast("bigint").alias("rides_cnt"),
        cancelled.cast("bigint").alias("cancelled_cnt"),
        F.sum(paid).over(w).cast("decimal(18,2)").alias("spent_amt"),
        F.sum(owed - paid).over(w).cast("decimal(18,2)").alias("debt_amt"),
        "start_dt", "end_dt", "deleted_flag",
    )
