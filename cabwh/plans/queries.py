"""Registered queries: one per operator of SURVEY §2 (keys of §7.4).

Each takes (spark, sf_dir) and returns a DataFrame over the whole derived tables of that
scale factor. Column names equal those of the DuckDB oracle (``cabwh.oracle.sql``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.constants import LOOKBACK_RIDES_H, STATUS_SUCCESS
from cabwh.functions import (
    client_key,
    format_card,
    parse_dayfirst,
    personnel_key,
    seconds_between,
    speed_hundredths,
    speed_over_limit,
    trim_plate,
)
from cabwh.operators.scd2 import as_of, versions_from_history
from cabwh.operators.windows import sliding_sum, split_lag
from cabwh.operators.writes import dedupe_keep_last, insert_ignore_result, one_per_key, upsert
from cabwh.plans import dims, facts, marts
from cabwh.plans.warehouse import Warehouse
from cabwh.session import scratch_path, stored
from cabwh.sources import extract, files
from cabwh.sources.fixtures import BATCH1_UNTIL, REPORT_DAY, load_sources
from cabwh.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DAY_US = 24 * 3600 * 1_000_000
LEDGER_NEXT_RUN = "2024-01-31 00:00:00"


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- extraction -----------------------------------------------------------------------------

@query("batch_watermark")
def q_batch_watermark(spark, sf):
    return extract.last_success_df(load_sources(spark, sf).ledger)


@query("extract_lookback")
def q_extract_lookback(spark, sf):
    src = load_sources(spark, sf)
    wm = extract.last_success(src.ledger)
    return extract.extract_since(src.rides, "dt", wm, LOOKBACK_RIDES_H)


@query("batch_ledger")
def q_batch_ledger(spark, sf):
    src = load_sources(spark, sf)
    return extract.record_batch(spark, src.ledger, LEDGER_NEXT_RUN, STATUS_SUCCESS)


@query("car_pool_preview")
def q_car_pool_preview(spark, sf):
    """The first rows of the car pool (a preview: the limit is the feature), in plate order."""
    return load_sources(spark, sf).car_pool.orderBy("plate_num").limit(5)


# --- files ----------------------------------------------------------------------------------------

@query("xml_waybills")
def q_xml_waybills(spark, sf):
    path = scratch_path(spark, "waybills-xml")
    files.write_waybills(load_sources(spark, sf).waybills, path)
    return files.read_waybills(spark, path)


@query("tsv_payments")
def q_tsv_payments(spark, sf):
    path = scratch_path(spark, "payments-tsv")
    files.write_payments(load_sources(spark, sf).payments, path)
    return files.read_payments(spark, path)


# --- scalars ------------------------------------------------------------------------------------

@query("personnel_key")
def q_personnel_key(spark, sf):
    return load_sources(spark, sf).drivers.select("driver_license", personnel_key().alias("personnel_num"))


@query("client_key")
def q_client_key(spark, sf):
    d = Warehouse(spark, sf).dim_clients
    return d.select("phone_num", "start_dt", client_key("phone_num", "start_dt").alias("client_id"))


@query("payments_keyed")
def q_payments_keyed(spark, sf):
    return facts.build_fact_payments(load_sources(spark, sf).payments)


@query("format_card")
def q_format_card(spark, sf):
    p = load_sources(spark, sf).payments
    return p.groupBy("card_num").agg(F.count(F.lit(1)).alias("n_payments")) \
        .select("card_num", format_card("card_num").alias("card_fmt"), "n_payments")


@query("trim_plate")
def q_trim_plate(spark, sf):
    return load_sources(spark, sf).movement.select("movement_id", trim_plate("car_plate_num").alias("car_plate_num"))


@query("parse_dayfirst")
def q_parse_dayfirst(spark, sf):
    p = load_sources(spark, sf).payments
    return p.select("transaction_dt", "card_num", parse_dayfirst("transaction_dt").alias("transaction_ts"))


@query("shift_seconds")
def q_shift_seconds(spark, sf):
    fw = Warehouse(spark, sf).fact_waybills
    return fw.select("waybill_num", seconds_between("work_start_dt", "work_end_dt").alias("work_s"))


@query("ride_speed")
def q_ride_speed(spark, sf):
    fr = Warehouse(spark, sf).fact_rides.filter(F.col("ride_start_dt").isNotNull())
    sec = seconds_between("ride_start_dt", "ride_end_dt")
    return fr.select("ride_id", sec.alias("ride_s"), speed_hundredths(F.col("distance_val"), sec).alias("speed"),
                     speed_over_limit(F.col("distance_val"), sec).alias("is_violation"))


# --- facts -------------------------------------------------------------------------------------

@query("ride_times_pivot")
def q_ride_times_pivot(spark, sf):
    return facts.ride_times(load_sources(spark, sf).movement)


@query("finished_rides")
def q_finished_rides(spark, sf):
    return Warehouse(spark, sf).finished


@query("ride_driver_lookup")
def q_ride_driver_lookup(spark, sf):
    lk = Warehouse(spark, sf).lookup
    return lk.select("ride_id", "car_plate_num", "dt", "waybill_num", "driver_pers_num",
                     F.col("_matches").alias("n_matches"))


@query("ride_driver_unmatched")
def q_ride_driver_unmatched(spark, sf):
    return Warehouse(spark, sf).fact_rides_all.quarantine


@query("fact_waybills")
def q_fact_waybills(spark, sf):
    return Warehouse(spark, sf).fact_waybills


@query("fact_waybills_parity")
def q_fact_waybills_parity(spark, sf):
    """Rows with a NULL in *any* joined column dropped (not only in the output columns)."""
    src = load_sources(spark, sf)
    return facts.build_fact_waybills(src.waybills, src.drivers, parity_dropna=True)


@query("fact_rides")
def q_fact_rides(spark, sf):
    return Warehouse(spark, sf).fact_rides


@query("fact_payments")
def q_fact_payments(spark, sf):
    fp = facts.build_fact_payments(load_sources(spark, sf).payments)
    return one_per_key(fp, ["transaction_id"])   # the smallest (time, card, amount) per id


# --- write algebra ------------------------------------------------------------------------------

def _two_batches(spark, sf):
    src = load_sources(spark, sf)
    first = Warehouse(spark, sf, cut=BATCH1_UNTIL, sources=src)
    full = Warehouse(spark, sf, sources=src)
    return src, first, full


@query("insert_ignore")
def q_insert_ignore(spark, sf):
    """First load up to the cut, second load from cut - 2 h: the union keeps each ride once."""
    src, first, full = _two_batches(spark, sf)
    since = extract.extract_since
    mv2 = since(src.movement, "dt", BATCH1_UNTIL, LOOKBACK_RIDES_H)
    rd2 = since(src.rides, "dt", BATCH1_UNTIL, LOOKBACK_RIDES_H)
    delta = facts.build_fact_rides(mv2, rd2, full.fact_waybills).rides
    return insert_ignore_result(first.fact_rides, delta, ["ride_id"])


@query("insert_ignore_indexed")
def q_insert_ignore_indexed(spark, sf):
    """The same two loads against the persistent key index: the second one probes it and appends."""
    from cabwh.operators.key_index import insert_ignore_indexed
    from cabwh.sources.store import Store

    src, first, full = _two_batches(spark, sf)
    since = extract.extract_since
    mv2 = since(src.movement, "dt", BATCH1_UNTIL, LOOKBACK_RIDES_H)
    rd2 = since(src.rides, "dt", BATCH1_UNTIL, LOOKBACK_RIDES_H)
    store = Store(spark, scratch_path(spark, "indexed"))
    for delta in (first.fact_rides, facts.build_fact_rides(mv2, rd2, full.fact_waybills).rides):
        load = store.begin()
        insert_ignore_indexed(load, "fact_rides", delta, ["ride_id"])
        load.commit()
    return store.read("fact_rides")


@query("upsert_update")
def q_upsert_update(spark, sf):
    """Client history as of the cut, upserted with today's full history."""
    src, first, full = _two_batches(spark, sf)
    old = marts.clients_hist(first.dim_clients, first.fact_payments, first.fact_rides)
    new = marts.clients_hist(full.dim_clients, full.fact_payments, full.fact_rides)
    return upsert(old, new, ["client_id"], marts.HISTORY_UPDATE_COLS)


@query("rejected_rows")
def q_rejected_rows(spark, sf):
    """A payment file with damaged lines: those that do not parse, with the reason and the line as it came."""
    from cabwh.sources import rejects
    from cabwh.sources.fixtures import damaged_payment_lines

    path = scratch_path(spark, "damaged-payments")
    damaged_payment_lines(load_sources(spark, sf).payments).write.text(path)
    return rejects.rejected_rows(rejects.check_payments(rejects.read_payment_text(spark, path, glob="*.txt")), "payments")


@query("upsert_bucketed")
def q_upsert_bucketed(spark, sf):
    """The same upsert into a table in hash buckets, of which the second load rewrites those it touches."""
    from cabwh.operators.buckets import BucketedTable
    from cabwh.sources.store import Store

    src, first, full = _two_batches(spark, sf)
    store, table = Store(spark, scratch_path(spark, "bucketed")), BucketedTable("rep_clients_hist", ["client_id"])
    for wh in (first, full):
        load = store.begin()
        rows = marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides)
        table.upsert(load, rows, marts.HISTORY_UPDATE_COLS)
        load.commit()
    return store.read("rep_clients_hist")


@query("clients_hist_maintained")
def q_clients_hist_maintained(spark, sf):
    """History from maintained sums: a first load up to the cut, then a second one that adds its own rows and moves
    the rides whose client version it closed; only the phones it touched are reported again."""
    from cabwh.plans.maintained import ClientHistory
    from cabwh.sources.store import Store

    src, first, full = _two_batches(spark, sf)
    store, history = Store(spark, scratch_path(spark, "maintained")), ClientHistory()
    old = None
    for wh in (first, full):
        load = store.begin()
        rides, payments = wh.fact_rides, wh.fact_payments
        if old is not None:
            # without the headers of stored rides: what is stored already is not looked up again
            headers = wh.rides.join(load.read("fact_rides").select("ride_id"), "ride_id", "left_anti")
            rides = facts.build_fact_rides(wh.movement, headers, wh.fact_waybills).rides
            payments = payments.join(load.read("fact_payments").select("transaction_id"), "transaction_id", "left_anti")
        load.write("fact_rides", rides.withColumn("end_date", F.to_date("ride_end_dt")), load.id, "end_date")
        load.write("fact_payments", payments, load.id)
        load.write("dim_clients", wh.dim_clients, "open")
        clients = versions = load.read("dim_clients")
        if old is not None:
            versions = versions.filter(F.col("start_dt") > F.lit(BATCH1_UNTIL).cast("timestamp_ntz"))
        history.add(load, old, clients, versions,
                    load.read("fact_rides", lambda k, mine=load.id: k.endswith(mine)),
                    load.read("fact_payments", lambda k, mine=load.id: k == mine))
        history.report(load)
        load.commit()
        old = store.read("dim_clients")
    return store.read("rep_clients_hist")


@query("drivers_violations_state")
def q_drivers_violations_state(spark, sf):
    """Running counts from day-end snapshots: three runs, then an earlier day again, which runs the days after it too."""
    from cabwh.plans.maintained import ViolationCounts
    from cabwh.sources.store import Store

    rides = Warehouse(spark, sf).fact_rides.checkpoint()
    store, counts = Store(spark, scratch_path(spark, "violations")), ViolationCounts()
    for day in (9, 19, 31, 12):
        load = store.begin()
        counts.run(load, lambda first, last: rides, _dt.date(2024, 1, day))
        load.commit()
    return store.read("rep_drivers_violations")


@query("daily_run")
def q_daily_run(spark, sf):
    """Both jobs on three days, one load failing half-way and repeated: every row of every table, as text."""
    from cabwh.plans import daily

    return daily.final_tables(daily.run_three_loads(spark, sf, scratch_path(spark, "warehouse")))


@query("clients_hist_half_open")
def q_clients_hist_half_open(spark, sf):
    """Client history with half-open version intervals (option of SURVEY §7.5 #6)."""
    wh = Warehouse(spark, sf)
    return marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides, half_open=True)


@query("clients_hist_incremental")
def q_clients_hist_incremental(spark, sf):
    """History as of the cut, then only the phones the second load touches recomputed and upserted."""
    src, first, full = _two_batches(spark, sf)
    old = marts.clients_hist(first.dim_clients, first.fact_payments, first.fact_rides)
    cut = F.lit(BATCH1_UNTIL).cast("timestamp_ntz")
    new_rides = full.fact_rides.join(first.fact_rides.select("ride_id"), "ride_id", "left_anti")
    new_versions = full.dim_clients.filter(F.col("start_dt") > cut)
    new_payments = full.fact_payments.filter(F.col("transaction_dt") > cut)
    touched = marts.affected_phones(full.dim_clients, new_versions, new_rides, new_payments)
    part = marts.clients_hist(full.dim_clients, full.fact_payments, full.fact_rides, affected=touched)
    return upsert(old, part, ["client_id"], marts.HISTORY_UPDATE_COLS)


@query("dedupe_keep_last")
def q_dedupe_keep_last(spark, sf):
    """A re-run appended the versions newer than the cut a second time; keep the last load."""
    d = Warehouse(spark, sf).dim_clients
    again = d.filter(F.col("start_dt") > F.lit(BATCH1_UNTIL).cast("timestamp_ntz"))
    both = d.withColumn("load_seq", F.lit(1)).unionByName(again.withColumn("load_seq", F.lit(2)))
    return dedupe_keep_last(both, ["phone_num", "start_dt"], "load_seq").select(
        "phone_num", "start_dt", "card_num", "end_dt", "load_seq")


@query("mart_append")
def q_mart_append(spark, sf):
    """Payout mart written for two days, the second one twice: each day is held once."""
    from cabwh.plans.pipeline import append_mart
    wh = Warehouse(spark, sf)
    path = scratch_path(spark, "rep_drivers_payments")
    for day in (REPORT_DAY - _dt.timedelta(days=1), REPORT_DAY, REPORT_DAY):
        ended = wh.fact_rides_ended(str(day), str(day + _dt.timedelta(days=1)))
        append_mart(marts.drivers_payments(ended, wh.dim_drivers, day), path)
    return spark.read.parquet(path).select("personnel_num", "last_name", "first_name", "middle_name", "card_num",
                                           "amount", F.col("report_dt").cast("date").alias("report_dt"))


# --- SCD2 -------------------------------------------------------------------------------------------

@query("first_seen")
def q_first_seen(spark, sf):
    r = load_sources(spark, sf).rides
    return r.groupBy("client_phone", "card_num").agg(F.min("dt").alias("first_dt"))


@query("client_card_versions")
def q_client_card_versions(spark, sf):
    r = load_sources(spark, sf).rides
    return versions_from_history(r, "client_phone", "card_num", "dt", key_out="phone_num")


def _scd2_cars(spark, sf, mode):
    src = load_sources(spark, sf)
    first = dims.apply_cars(None, dims.cars_delta(src.car_pool))
    return dims.apply_cars(first, dims.cars_delta(src.car_pool_delta), mode=mode)


@query("client_card_changes")
def q_client_card_changes(spark, sf):
    """Client versions on every card change in time order (option of SURVEY §7.5 #4)."""
    from cabwh.operators.scd2 import versions_on_change
    r = load_sources(spark, sf).rides
    return versions_on_change(r, "client_phone", "card_num", "dt", "ride_id", key_out="phone_num")


@query("scd2_cars")
def q_scd2_cars(spark, sf):
    return _scd2_cars(spark, sf, "parity")


@query("scd2_cars_strict")
def q_scd2_cars_strict(spark, sf):
    return _scd2_cars(spark, sf, "strict")


@query("scd2_drivers")
def q_scd2_drivers(spark, sf):
    return Warehouse(spark, sf).dim_drivers


@query("scd2_drivers_parity")
def q_scd2_drivers_parity(spark, sf):
    """Drivers' first load, then the day-12 delta in parity mode (close if the card differs, append all)."""
    src = load_sources(spark, sf)
    first = dims.apply_drivers(None, dims.drivers_delta(src.drivers))
    return dims.apply_drivers(first, dims.drivers_delta(src.drivers_delta), mode="parity")


@query("scd2_clients")
def q_scd2_clients(spark, sf):
    """Clients loaded up to the cut, then the versions first seen after it (parity close-and-append)."""
    src, first, full = _two_batches(spark, sf)
    delta = dims.clients_delta(src.rides, F.lit(BATCH1_UNTIL).cast("timestamp_ntz"))
    return dims.apply_clients(first.dim_clients, delta, mode="parity")


@query("drivers_as_of")
def q_drivers_as_of(spark, sf):
    return as_of(Warehouse(spark, sf).dim_drivers, REPORT_DAY)


# --- aggregates and joins -----------------------------------------------------------------------------

@query("agg_driver_day")
def q_agg_driver_day(spark, sf):
    return marts.driver_day_totals(Warehouse(spark, sf).fact_rides)


@query("prior_violations_max")
def q_prior_violations_max(spark, sf):
    full = marts.drivers_violations_full(Warehouse(spark, sf).fact_rides)
    return marts.prior_violations(full, REPORT_DAY)


@query("paid_by_card")
def q_paid_by_card(spark, sf):
    return marts.paid_by_card(Warehouse(spark, sf).fact_payments)


@query("rides_by_client_card")
def q_rides_by_client_card(spark, sf):
    wh = Warehouse(spark, sf)
    return marts.rides_by_client_card(stored(wh.fact_rides.select(*marts.CLIENT_RIDE_COLS), "client-rides"), wh.dim_clients)


@query("ride_client_interval_join")
def q_ride_client_interval_join(spark, sf):
    from cabwh.operators.lookup import interval_join
    wh = Warehouse(spark, sf)
    dc = wh.dim_clients.select(F.col("phone_num"), F.col("start_dt"), F.col("end_dt"), F.col("card_num"))
    fr = stored(wh.fact_rides.select("ride_id", "client_phone_num", "ride_arrival_dt"), "client-rides")
    j = interval_join(fr, dc, "client_phone_num", "ride_arrival_dt", "phone_num", "start_dt", "end_dt")
    return j.select("ride_id", "client_phone_num", "card_num", "start_dt")


# --- windows -------------------------------------------------------------------------------------------

@query("violation_running_count")
def q_violation_running_count(spark, sf):
    day_rides = Warehouse(spark, sf).fact_rides_ended(REPORT_DAY, REPORT_DAY + _dt.timedelta(days=1))
    return marts.day_violation_counts(day_rides, REPORT_DAY)


@query("sliding_24h_work")
def q_sliding_24h_work(spark, sf):
    """W3 over each driver's whole history, split by (driver, hour) (see ``sliding_sum``)."""
    fw = Warehouse(spark, sf).fact_waybills
    shifts = fw.select("waybill_num", "driver_pers_num", "work_start_dt",
                       seconds_between("work_start_dt", "work_end_dt").alias("work_s"))
    return sliding_sum(shifts, "driver_pers_num", "work_start_dt", "work_s", DAY_US, "cum_work_s",
                       id_col="waybill_num")


@query("prev_shift_start")
def q_prev_shift_start(spark, sf):
    """W4 over each driver's whole history, split by (driver, day) (see ``split_lag``)."""
    fw = Warehouse(spark, sf).fact_waybills.select("waybill_num", "driver_pers_num", "work_start_dt")
    return split_lag(fw, "driver_pers_num", "work_start_dt", "waybill_num", "prev_start")


@query("cumulative_paid")
def q_cumulative_paid(spark, sf):
    wh = Warehouse(spark, sf)
    h = marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides)
    return h.select("phone_num", "start_dt", "spent_amt", "debt_amt")


@query("events_sliding_24h")
def q_events_sliding_24h(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    cents = F.floor(F.col("value") * 100).cast("bigint")
    out = sliding_sum(ev.select("event_id", "user_id", "ts", cents.alias("cents")), "user_id", "ts", "cents",
                      DAY_US, "sum_24h", id_col="event_id")
    return out.select("event_id", "user_id", "ts", "sum_24h")


# --- marts -----------------------------------------------------------------------------------------------

@query("drivers_payments")
def q_drivers_payments(spark, sf):
    wh = Warehouse(spark, sf)
    day_rides = wh.fact_rides_ended(REPORT_DAY, REPORT_DAY + _dt.timedelta(days=1))
    return marts.drivers_payments(day_rides, wh.dim_drivers, REPORT_DAY)


@query("drivers_payments_eod")
def q_drivers_payments_eod(spark, sf):
    """Payouts joined to the driver version valid at the end of the day (option of SURVEY §7.5 #10)."""
    wh = Warehouse(spark, sf)
    day_rides = wh.fact_rides_ended(REPORT_DAY, REPORT_DAY + _dt.timedelta(days=1))
    return marts.drivers_payments(day_rides, wh.dim_drivers, REPORT_DAY, version_at="end")


@query("drivers_violations_day")
def q_drivers_violations_day(spark, sf):
    """The day's report with the prior report rows of all earlier days (the mart's own history)."""
    wh = Warehouse(spark, sf)
    upto = wh.fact_rides_ended(None, REPORT_DAY + _dt.timedelta(days=1))
    prior = marts.drivers_violations_full(upto).filter(F.col("report_dt") < F.lit(REPORT_DAY))
    return marts.drivers_violations(upto, prior, REPORT_DAY)


@query("drivers_violations_full")
def q_drivers_violations_full(spark, sf):
    return marts.drivers_violations_full(Warehouse(spark, sf).fact_rides)


@query("drivers_overtime")
def q_drivers_overtime(spark, sf):
    return marts.drivers_overtime(Warehouse(spark, sf).fact_waybills, REPORT_DAY)


@query("drivers_overtime_clipped")
def q_drivers_overtime_clipped(spark, sf):
    return marts.drivers_overtime_clipped(Warehouse(spark, sf).fact_waybills, REPORT_DAY)


@query("clients_hist")
def q_clients_hist(spark, sf):
    wh = Warehouse(spark, sf)
    return marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides)
