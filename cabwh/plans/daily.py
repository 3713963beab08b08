"""The daily run over the derived sources: what each run finds, and three loads of which one fails and is repeated."""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.constants import LOOKBACK_WAYBILLS_H
from cabwh.functions import ts_lit
from cabwh.plans import dims, facts
from cabwh.plans.pipeline import Inputs, LoadFailed, Pipeline
from cabwh.sources.fixtures import Sources, load_sources

#: (start of the run, its report day). The first run is before any car or driver row is updated in place (day 10).
RUNS = [(_dt.datetime(2024, 1, 10, 12), _dt.date(2024, 1, 9)),
        (_dt.datetime(2024, 1, 17, 2), _dt.date(2024, 1, 16)),
        (_dt.datetime(2024, 2, 1), _dt.date(2024, 1, 30))]
#: A run that loses a source half-way, before the second one repeats it.
FAILED_RUN = _dt.datetime(2024, 1, 17)

#: The warehouse's tables and the columns that are compared.
TABLES = {
    "fact_rides": facts.FACT_RIDES_COLUMNS,
    "fact_waybills": ["waybill_num", "driver_pers_num", "car_plate_num", "work_start_dt", "work_end_dt", "issue_dt"],
    "fact_payments": ["transaction_id", "transaction_dt", "card_num", "transaction_amt"],
    "dim_cars": dims.CARS_COLUMNS,
    "dim_drivers": dims.DRIVERS_COLUMNS,
    "dim_clients": dims.CLIENTS_COLUMNS,
    "rep_drivers_payments": ["personnel_num", "last_name", "first_name", "middle_name", "card_num", "amount", "report_dt"],
    "rep_drivers_violations": ["personnel_num", "ride", "speed", "violations_cnt", "report_dt"],
    "rep_drivers_overtime": ["personnel_num", "total_work_time", "period_start", "report_dt"],
    "rep_drivers_overtime_clipped": ["personnel_num", "total_work_time", "period_start", "report_dt"],
    "rep_clients_hist": ["client_id", "phone_num", "rides_cnt", "cancelled_cnt", "spent_amt", "debt_amt", "start_dt",
                         "end_dt", "deleted_flag"],
    "work_batchdate": ["loaded_until", "status"],
}


def source_inputs(src: Sources, since: _dt.datetime | None, until: _dt.datetime) -> Inputs:
    """What a run at ``until`` finds whose last successful one was at ``since``: the source tables as they stand, the
    waybill files of the look-back, and the payment files that arrived."""
    upto = ts_lit(until)
    waybills_since = (since or _dt.datetime(1900, 1, 2)) - _dt.timedelta(hours=LOOKBACK_WAYBILLS_H)
    return Inputs(
        rides=src.rides.filter(F.col("dt") <= upto),
        movement=src.movement.filter(F.col("dt") <= upto),
        drivers=src.current("drivers", until),
        car_pool=src.current("car_pool", until),
        waybills=src.waybills.filter((F.col("issuedt") <= upto) & (F.col("issuedt") > ts_lit(waybills_since))),
        payments=src.paid(since, until),
    )


def losing_a_source(inp: Inputs) -> Inputs:
    """The same inputs, but the car pool fails when it is read: the facts are written by then."""
    return dataclasses.replace(inp, car_pool=inp.car_pool.withColumn("model", F.raise_error(F.lit("source lost"))))


def run_three_loads(spark: SparkSession, sf_dir: str, root: str) -> Pipeline:
    src, pipeline, since = load_sources(spark, sf_dir), Pipeline(spark, root, buckets=32), None
    for at, report_day in RUNS:
        if at > FAILED_RUN > (since or at):
            try:
                pipeline.daily_run(losing_a_source(source_inputs(src, since, FAILED_RUN)), FAILED_RUN, report_day)
            except Exception:
                pass                                     # recorded in the ledger
            try:
                pipeline.run_marts(report_day)
            except LoadFailed:
                pass                                     # no reports on a failed load
            else:
                raise AssertionError("reports ran after a failed load")
        pipeline.daily_run(source_inputs(src, since, at), at, report_day)
        since = at
    return pipeline


def as_text(df: DataFrame, table: str) -> DataFrame:
    """(table_name, row_text) of a table's rows."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in TABLES[table]]
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *values).alias("row_text"))


def final_tables(pipeline: Pipeline) -> DataFrame:
    """The rows of all tables, as text."""
    out = None
    for table in TABLES:
        rows = as_text(pipeline.table(table), table)
        out = rows if out is None else out.unionByName(rows)
    return out
