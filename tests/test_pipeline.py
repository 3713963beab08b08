"""The daily job over three batches equals one full build; a re-run changes nothing; failures are logged."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from cabwh.functions import ts_lit
from cabwh.plans import marts
from cabwh.plans.daily import source_inputs
from cabwh.plans.pipeline import Inputs, Pipeline
from cabwh.plans.warehouse import Warehouse
from cabwh.sources.fixtures import REPORT_DAY, load_sources

# the first batch runs before any car or driver row is updated in place (first update: day 10)
BATCHES = [dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 17), dt.datetime(2024, 2, 1)]


def _rows(df, cols=None):
    rows = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def loaded(spark, sf_small):
    src = load_sources(spark, sf_small)
    p = Pipeline(spark, tempfile.mkdtemp(prefix="cabwh-wh-"))
    prev = None
    for b in BATCHES:
        p.run_etl(source_inputs(src, prev, b), started_at=b)
        # the daily reports after every load: the client history is upserted incrementally
        p.run_marts(REPORT_DAY)
        prev = b
    return p, src


def test_facts_equal_full_build(spark, sf_small, loaded):
    p, _ = loaded
    full = Warehouse(spark, sf_small)
    assert _rows(p.table("fact_rides")) == _rows(full.fact_rides)
    assert _rows(p.table("fact_waybills")) == _rows(full.fact_waybills)
    assert _rows(p.table("fact_payments")) == _rows(full.fact_payments)
    # rides whose car never had a waybill stay in quarantine
    assert _rows(p.table("quarantine_rides"), ["ride_id"]) == _rows(full.fact_rides_all.quarantine, ["ride_id"])


def test_dimensions_equal_full_build(spark, sf_small, loaded):
    p, _ = loaded
    full = Warehouse(spark, sf_small)
    assert _rows(p.table("dim_drivers")) == _rows(full.dim_drivers)
    assert _rows(p.table("dim_clients")) == _rows(full.dim_clients)
    assert _rows(p.table("dim_cars")) == _rows(full.dim_cars)


def test_marts(spark, sf_small, loaded):
    p, _ = loaded
    full = Warehouse(spark, sf_small)
    got = p.table("rep_drivers_payments")
    want = marts.drivers_payments(full.fact_rides, full.dim_drivers, REPORT_DAY)
    assert _rows(got, want.columns) == _rows(want)
    hist = p.table("rep_clients_hist")
    assert _rows(hist) == _rows(marts.clients_hist(full.dim_clients, full.fact_payments, full.fact_rides))


def test_rerun_and_ledger(spark, sf_small, loaded):
    p, src = loaded
    before = {t: _rows(p.table(t)) for t in ("fact_rides", "fact_payments", "dim_drivers", "dim_clients")}
    again = dt.datetime(2024, 2, 2)
    p.run_etl(source_inputs(src, BATCHES[-1], again), started_at=again)          # nothing new arrived
    p.run_marts(REPORT_DAY)       # same day again: replaced
    for t, rows in before.items():
        assert _rows(p.table(t)) == rows, t
    assert p.table("rep_drivers_payments").count() == \
        marts.drivers_payments(Warehouse(spark, sf_small).fact_rides,
                               Warehouse(spark, sf_small).dim_drivers, REPORT_DAY).count()
    assert p.watermark() == again


def test_failure_is_recorded_and_raised(spark, loaded):
    p, src = loaded
    bad = Inputs(rides=src.rides.drop("client_phone"), movement=src.movement, drivers=src.drivers,
                 car_pool=src.car_pool, waybills=src.waybills, payments=src.payments)
    wm = p.watermark()
    with pytest.raises(Exception):
        p.run_etl(bad, started_at=dt.datetime(2024, 3, 1))
    statuses = {r.status for r in p.ledger().filter(F.col("loaded_until") == ts_lit("2024-03-01 00:00:00")).collect()}
    assert statuses == {"Failure"}
    assert p.watermark() == wm                                              # a failed run moves nothing


def test_daily_run_from_tables_and_file_drops(spark, sf_small):
    """Sources as a Parquet folder and the drops as XML / TSV files: one run equals the full build."""
    import os
    import time

    from cabwh.sources.files import write_payments, write_waybills

    src = load_sources(spark, sf_small)
    root = tempfile.mkdtemp(prefix="cabwh-src-")
    for name in ("rides", "movement", "car_pool"):
        getattr(src, name).write.parquet(f"{root}/{name}")
    src.current("drivers", dt.datetime(2024, 2, 1)).write.parquet(f"{root}/drivers")   # as the source stands at run time
    write_waybills(src.waybills, f"{root}/drop_waybills")
    write_payments(src.payments, f"{root}/drop_payments")
    stale = f"{root}/drop_payments/old.csv"                      # a file from before the watermark
    with open(stale, "w") as f:
        f.write("01.01.2020 00:00:00\t4000000000000009\t1.00\n")
    old = time.mktime(dt.datetime(2020, 1, 1).timetuple())
    os.utime(stale, (old, old))
    p = Pipeline(spark, tempfile.mkdtemp(prefix="cabwh-wh2-"))
    wm = dt.datetime(2021, 1, 1)
    p.record(wm, "Success")                                       # the last successful run
    p.run_etl(Inputs.read(spark, root, f"{root}/drop_waybills", f"{root}/drop_payments", p.watermark()),
              started_at=dt.datetime(2024, 2, 1))
    full = Warehouse(spark, sf_small)
    assert _rows(p.table("fact_rides")) == _rows(full.fact_rides)
    assert _rows(p.table("fact_waybills")) == _rows(full.fact_waybills)
    assert _rows(p.table("fact_payments")) == _rows(full.fact_payments)   # the stale file is not read

