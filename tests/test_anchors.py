"""The expected anchors of FIXTURES.md §4 at sf0.001 (both engines agreed on them)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cabwh.constants import OPEN_END
from cabwh.plans import marts
from cabwh.plans.queries import REGISTRY
from cabwh.plans.warehouse import Warehouse
from cabwh.sources.fixtures import REPORT_DAY, load_sources


@pytest.fixture(scope="module")
def wh(spark, sf_small):
    return Warehouse(spark, sf_small)


def test_sources(spark, sf_small, wh):
    src = load_sources(spark, sf_small)
    assert src.movement.count() == 4258
    assert src.drivers.count() == 20
    keys = REGISTRY["personnel_key"](spark, sf_small)
    assert keys.filter(F.col("personnel_num").isNotNull()).select("personnel_num").distinct().count() == 19
    assert src.waybills.count() == 600
    assert wh.fact_waybills.count() == 580
    fp = wh.fact_payments
    assert fp.count() == 1007 and fp.select("transaction_id").distinct().count() == 1007


def test_lookup(wh):
    lk = wh.lookup
    # left-join rows of finished rides x waybills (an unmatched ride is one row)
    assert lk.agg(F.sum(F.greatest(F.col("_matches"), F.lit(1)))).first()[0] == 1403
    assert lk.agg(F.sum(F.greatest(F.col("_matches") - 1, F.lit(0)))).first()[0] == 8
    assert wh.fact_rides_all.quarantine.count() == 66
    fr = wh.fact_rides
    assert fr.count() == 1329
    assert fr.filter(F.col("ride_start_dt").isNull()).count() == 128


def test_payouts(wh):
    p = marts.drivers_payments(wh.fact_rides, wh.dim_drivers, REPORT_DAY)
    row = p.agg(F.count("*"), F.sum("amount")).first()
    assert row[0] == 10 and row[1] == Decimal("70848.64")


def test_violations(wh):
    v = marts.drivers_violations_full(wh.fact_rides)
    row = v.agg(F.count("*"), F.sum("speed"), F.max("violations_cnt")).first()
    assert (row[0], row[2]) == (445, 47)
    assert row[1] == Decimal("45545.94")
    assert marts.violations(wh.fact_rides, REPORT_DAY).count() == 13


def test_overtime(wh):
    p = marts.drivers_overtime(wh.fact_waybills, REPORT_DAY)
    assert tuple(p.agg(F.count("*"), F.min("total_work_time"), F.max("total_work_time"),
                       F.sum("total_work_time")).first()) == (20, 85199, 125999, 2111980)
    c = marts.drivers_overtime_clipped(wh.fact_waybills, REPORT_DAY)
    assert tuple(c.agg(F.count("*"), F.min("total_work_time"), F.max("total_work_time"),
                       F.sum("total_work_time")).first()) == (20, 84599, 85199, 1697980)


def test_clients(wh):
    dc = wh.dim_clients
    assert dc.count() == 198
    assert dc.filter(F.col("end_dt") != F.lit(OPEN_END).cast("timestamp_ntz")).count() == 48
    h = marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides)
    row = h.agg(F.sum("rides_cnt"), F.sum("cancelled_cnt"), F.sum("spent_amt"), F.sum("debt_amt")).first()
    assert (row[0], row[1]) == (1201, 128)
    assert (row[2], row[3]) == (Decimal("2723736.00"), Decimal("608751.00"))
    # every matched ride meets exactly one client version
    assert row[0] + row[1] == wh.fact_rides.count()


def test_cars(spark, sf_small):
    is_open = F.col("end_dt") == F.lit(OPEN_END).cast("timestamp_ntz")
    for name, expected in (("scd2_cars", (20, 16, 13)), ("scd2_cars_strict", (17, 13, 13))):
        d = REGISTRY[name](spark, sf_small)
        got = (d.count(), d.filter(is_open).count(), d.filter(is_open).select("plate_num").distinct().count())
        assert got == expected, name


def test_events_sliding(spark, sf_small):
    e = REGISTRY["events_sliding_24h"](spark, sf_small)
    assert tuple(e.agg(F.sum("sum_24h"), F.max("sum_24h")).first()) == (16523541, 65946)


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.1"), reason="sf0.1 not present")
def test_anchors_sf01(spark):
    wh = Warehouse(spark, "/root/testdata/sf0.1")
    assert wh.fact_rides.count() == 130070
    assert marts.violations(wh.fact_rides).count() == 44315
    dc = wh.dim_clients
    assert (dc.count(), dc.select("card_num").distinct().count()) == (19792, 14925)
    h = marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides)
    row = h.agg(F.sum("rides_cnt"), F.sum("cancelled_cnt"), F.sum("spent_amt"), F.sum("debt_amt")).first()
    # payments are stored once per id: an id that comes twice counts once
    assert tuple(row) == (117343, 12727, Decimal("462146060.00"), Decimal("-136547096.00"))
