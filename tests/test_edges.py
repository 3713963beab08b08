"""Hand-made rows for the behaviours listed in SURVEY §7.5."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cabwh.functions import format_card, parse_dayfirst, speed_hundredths, speed_over_limit
from cabwh.operators.scd2 import as_of, scd2_apply, versions_from_history
from cabwh.plans import facts, marts

T = dt.datetime
OPEN = T(9999, 1, 1)


def movement(spark, rows):
    return spark.createDataFrame(rows, "movement_id long, car_plate_num string, ride long, event string, dt timestamp_ntz")


def rides(spark, ids):
    return spark.createDataFrame(
        [(i, T(2024, 1, 2, 10), "+70000000001", "4000 0000 0001 0000", "A1", "B1", Decimal("10.00"), Decimal("500.00"))
         for i in ids],
        "ride_id long, dt timestamp_ntz, client_phone string, card_num string, point_from string, point_to string, "
        "distance decimal(10,2), price decimal(10,2)")


def test_event_pivot_edges(spark):
    mv = movement(spark, [
        (1, "K1 ", 1, "READY", T(2024, 1, 2, 10, 5)), (2, "K1 ", 1, "BEGIN", T(2024, 1, 2, 10, 7)),
        (3, "K1 ", 1, "END", T(2024, 1, 2, 10, 30)), (4, "K1 ", 1, "CANCEL", T(2024, 1, 2, 10, 8)),  # END and CANCEL
        (5, "K1", 2, "READY", T(2024, 1, 2, 11)), (6, "K1", 2, "READY", T(2024, 1, 2, 11, 1)),       # repeated READY
        (7, "K1", 2, "CANCEL", T(2024, 1, 2, 11, 2)),
        (8, "K1", 3, "BEGIN", T(2024, 1, 2, 12)), (9, "K1", 3, "END", T(2024, 1, 2, 12)),           # no READY, 0 s
        (10, "K1", 4, "READY", T(2024, 1, 2, 13)),                                                   # unfinished
    ])
    out = {r.ride_id: r for r in facts.finished_rides(mv, rides(spark, [1, 2, 3, 4])).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].ride_end_dt == T(2024, 1, 2, 10, 30) and out[1].car_plate_num == "K1"
    assert out[2].ride_arrival_dt == T(2024, 1, 2, 11, 1) and out[2].ride_start_dt is None
    assert out[3].ride_arrival_dt is None
    # zero duration is never a violation and has no speed
    row = spark.createDataFrame([(Decimal("5.00"), 0), (Decimal("85.01"), 3600), (Decimal("85.00"), 3600)],
                                "d decimal(10,2), s long") \
        .select(speed_over_limit(F.col("d"), F.col("s")).alias("v"), speed_hundredths(F.col("d"), F.col("s")).alias("x")) \
        .collect()
    assert [(r.v, r.x) for r in row] == [(False, None), (True, Decimal("85.01")), (False, Decimal("85.00"))]


def test_lookup_bounds_and_gaps(spark):
    fin = spark.createDataFrame([
        (1, T(2024, 1, 2, 8, 0), "K1"),      # on the start bound
        (2, T(2024, 1, 2, 20, 0), "K1"),     # on the stop bound
        (3, T(2024, 1, 2, 20, 0, 1), "K1"),  # just after: between shifts
        (4, T(2024, 1, 3, 1, 0), "K1"),      # inside a shift that began the day before
    ], "ride_id long, dt timestamp_ntz, car_plate_num string")
    wb = spark.createDataFrame([
        ("W1", "D1", "K1", T(2024, 1, 2, 8), T(2024, 1, 2, 20), T(2024, 1, 2)),
        ("W2", "D2", "K1", T(2024, 1, 2, 22), T(2024, 1, 3, 6), T(2024, 1, 2)),
    ], "waybill_num string, driver_pers_num string, car_plate_num string, work_start_dt timestamp_ntz, "
       "work_end_dt timestamp_ntz, issue_dt timestamp_ntz")
    got = {r.ride_id: r.driver_pers_num for r in facts.ride_driver_lookup(fin, wb).collect()}
    assert got == {1: "D1", 2: "D1", 3: None, 4: "D2"}


def test_client_versions_a_b_a(spark):
    hist = spark.createDataFrame([
        ("+7", "A", T(2024, 1, 1)), ("+7", "B", T(2024, 1, 5)), ("+7", "A", T(2024, 1, 9)),
    ], "client_phone string, card_num string, dt timestamp_ntz")
    v = versions_from_history(hist, "client_phone", "card_num", "dt", key_out="phone_num").orderBy("start_dt").collect()
    assert [(r.card_num, r.start_dt, r.end_dt) for r in v] == [
        ("A", T(2024, 1, 1), T(2024, 1, 4, 23, 59, 59)), ("B", T(2024, 1, 5), OPEN)]


def _dim(spark, rows):
    return spark.createDataFrame(rows, "k string, start_dt timestamp_ntz, card string, end_dt timestamp_ntz")


def test_scd2_null_tracked_and_modes(spark):
    dim = _dim(spark, [("a", T(2024, 1, 1), None, OPEN), ("b", T(2024, 1, 1), "x", OPEN)])
    delta = _dim(spark, [("a", T(2024, 1, 3), "y", OPEN), ("b", T(2024, 1, 3), "x", OPEN),
                         ("b", T(2024, 1, 4), "z", OPEN)])
    parity = {(r.k, r.start_dt): r.end_dt for r in scd2_apply(dim, delta, "k", "card", mode="parity").collect()}
    # NULL never differs in parity: "a" stays open next to its new version
    assert parity[("a", T(2024, 1, 1))] == OPEN and parity[("a", T(2024, 1, 3))] == OPEN
    # parity closes "b" at the earliest differing delta row
    assert parity[("b", T(2024, 1, 1))] == T(2024, 1, 3, 23, 59, 59)
    strict = scd2_apply(dim, delta, "k", "card", mode="strict")
    got = sorted((r.k, r.start_dt, r.card, r.end_dt) for r in strict.collect())
    assert got == [
        ("a", T(2024, 1, 1), None, T(2024, 1, 2, 23, 59, 59)), ("a", T(2024, 1, 3), "y", OPEN),
        ("b", T(2024, 1, 1), "x", T(2024, 1, 3, 23, 59, 59)), ("b", T(2024, 1, 4), "z", OPEN)]
    # re-applying the same delta changes nothing
    again = scd2_apply(strict, delta, "k", "card", mode="strict")
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in strict.collect())


def test_driver_registered_on_report_day(spark):
    dim = spark.createDataFrame([("p1", T(2024, 1, 16, 9), OPEN), ("p2", T(2024, 1, 1), OPEN)],
                                "personnel_num string, start_dt timestamp_ntz, end_dt timestamp_ntz")
    assert [r.personnel_num for r in as_of(dim, dt.date(2024, 1, 16)).collect()] == ["p2"]


def _waybills(spark, rows):
    return spark.createDataFrame(
        [(f"W{i}", "D", "K", s, e, s) for i, (s, e) in enumerate(rows)],
        "waybill_num string, driver_pers_num string, car_plate_num string, work_start_dt timestamp_ntz, "
        "work_end_dt timestamp_ntz, issue_dt timestamp_ntz")


def test_overtime_shapes(spark):
    day = dt.date(2024, 1, 16)
    single = _waybills(spark, [(T(2024, 1, 16, 8), T(2024, 1, 16, 17))])              # one 9 h shift
    assert marts.drivers_overtime(single, day).count() == 0                           # never reported (parity)
    assert [r.total_work_time for r in marts.drivers_overtime_clipped(single, day).collect()] == [9 * 3600]
    three = _waybills(spark, [(T(2024, 1, 16, 0), T(2024, 1, 16, 5)), (T(2024, 1, 16, 6), T(2024, 1, 16, 11)),
                              (T(2024, 1, 16, 12), T(2024, 1, 16, 17))])
    clipped = sorted(r.total_work_time for r in marts.drivers_overtime_clipped(three, day).collect())
    assert clipped == [10 * 3600, 15 * 3600]                                          # from 06:00 and from 00:00
    apart = _waybills(spark, [(T(2024, 1, 16, 8), T(2024, 1, 16, 13)), (T(2024, 1, 17, 8), T(2024, 1, 17, 13))])
    assert marts.drivers_overtime_clipped(apart, day).count() == 0                    # 24 h apart: not together


def test_card_shared_by_two_phones(spark):
    dc = spark.createDataFrame([("+71", T(2024, 1, 1), "4000 0000 0000 0001", OPEN, False),
                                ("+72", T(2024, 1, 1), "4000 0000 0000 0001", OPEN, False)],
                               "phone_num string, start_dt timestamp_ntz, card_num string, end_dt timestamp_ntz, "
                               "deleted_flag boolean")
    fp = spark.createDataFrame([("x", T(2024, 1, 2), "4000000000000001", Decimal("100.00"))],
                               "transaction_id string, transaction_dt timestamp_ntz, card_num string, "
                               "transaction_amt decimal(18,2)")
    fr = spark.createDataFrame([], "ride_id long, point_from_txt string, point_to_txt string, distance_val decimal(10,2), "
                               "price_amt decimal(10,2), client_phone_num string, driver_pers_num string, "
                               "car_plate_num string, ride_arrival_dt timestamp_ntz, ride_start_dt timestamp_ntz, "
                               "ride_end_dt timestamp_ntz")
    h = marts.clients_hist(dc, fp, fr).collect()
    # the payment counts for both phones (parity: joined by card alone), so both owe -100
    assert sorted((r.phone_num, r.spent_amt, r.debt_amt) for r in h) == [
        ("+71", Decimal("100.00"), Decimal("-100.00")), ("+72", Decimal("100.00"), Decimal("-100.00"))]


def test_scalars(spark):
    df = spark.createDataFrame([("05.01.2024 01:02:03", "0000123412341234"), ("31.02.2024 10:00:00", None),
                                ("junk", "1"), ("2024-01-05 01:02", "x")], "t string, c string")
    got = df.select(parse_dayfirst("t").alias("ts"), format_card("c").alias("f")).collect()
    assert got[0].ts == T(2024, 1, 5, 1, 2, 3) and got[0].f == "0000 1234 1234 1234"
    assert got[1].ts is None and got[1].f is None
    assert got[2].ts is None
    assert got[3].ts == T(2024, 1, 5, 1, 2)


def test_versions_on_every_change(spark):
    from cabwh.operators.scd2 import versions_on_change

    hist = spark.createDataFrame([
        ("+7", "A", T(2024, 1, 1), 1), ("+7", None, T(2024, 1, 2), 2), ("+7", "B", T(2024, 1, 5), 3),
        ("+7", "B", T(2024, 1, 6), 4), ("+7", "A", T(2024, 1, 9), 5), ("+8", "C", T(2024, 1, 9), 6),
    ], "client_phone string, card_num string, dt timestamp_ntz, ride_id long")
    v = versions_on_change(hist, "client_phone", "card_num", "dt", "ride_id", key_out="phone_num").collect()
    got = sorted((r.phone_num, r.start_dt, r.card_num, r.end_dt) for r in v)
    assert [(p, s, c) for p, s, c, _ in got] == [
        ("+7", T(2024, 1, 1), "A"), ("+7", T(2024, 1, 2), None), ("+7", T(2024, 1, 5), "B"), ("+7", T(2024, 1, 9), "A"),
        ("+8", T(2024, 1, 9), "C")]
    assert got[2][3] == T(2024, 1, 8, 23, 59, 59) and got[3][3] == OPEN


def test_payout_version_at_end_of_day(spark):
    fr = spark.createDataFrame(
        [(1, "A", "B", Decimal("10.00"), Decimal("100.00"), "+7", "p1", "K", T(2024, 1, 16, 9), T(2024, 1, 16, 10),
          T(2024, 1, 16, 11))],
        "ride_id long, point_from_txt string, point_to_txt string, distance_val decimal(10,2), price_amt decimal(10,2), "
        "client_phone_num string, driver_pers_num string, car_plate_num string, ride_arrival_dt timestamp_ntz, "
        "ride_start_dt timestamp_ntz, ride_end_dt timestamp_ntz")
    dd = spark.createDataFrame([("p1", T(2024, 1, 16, 8), "L", "F", "M", "card", OPEN)],
                               "personnel_num string, start_dt timestamp_ntz, last_name string, first_name string, "
                               "middle_name string, card_num string, end_dt timestamp_ntz")
    day = dt.date(2024, 1, 16)
    assert marts.drivers_payments(fr, dd, day).count() == 0                    # registered during the day
    row = marts.drivers_payments(fr, dd, day, version_at="end").collect()
    assert [r.amount for r in row] == [Decimal("80.00") - Decimal("83.08")]    # 0.8 * 100 - 8.3082 * 10


def test_half_open_versions_catch_the_gap(spark):
    from cabwh.operators.lookup import interval_join

    ver = spark.createDataFrame([("+7", T(2024, 1, 1), T(2024, 1, 4, 23, 59, 59), "A"), ("+7", T(2024, 1, 5), OPEN, "B")],
                                "phone string, s timestamp_ntz, e timestamp_ntz, card string")
    facts_df = spark.createDataFrame([(1, "+7", T(2024, 1, 4, 23, 59, 59, 500000)), (2, "+7", T(2024, 1, 5))],
                                     "id long, p string, ts timestamp_ntz")
    closed = {r.id: r.card for r in interval_join(facts_df, ver, "p", "ts", "phone", "s", "e").collect()}
    half = {r.id: r.card for r in interval_join(facts_df, ver, "p", "ts", "phone", "s", "e", half_open=True).collect()}
    assert closed == {2: "B"}                        # 23:59:59.5 falls into the 1 s gap
    assert half == {1: "A", 2: "B"}
