"""Keys that come again, and several new cards of a client in one load."""

import datetime as dt


from cabwh.operators.scd2 import scd2_apply


def test_parity_keeps_the_ends_a_delta_brings(spark):
    schema = "phone_num string, card_num string, start_dt timestamp_ntz, end_dt timestamp_ntz, deleted_flag boolean"
    t = lambda d, h=0, s=0: dt.datetime(2024, 1, d, h, 59 if s else 0, s)
    end = dt.datetime(9999, 1, 1)
    dim = spark.createDataFrame([("p", "A", t(1), end, False)], schema)
    delta = spark.createDataFrame([("p", "B", t(5), t(6, 9, 59), False), ("p", "C", t(6, 10), end, False)], schema)
    got = scd2_apply(dim, delta, "phone_num", "card_num", start="start_dt", end="end_dt", mode="parity").collect()
    assert sum(r.end_dt.year == 9999 for r in got) == 1
    assert {r.card_num: r.end_dt for r in got}["B"] == t(6, 9, 59)
    assert {r.card_num: r.end_dt.year for r in got}["A"] == 2024


def test_first_stream_batch_stores_a_key_once(spark, tmp_path):
    from cabwh.sources.store import Store
    from cabwh.streaming.intake import _appender

    store = Store(spark, str(tmp_path / "w"))
    run = _appender(store, "t", ["k"], lambda b: b)
    batch = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "k int, v int")
    run(batch, 0)
    run(batch, 1)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, 5), (2, 6)]


def test_a_ride_that_outlasts_the_look_back_is_stored(spark, tmp_path):
    from cabwh.plans.pipeline import Inputs, Pipeline

    t = lambda h, m=0, s=0: dt.datetime(2024, 1, 5, h, m, s)
    day = spark.createDataFrame([(1, t(7), "a", "b", 3.0, 100.0, "+7", "1111 1111 1111 1111")],
                                "ride_id long, dt timestamp_ntz, point_from string, point_to string, distance double, "
                                "price double, client_phone string, card_num string")
    rides = day.select("ride_id", "dt", "point_from", "point_to", day.distance.cast("decimal(10,2)").alias("distance"),
                       day.price.cast("decimal(10,2)").alias("price"), "client_phone", "card_num")
    events = [(1, 1, "READY", t(7, 5), "A1"), (2, 1, "BEGIN", t(7, 10), "A1"), (3, 1, "END", t(10, 0, 1), "A1"),
              (4, 2, "CANCEL", t(9, 30), "A1")]                                # ride 2 has no header yet
    cols = "movement_id long, ride long, event string, dt timestamp_ntz, car_plate_num string"
    drivers = spark.createDataFrame([("L1", t(0), "x", "y", "z", dt.date(1990, 1, 1), "c", dt.date(2030, 1, 1))],
                                    "driver_license string, update_dt timestamp_ntz, last_name string, first_name string, "
                                    "middle_name string, birth_dt date, card_num string, driver_valid_to date")
    cars = spark.createDataFrame([("A1", t(0), "m", dt.date(2023, 1, 1))],
                                 "plate_num string, update_dt timestamp_ntz, model string, revision_dt date")
    bills = spark.createDataFrame([("W1", t(6), "m", "A1", "n", "L1", dt.date(2030, 1, 1), t(6), t(15))],
                                  "number string, issuedt timestamp_ntz, model string, car string, name string, "
                                  "license string, validto date, start timestamp_ntz, stop timestamp_ntz")
    pay = spark.createDataFrame([], "transaction_dt string, card_num string, transaction_amt decimal(18,2)")
    late = rides.withColumn("ride_id", rides.ride_id + 1)

    p = Pipeline(spark, str(tmp_path / "w"))
    for at, headers in ((t(10), rides), (t(14), rides), (t(18), rides.union(late.withColumn("dt", late.dt + dt.timedelta(hours=10))))):
        seen = spark.createDataFrame([e for e in events if e[3] <= at], cols)
        p.run_etl(Inputs(headers, seen, drivers, cars, bills, pay), at)
        if at.hour == 14:
            assert [r.ride_id for r in p.table("fact_rides").collect()] == [1]
    # nothing stays open for good: after OPEN_RIDE_DAYS the ride is set aside and counted
    p.run_etl(Inputs(rides.limit(0), seen.limit(0), drivers, cars, bills, pay), dt.datetime(2024, 3, 1))
    assert p.table("open_rides").count() == 1
    p.run_etl(Inputs(rides.limit(0), seen.limit(0), drivers, cars, bills, pay), dt.datetime(2024, 5, 1))
    assert p.table("open_rides").count() == 0 and [r.ride_id for r in p.table("expired_open_rides").collect()] == [2]
    assert {(r.source, r.rows_read, r.rows_rejected) for r in p.table("work_counts").collect()} >= {("open_rides", 1, 1)}
    return_to = p.store.read("quarantine_rides", version=3)
    # the header of ride 2 came last, with an order time no waybill covers: it is in quarantine, not lost
    assert [r.ride_id for r in return_to.collect()] == [2]
    assert p.table("fact_rides").count() == 1


def test_date_forms(spark):
    from cabwh.functions import parse_dayfirst

    forms = {"2024-01-05": (2024, 1, 5), "05/01/2024": (2024, 1, 5), "05-01-2024 10:20": (2024, 1, 5, 10, 20),
             "2024-01-05T10:20:30.250": (2024, 1, 5, 10, 20, 30, 250000), "2024/01/05 10:20:30Z": (2024, 1, 5, 10, 20, 30),
             "05.01.2024 10:20:30+03:00": (2024, 1, 5, 10, 20, 30), "05.13.2024": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in forms], "t string")
    got = {r.t: r.ts for r in df.select("t", parse_dayfirst("t").alias("ts")).collect()}
    assert got == {k: v and dt.datetime(*v) for k, v in forms.items()}
