"""Properties: split windows equal plain windows, increments equal one full load, loads are idempotent."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cabwh.operators.windows import running_index, sliding_sum, sliding_sum_simple
from cabwh.operators.writes import dedupe_keep_last, insert_ignore, insert_ignore_result, upsert
from cabwh.plans import marts
from cabwh.plans.warehouse import Warehouse
from cabwh.sources.fixtures import REPORT_DAY

DAY_US = 24 * 3600 * 1_000_000


def test_sliding_sum_equals_plain_window_with_a_hot_key(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 20)           # one key holds ~40 % of the rows
        ts = base + dt.timedelta(seconds=rnd.randint(0, 10 * 86400), microseconds=rnd.choice([0, 5, 999999]))
        rows.append((i, key, ts, rnd.randint(-50, 500)))
    rows.append((3000, 0, rows[0][2], 7))                                   # a peer with an equal timestamp
    rows.append((3001, 0, rows[0][2] + dt.timedelta(days=1), 11))           # exactly 24 h later: boundary
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v long")
    b = {r.id: r.s for r in sliding_sum_simple(df, "k", "ts", "v", DAY_US, "s").collect()}
    for strategy in ("halo", "prefix"):
        a = {r.id: r.s for r in sliding_sum(df, "k", "ts", "v", DAY_US, "s", id_col="id", strategy=strategy).collect()}
        assert a == b and len(a) == len(rows), strategy


def test_running_index_equals_row_number(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([0, 0, 0, 1, 2]), dt.date(2024, 1, rnd.randint(1, 9))) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k long, d date")
    a = {r.id: r.n for r in running_index(df, "k", "d", "id", "n").collect()}
    w = Window.partitionBy("k").orderBy("d", "id")
    b = {r.id: r.n for r in df.withColumn("n", F.row_number().over(w) - 1).collect()}
    assert a == b


def test_daily_violation_reports_equal_one_full_pass(spark, sf_small):
    fr = Warehouse(spark, sf_small).fact_rides
    full = marts.drivers_violations_full(fr)
    prior = None
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)]
    for day in days:                                   # the mart grows one day at a time
        rows = marts.drivers_violations(fr, prior, day)
        prior = rows if prior is None else prior.unionByName(rows)
        prior = prior.checkpoint()  # cut the growing lineage (reliable checkpoint dir)
    key = ["personnel_num", "ride", "speed", "violations_cnt", "report_dt"]
    assert sorted(tuple(r) for r in prior.select(*key).collect()) == sorted(tuple(r) for r in full.select(*key).collect())


def test_insert_ignore_twice_is_once(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    fr = wh.fact_rides
    half = fr.filter(F.col("ride_id") % 2 == 0)
    once = insert_ignore_result(half, fr, ["ride_id"])
    twice = insert_ignore_result(once, fr, ["ride_id"])
    assert once.count() == twice.count() == fr.count()
    assert insert_ignore(twice, fr, ["ride_id"]).count() == 0


def test_upsert_and_dedupe_idempotent(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    h = marts.clients_hist(wh.dim_clients, wh.fact_payments, wh.fact_rides)
    cols = ["rides_cnt", "cancelled_cnt", "spent_amt", "debt_amt", "end_dt", "deleted_flag"]
    once = upsert(h, h, ["client_id"], cols)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, h.collect()))
    dc = wh.dim_clients
    both = dc.withColumn("s", F.lit(1)).unionByName(dc.withColumn("s", F.lit(2)))
    assert dedupe_keep_last(both, ["phone_num", "start_dt"], "s").count() == dc.count()


def test_scd2_invariants(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    for dim, key in ((wh.dim_clients, "phone_num"), (wh.dim_drivers, "personnel_num"), (wh.dim_cars, "plate_num")):
        d = dim.filter(F.col(key).isNotNull())
        w = Window.partitionBy(key).orderBy("start_dt")
        chk = d.withColumn("_next", F.lead("start_dt").over(w))
        # each version ends one second before the next one starts; only the last is open
        bad = chk.filter(F.col("_next").isNotNull()
                         & (F.col("end_dt") != F.col("_next") - F.expr("INTERVAL 1 SECOND")))
        assert bad.count() == 0
        opened = d.filter(F.col("end_dt") == F.lit("9999-01-01 00:00:00").cast("timestamp_ntz"))
        assert opened.groupBy(key).count().filter("count > 1").count() == 0


def test_payout_report_uses_half_open_day(spark, sf_small):
    wh = Warehouse(spark, sf_small)
    p = marts.drivers_payments(wh.fact_rides, wh.dim_drivers, REPORT_DAY)
    assert p.select("report_dt").distinct().collect()[0][0] == REPORT_DAY


def test_split_lag_equals_lag(spark):
    from cabwh.operators.windows import split_lag

    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = [(f"w{i}", rnd.choice(["a", "a", "a", "b", "c"]),
             base + dt.timedelta(hours=rnd.choice([0, 5, 30, 31, 100, 250]) + rnd.randint(0, 3))) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz")
    a = {r.id: r.p for r in split_lag(df, "k", "ts", "id", "p").collect()}
    w = Window.partitionBy("k").orderBy("ts", "id")
    b = {r.id: r.p for r in df.withColumn("p", F.lag("ts").over(w)).collect()}
    assert a == b


def test_range_sum_frames_equal_plain_window(spark):
    from cabwh.functions import epoch_micros
    from cabwh.operators.windows import range_sum

    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice([0, 0, 1, 2]), base + dt.timedelta(seconds=rnd.randint(0, 5 * 86400)), rnd.randint(0, 99))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v long")
    for lo, hi in ((-DAY_US, 0), (0, DAY_US - 1), (-3600_000_000, 7200_000_000)):
        a = {r.id: r.s for r in range_sum(df, "k", "ts", "v", lo, hi, "s").collect()}
        w = Window.partitionBy("k").orderBy(epoch_micros("ts")).rangeBetween(lo, hi)
        b = {r.id: r.s for r in df.withColumn("s", F.sum("v").over(w)).collect()}
        assert a == b, (lo, hi)


def test_clipped_overtime_equals_brute_force(spark):
    day = dt.date(2024, 1, 16)
    t0 = dt.datetime(2024, 1, 16)
    rnd = random.Random(13)
    rows = []
    for i in range(400):
        drv = rnd.choice(["a", "a", "a", "b", "c"])
        s = t0 + dt.timedelta(minutes=rnd.randint(-300, 2 * 1440))
        e = s + dt.timedelta(minutes=rnd.choice([30, 300, 600, 1500, 2000]))   # some longer than 24 h
        rows.append((f"w{i}", drv, "K", s, e, s))
    rows.append(("wx", "a", "K", rows[0][3], rows[0][4], rows[0][3]))          # equal start
    wb = spark.createDataFrame(rows, "waybill_num string, driver_pers_num string, car_plate_num string, "
                                     "work_start_dt timestamp_ntz, work_end_dt timestamp_ntz, issue_dt timestamp_ntz")
    got = sorted((r.personnel_num, r.period_start, r.total_work_time)
                 for r in marts.drivers_overtime_clipped(wb, day).collect())
    want = []
    for _, d_i, _, s_i, _, _ in rows:
        if not (t0 <= s_i < t0 + dt.timedelta(days=1)):
            continue
        lim = s_i + dt.timedelta(days=1)
        tot = sum(int((min(e_j, lim) - s_j).total_seconds()) for _, d_j, _, s_j, e_j, _ in rows
                  if d_j == d_i and s_i <= s_j < lim)
        if tot > 8 * 3600:
            want.append((d_i, s_i, tot))
    assert got == sorted(want) and len(got) > 10


def test_split_lookup_equals_brute_force(spark):
    from cabwh.operators.lookup import point_in_time_lookup

    rnd = random.Random(17)
    base = dt.datetime(2024, 1, 2)
    facts_rows = [(i, rnd.choice(["K1"] * 6 + ["K2", "K3"]), base + dt.timedelta(minutes=rnd.randint(0, 2 * 1440)))
                  for i in range(3000)]                                   # K1 is hot
    iv_rows = []
    for car in ("K1", "K2", "K3"):
        for h in range(0, 48, 5):
            s = base + dt.timedelta(hours=h)
            iv_rows.append((f"W{car}{h}", f"D{car}{h % 3}", car, s, s + dt.timedelta(hours=rnd.choice([3, 6, 9]))))
    iv_rows.append(("Wopen", "Dopen", "K3", base + dt.timedelta(hours=40), dt.datetime(9999, 12, 31)))
    facts_rows += [(9001, None, base), (9002, "K1", None)]
    fa = spark.createDataFrame(facts_rows, "ride_id long, car_plate_num string, dt timestamp_ntz")
    iv = spark.createDataFrame(iv_rows, "waybill_num string, driver_pers_num string, car_plate_num string, "
                                        "work_start_dt timestamp_ntz, work_end_dt timestamp_ntz")
    args = dict(fact_id="ride_id", fact_key="car_plate_num", fact_ts="dt", iv_key="car_plate_num",
                iv_start="work_start_dt", iv_end="work_end_dt", order=["work_start_dt", "waybill_num"],
                take=["waybill_num", "driver_pers_num"])
    got = {r.ride_id: (r.waybill_num, r["_matches"]) for r in point_in_time_lookup(fa, iv, **args).collect()}
    for ride, car, at in facts_rows:
        hits = sorted((s, w) for w, _, c, s, e in iv_rows if c == car and at is not None and s <= at <= e)
        assert got[ride] == (hits[0][1] if hits else None, len(hits))
    assert len(got) == len(facts_rows)


def test_interval_join_splits_a_hot_key(spark):
    from cabwh.operators.lookup import interval_join

    base = dt.datetime(2024, 1, 1)
    fact_rows = [(i, "hot" if i % 3 else f"p{i % 50}", base + dt.timedelta(hours=i % 700)) for i in range(2000)]
    versions = [(k, s, base + dt.timedelta(days=d, hours=23)) for k in ["hot", *[f"p{i}" for i in range(50)]]
                for d in range(0, 30, 5) for s in [base + dt.timedelta(days=d)]]
    fa = spark.createDataFrame(fact_rows, "i long, phone string, at timestamp_ntz")
    ve = spark.createDataFrame(versions, "key string, s timestamp_ntz, e timestamp_ntz")
    got = interval_join(fa, ve, "phone", "at", "key", "s", "e")
    assert got.columns == ["i", "phone", "at", "key", "s", "e"]
    want = [(*f, *v) for f in fact_rows for v in versions if f[1] == v[0] and v[1] <= f[2] <= v[2]]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_only_versions_of_hot_keys_are_copied(spark, monkeypatch):
    from cabwh.operators import lookup

    monkeypatch.setattr(lookup, "HOT_ROWS", 300)
    base = dt.datetime(2024, 1, 1)
    fact_rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"p{i % 50}", base + dt.timedelta(hours=i % 700))
                 for i in range(2000)]
    versions = [(k, base, base + dt.timedelta(days=15)) for k in ["hot", None, *[f"p{i}" for i in range(50)]]]
    fa = spark.createDataFrame(fact_rows, "i long, phone string, at timestamp_ntz")
    ve = spark.createDataFrame(versions, "key string, s timestamp_ntz, e timestamp_ntz")
    assert fa.select(lookup.hot_keys(fa, "phone").alias("h")).first().h == ["hot"]
    got = lookup.interval_join(fa, ve, "phone", "at", "key", "s", "e")
    want = [(*f, *v) for f in fact_rows for v in versions if f[1] and f[1] == v[0] and v[1] <= f[2] <= v[2]]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_exploded_sides_are_never_broadcast(spark):
    """Spark takes an exploded table for as small as what it is made of; a broadcast goes through the driver whole."""
    from cabwh.operators.lookup import interval_join, point_in_time_lookup

    at = dt.datetime(2024, 1, 2)
    fa = spark.createDataFrame([(1, "K1", at)], "ride_id long, car string, dt timestamp_ntz")
    iv = spark.createDataFrame([("W1", "K1", at, at)], "num string, car string, s timestamp_ntz, e timestamp_ntz")
    looked = point_in_time_lookup(fa, iv, "ride_id", "car", "dt", "car", "s", "e", ["s", "num"], ["num"])
    joined = interval_join(fa.select("ride_id", F.col("car").alias("key"), "dt"), iv, "key", "dt", "car", "s", "e")
    for out in (looked, joined):
        assert out.count() == 1
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_pivot_equals_spark_pivot(spark, sf_small):
    from cabwh.operators.pivot import pivot_events, pivot_events_grouped
    from cabwh.sources.fixtures import load_sources

    mv = load_sources(spark, sf_small).movement
    mapping = {"READY": "arrival", "BEGIN": "start", "END": "end", "CANCEL": "cancel", "LOST": "lost"}  # LOST: absent
    a = sorted(map(tuple, pivot_events(mv, "ride", "event", "dt", mapping).collect()), key=str)
    b = sorted(map(tuple, pivot_events_grouped(mv, "ride", "event", "dt", mapping).collect()), key=str)
    assert a == b and len(a) == 1500 and all(r[-1] is None for r in a)


def test_running_index_reads_its_input_once(spark, tmp_path):
    spark.range(5000).selectExpr("id % 7 as k", "id % 13 as d", "id", "id * 2 as v").write.parquet(str(tmp_path / "t"))
    out = running_index(spark.read.parquet(str(tmp_path / "t")).filter("v < 9000"), "k", "d", "id", "n")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_versions_without_a_key_are_one_chain_in_many_tasks(spark):
    from cabwh.operators.scd2 import versions_from_history

    rnd = random.Random(8)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(None if i % 3 == 0 else f"p{i % 5}", f"c{rnd.randint(0, 300)}", t0 + dt.timedelta(seconds=i * 9973)) for i in range(900)]
    df = spark.createDataFrame(rows, "phone string, card string, dt timestamp_ntz")
    first = {}
    for p, c, t in rows:
        first[p, c] = min(t, first.get((p, c), t))
    want = set()
    for (p, c), t in first.items():
        later = [x for (q, _), x in first.items() if q == p and x > t]
        want.add((p, t, c, min(later) - dt.timedelta(seconds=1) if later else dt.datetime(9999, 1, 1)))
    got = versions_from_history(df, "phone", "card", "dt")
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
