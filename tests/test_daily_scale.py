"""The daily run on larger tables: what a run picks of its sources, how a load's files are laid out, the usual date form."""

import datetime as dt
import glob
import random

from pyspark.sql import functions as F

from cabwh.functions import parse_dayfirst, ts_lit
from cabwh.plans.daily import source_inputs
from cabwh.plans.pipeline import Inputs, Pipeline
from cabwh.sources.fixtures import load_sources


def orders_dir(spark, path, keys):
    """Tables with the given order keys; every second customer number is null."""
    rows = [(k, None if i % 2 else i * 7, 100.0 * i + 55.5) for i, k in enumerate(keys)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_totalprice double").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(s, f"S{s}") for s in range(4)], "s_suppkey bigint, s_name string").write.parquet(
        f"{path}/supplier.parquet")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payments_of_a_run_equal_rides_joined_to_their_ends(spark, tmp_path):
    """Repeated and null keys: an order that comes m times brings m * m payments."""
    rng = random.Random(5)
    keys = [rng.randrange(4000) for _ in range(300)]
    src = load_sources(spark, orders_dir(spark, str(tmp_path), keys + keys[:40] * 2 + [None, None, 0, 1, 1, 2]))
    ends = src.movement.filter(F.col("event") == "END").select("ride", F.col("dt").alias("end_dt"))
    joined = src.rides.filter(F.col("ride_id") % 5 != 0).join(ends, F.col("ride_id") == F.col("ride")).select(
        F.date_format(F.col("end_dt") + F.expr("INTERVAL 60 SECOND"), "dd.MM.yyyy HH:mm:ss").alias("transaction_dt"),
        F.regexp_replace("card_num", " ", "").alias("card_num"),
        F.col("price").cast("decimal(18,2)").alias("transaction_amt"))
    assert rows(src.payments) == rows(joined)
    at = parse_dayfirst("transaction_dt")
    after, until = dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 17, 2)
    some = joined.filter((at > ts_lit(after)) & (at <= ts_lit(until)))
    assert 0 < some.count() < joined.count()
    assert rows(source_inputs(src, after, until).payments) == rows(some)
    assert rows(source_inputs(src, None, until).payments) == rows(joined.filter(at <= ts_lit(until)))
    moment = src.payments.select(at.alias("t")).first().t             # the bounds: after the first, up to the second
    earlier = moment - dt.timedelta(seconds=1)
    assert source_inputs(src, moment, moment).payments.count() == 0
    assert source_inputs(src, earlier, moment).payments.count() == joined.filter(at == ts_lit(moment)).count()


def test_a_run_picks_its_rows_while_it_scans(spark, tmp_path):
    """No text is made and parsed again to pick payments, and no event is made to be dropped by its time."""
    src = load_sources(spark, orders_dir(spark, str(tmp_path), range(100)))
    found = source_inputs(src, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 17))
    assert "regexp_extract" not in plan(found.payments) and "Join" not in plan(found.payments)
    assert "Generate" not in plan(found.movement)


def test_the_usual_date_form_is_parsed_as_the_general_patterns_parse_it(spark):
    rng = random.Random(3)
    two = lambda top: f"{rng.randrange(top):02d}"
    texts = [f"{two(40)}.{two(16)}.{rng.choice(['2024', '2023', '0000', '9999', '1900'])} {two(30)}:{two(70)}:{two(70)}"
             for _ in range(2000)]
    texts += ["29.02.2024 23:59:60", "29.02.2023 00:00:00", "01.01.2024 24:00:00", "31.12.9999 23:59:59"]
    odd = ["01.01.2024 00:00:00\n", "1.1.2024 0:00:00", "01.01.2024", "2024-01-02 03:04:05", "01.01.2024T01:02:03", "", None,
           "٠١.٠١.2024 00:00:00", "01.01.2024 00:00:00.5", "01.01.2024 00:00:00+03:00", "x01.01.2024 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts + odd], "t string")
    # a blank behind the text leaves its value as it is and takes the general way
    got = df.select("t", parse_dayfirst("t").cast("string").alias("a"),
                    parse_dayfirst(F.concat("t", F.lit(" "))).cast("string").alias("b")).collect()
    assert [r.t for r in got if r.a != r.b] == []
    assert 100 < sum(r.a is None for r in got) < 1900


def test_a_load_writes_one_file_a_date(spark, tmp_path):
    """Tasks times dates would be thousands of small files."""
    src = load_sources(spark, orders_dir(spark, str(tmp_path / "in"), range(3000)))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(conf)
    spark.conf.set(conf, "false")                        # small tables would be one task
    try:
        p = Pipeline(spark, str(tmp_path / "w"), buckets=2)
        at = dt.datetime(2024, 2, 1)
        p.run_etl(Inputs(rides=src.rides, movement=src.movement, drivers=src.current("drivers", at),
                         car_pool=src.current("car_pool", at), waybills=src.waybills, payments=src.payments), started_at=at)
    finally:
        spark.conf.set(conf, kept)
    for table, part in (("fact_rides", "end_date"), ("fact_waybills", "start_date"), ("fact_payments", "pay_date")):
        dates = glob.glob(f"{tmp_path}/w/{table}/*/{part}=*")
        assert len(dates) >= 10, table
        assert all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in dates), table
