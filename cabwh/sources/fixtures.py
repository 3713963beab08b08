"""Fleet source tables derived from the given tables (FIXTURES.md §3).

The warehouse sources (rides, car status events, drivers, cars, waybills, payments, batch
ledger) do not exist in the test data; they are computed here, row for row, from
``orders``, ``supplier`` and ``events`` with the formulas of FIXTURES.md. The DuckDB oracle
(``cabwh.oracle.derive``) computes the same tables with the same formulas in SQL.

Every table is one narrow projection of one scan; nothing is collected except the
supplier count ``n`` (a scalar that fixes the car of each ride).
"""

from __future__ import annotations

import datetime as _dt
import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabwh.constants import EVENT_BEGIN, EVENT_CANCEL, EVENT_END, EVENT_READY, STATUS_FAILURE, STATUS_SUCCESS
from cabwh.functions.time import add_seconds, ts_lit
from cabwh.sources.tables import read_table

# --- fixed values: fixture calendar (FIXTURES.md) ------------------------------
T0 = "2024-01-01 00:00:00"
REPORT_DAY = _dt.date(2024, 1, 16)        # day 15: a double-shift day
DAYS = 30
DAY_SHIFT_START_S, DAY_SHIFT_STOP_S = 1800, 43200
NIGHT_SHIFT_START_S, NIGHT_SHIFT_STOP_S = 42600, 86399
NO_WAYBILL_PLATE = 99999
# batch cut used by the incremental (two-load) queries
BATCH1_UNTIL = "2024-01-16 00:00:00"
DRIVER_DELTA_DAY = 12                      # drivers with p % 4 = 1 change card on day 12
CLIENT_CARD_CHANGE_DAY = 10


def z(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def day_offset(days) -> Column:
    d = days if isinstance(days, Column) else F.lit(days)
    return ts_lit(T0) + F.make_dt_interval(d.cast("int"))


def supplier_count(spark: SparkSession, sf_dir: str) -> int:
    """Number of suppliers (= cars): a scalar."""
    return read_table(spark, sf_dir, "supplier", ["s_suppkey"]).count()


def _at(seconds: Column) -> Column:
    """The time so many seconds after the first day's midnight."""
    return add_seconds(ts_lit(T0), seconds)


# a ride's times, in seconds after the first day's midnight: what an event or a payment is picked by, so they are plain
# integers
def _ordered_s(k: Column) -> Column:
    return (k % DAYS) * 86400 + (k * 7919) % 72000 + 3600


def _begin_s(k: Column) -> Column:
    return _ordered_s(k) + k % 300 + 420


def _tenths(k: Column) -> Column:
    """The distance in tenths of a km."""
    return (k * 31) % 400 + 10


def _end_s(k: Column) -> Column:
    return _begin_s(k) + F.floor(_tenths(k) * 360 / (k % 90 + 30)) + 1


def _no_end(k: Column) -> Column:
    """The ride is cancelled or its END event is missing."""
    return ((k % 11) == 0) | ((k % 13) == 0)


def _car(k: Column, n: int) -> Column:
    return F.call_function("div", k - F.pmod(k, F.lit(DAYS)), F.lit(DAYS)) % F.lit(n)


def rides(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    card_tail = F.when(((c % 3) == 0) & ((k % DAYS) >= CLIENT_CARD_CHANGE_DAY), F.lit("1")).otherwise(F.lit("0"))
    return orders.select(
        k.alias("ride_id"),
        _at(_ordered_s(k)).alias("dt"),
        F.concat(F.lit("+7"), z(c, 10)).alias("client_phone"),
        F.concat(F.lit("4000 0000 "), z(c % 10000, 4), F.lit(" 000"), card_tail).alias("card_num"),
        F.concat(F.lit("A"), (k % 17).cast("string")).alias("point_from"),
        F.concat(F.lit("B"), (k % 19).cast("string")).alias("point_to"),
        (_tenths(k).cast("decimal(12,0)") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(10,2)").alias("distance"),
        F.floor(F.col("o_totalprice") / 100).cast("decimal(10,2)").alias("price"),
    )


def movement(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """READY / BEGIN / END / CANCEL rows of every ride: a scan of the keys for each, so that a filter by time is asked
    of the scan and not of a generated row."""
    k = F.col("o_orderkey")
    plate = F.concat(F.lit("K"), z(F.when((k % 97) == 0, F.lit(NO_WAYBILL_PLATE)).otherwise(_car(k, n)), 5), F.lit("  "))
    cancelled = (k % 11) == 0
    keys = read_table(spark, sf_dir, "orders", ["o_orderkey"])

    def ev(offset: int, name: str, seconds: Column, keep: Column | None = None) -> DataFrame:
        return (keys if keep is None else keys.filter(keep)).select(
            (k * 4 + offset).alias("movement_id"), plate.alias("car_plate_num"), k.alias("ride"),
            F.lit(name).alias("event"), _at(seconds).alias("dt"))

    return (ev(0, EVENT_READY, _ordered_s(k) + k % 300 + 300)
            .unionByName(ev(1, EVENT_BEGIN, _begin_s(k), ~cancelled))
            .unionByName(ev(2, EVENT_END, _end_s(k), ~_no_end(k)))
            .unionByName(ev(3, EVENT_CANCEL, _begin_s(k), cancelled)))


def _people(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Two drivers per supplier: the day driver p = s and the night driver p = s + n."""
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    night = F.col("_night")
    p = F.col("s_suppkey") + F.when(night, F.lit(n)).otherwise(F.lit(0))
    return (
        sup.select("s_suppkey", "s_name", F.explode(F.array(F.lit(False), F.lit(True))).alias("_night"))
        .select(
            p.alias("p"),
            F.concat(F.lit("L"), z(p, 6)).alias("driver_license"),
            F.when(night, F.concat(F.lit("Night"), F.col("s_name"))).otherwise(F.col("s_name")).alias("last_name"),
            F.concat(F.lit("F"), (p % 7).cast("string")).alias("first_name"),
            F.when((p % 17) == 16, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("M"), (p % 5).cast("string"))).alias("middle_name"),
            F.date_add(F.lit("1980-01-01").cast("date"), ((p * 37) % 5000).cast("int")).alias("birth_dt"),
            F.lit("2030-01-01").cast("date").alias("driver_valid_to"),
        )
    )


def drivers(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    p = F.col("p")
    return _people(spark, sf_dir, n).select(
        "driver_license", "first_name", "last_name", "middle_name", "birth_dt",
        F.concat(F.lit("5000 0000 0000 "), z(p % 10000, 4)).alias("card_num"),
        "driver_valid_to",
        add_seconds(day_offset(p % 10), 3600).alias("update_dt"),
    )


def drivers_delta(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Source rows updated in place on day 12: drivers with p % 4 = 1 get a new card."""
    p = F.col("p")
    return _people(spark, sf_dir, n).filter((p % 4) == 1).select(
        "driver_license", "first_name", "last_name", "middle_name", "birth_dt",
        F.concat(F.lit("5000 0000 0001 "), z(p % 10000, 4)).alias("card_num"),
        "driver_valid_to",
        add_seconds(day_offset(DRIVER_DELTA_DAY), 7200).alias("update_dt"),
    )


def waybills(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Flat waybills: each supplier's car has a day and a night shift on each of the 30 days.

    A supplier is 60 waybills, so the suppliers are dealt out first: their one small file would be one task's.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"]).repartition(tasks, "s_suppkey")
    s, d, night = F.col("s_suppkey"), F.col("_d"), F.col("_night")
    same_driver = (~night) | ((d % 3) == 0)
    p = F.when(same_driver, s).otherwise(s + F.lit(n))
    base = day_offset(d)
    return (
        sup.select("s_suppkey", "s_name", F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1))).alias("_d"))
        .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("_night"))
        .select(
            F.concat(F.lit("W"), ((s * DAYS + d) * 2 + night.cast("int")).cast("string")).alias("number"),
            base.alias("issuedt"),
            F.lit("M").alias("model"),
            F.concat(F.lit("K"), z(s, 5)).alias("car"),
            F.when(same_driver, F.col("s_name")).otherwise(F.concat(F.lit("Night"), F.col("s_name"))).alias("name"),
            F.concat(F.lit("L"), z(p, 6)).alias("license"),
            F.lit("2030-01-01").cast("date").alias("validto"),
            add_seconds(base, F.when(night, F.lit(NIGHT_SHIFT_START_S)).otherwise(F.lit(DAY_SHIFT_START_S)))
            .alias("start"),
            add_seconds(base, F.when(night, F.lit(NIGHT_SHIFT_STOP_S)).otherwise(F.lit(DAY_SHIFT_STOP_S)))
            .alias("stop"),
        )
    )


def payments(spark: SparkSession, sf_dir: str, n: int, after: _dt.datetime | None = None,
             until: _dt.datetime | None = None) -> DataFrame:
    """Payment file rows: one per completed ride with k % 5 <> 0, paid 60 s after END; with ``after`` and ``until`` those
    paid in (after, until].

    ``transaction_dt`` is the raw day-first text and ``card_num`` has no blanks, as in the file. The rows are those of
    the rides joined to the END events by ride id: an order that comes m times brings m rows for each of them.
    """
    k = F.col("ride_id")
    paid = rides(spark, sf_dir, n).filter(((k % 5) != 0) & ~_no_end(k)).select(
        "ride_id", "card_num", "price", _at(_end_s(k) + 60).alias("_paid"))
    if after is not None:
        paid = paid.filter(F.col("_paid") > ts_lit(after))
    if until is not None:
        paid = paid.filter(F.col("_paid") <= ts_lit(until))
    ends = F.count(F.lit(1)).over(Window.partitionBy("ride_id")).cast("int")
    return paid.select("*", ends.alias("_ends")).select("*", F.explode(F.array_repeat(F.lit(0), F.col("_ends")))).select(
        F.date_format("_paid", "dd.MM.yyyy HH:mm:ss").alias("transaction_dt"),
        F.regexp_replace("card_num", " ", "").alias("card_num"),
        F.col("price").cast("decimal(18,2)").alias("transaction_amt"),
    )


def damaged_payment_lines(payments: DataFrame) -> DataFrame:
    """Lines of a payment file, some of them damaged by the amount's whole part modulo 50: 7 an impossible date, 17 no
    date, 8 no card, 9 no number, 10 a line without its last field."""
    m = F.col("transaction_amt").cast("bigint") % 50
    when = lambda k, text, c: F.when(m == k, F.lit(text)).otherwise(c)
    date = when(7, "99.99.2024 00:00:00", when(17, "", F.col("transaction_dt")))
    card, amount = when(8, "", F.col("card_num")), when(9, "12,x", F.col("transaction_amt").cast("string"))
    line = F.when(m == 10, F.concat_ws("\t", date, card)).otherwise(F.concat_ws("\t", date, card, amount))
    return payments.select(line.alias("value"))


def car_pool(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    s = F.col("s_suppkey")
    upd = day_offset(s % 10)
    return read_table(spark, sf_dir, "supplier", ["s_suppkey"]).select(
        F.concat(F.lit("K"), z(s, 5), F.lit("  ")).alias("plate_num"),
        F.concat(F.lit("M"), (s % 4).cast("string")).alias("model"),
        F.to_date(upd).alias("revision_dt"),
        upd.alias("update_dt"),
    )


def car_pool_delta(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Rows updated after the first load: inspections (new revision when s % 3 = 0) and new cars."""
    s = F.col("s_suppkey")
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey"])
    first_rev = F.to_date(day_offset(s % 10))
    updated = sup.filter((s % 3) != 2).select(
        F.concat(F.lit("K"), z(s, 5), F.lit("  ")).alias("plate_num"),
        F.concat(F.lit("M"), (s % 4).cast("string")).alias("model"),
        F.when((s % 3) == 0, F.date_add(first_rev, 3)).otherwise(first_rev).alias("revision_dt"),
        day_offset(s % 5 + 10).alias("update_dt"),
    )
    new_cars = sup.filter((s % 4) == 0).select(
        F.concat(F.lit("K"), z(s + F.lit(n), 5), F.lit("  ")).alias("plate_num"),
        F.lit("M9").alias("model"),
        F.lit("2024-01-12").cast("date").alias("revision_dt"),
        day_offset(11).alias("update_dt"),
    )
    return updated.unionByName(new_cars)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch ledger: one run per calendar day of ``events``, started at the day's first event
    (the start time is what a run records); days with day-of-month % 4 = 3 failed."""
    ev = read_table(spark, sf_dir, "events", ["ts"])
    return (
        ev.groupBy(F.to_date("ts").alias("_day"))
        .agg(F.min("ts").alias("loaded_until"))
        .select(
            "loaded_until",
            F.when((F.dayofmonth("_day") % 4) == 3, F.lit(STATUS_FAILURE)).otherwise(F.lit(STATUS_SUCCESS))
            .alias("status"),
        )
    )


class Sources:
    """The fleet sources of one scale factor, each built on first use (a plan that needs two
    tables does not pay for building nine)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def n_cars(self) -> int:
        return supplier_count(self.spark, self.sf_dir)

    def _make(self, fn):
        return fn(self.spark, self.sf_dir, self.n_cars)

    @cached_property
    def rides(self) -> DataFrame:
        return self._make(rides)

    @cached_property
    def movement(self) -> DataFrame:
        return self._make(movement)

    @cached_property
    def drivers(self) -> DataFrame:
        return self._make(drivers)

    @cached_property
    def drivers_delta(self) -> DataFrame:
        return self._make(drivers_delta)

    @cached_property
    def car_pool(self) -> DataFrame:
        return self._make(car_pool)

    @cached_property
    def car_pool_delta(self) -> DataFrame:
        return self._make(car_pool_delta)

    @cached_property
    def waybills(self) -> DataFrame:
        return self._make(waybills)

    @cached_property
    def payments(self) -> DataFrame:
        return self.paid()

    def paid(self, after: _dt.datetime | None = None, until: _dt.datetime | None = None) -> DataFrame:
        """The payments made in (after, until]."""
        return payments(self.spark, self.sf_dir, self.n_cars, after, until)

    def current(self, name: str, until) -> DataFrame:
        """``drivers`` / ``car_pool`` as the source shows them at ``until``: the tables are updated in
        place, so each key shows its newest row written until then."""
        base, delta, key = {"drivers": (self.drivers, self.drivers_delta, "driver_license"),
                            "car_pool": (self.car_pool, self.car_pool_delta, "plate_num")}[name]
        w = Window.partitionBy(key).orderBy(F.col("update_dt").desc())
        return (base.unionByName(delta).filter(F.col("update_dt") <= ts_lit(until))
                .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r"))

    @cached_property
    def ledger(self) -> DataFrame:
        return ledger(self.spark, self.sf_dir)


def load_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The sources of ``sf_dir``, each built when first used."""
    return Sources(spark, sf_dir)
