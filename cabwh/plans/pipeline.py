"""The daily job (C24): load facts and dimensions past the ledger watermark, then the marts.

All tables live in one :class:`~cabwh.sources.store.Store` below one warehouse folder (on a cluster: a shared path). A
load publishes everything it wrote, its ledger row included, with one commit; a failed load publishes only the row
``Failure``, so none of its facts is ever seen, and the reports refuse to run until the load was repeated. The
reports of a day are one commit as well.

* ``fact_*``              a part per (date, load), appended by insert-ignore against ``fact_*_keys``, an index of the
  keys stored so far that is probed without a shuffle of it
* ``dim_*``               the part ``open`` (one version per key, replaced by each load) and the versions a load closed
* ``agg_paid``, ``agg_rides``  sums of payments by card and of rides by phone and card version, in hash buckets: a load
  adds its own payments and rides, and moves rides whose client version it closed or opened late
* ``rep_*``               reports, a part per day: a day that is run again is replaced
* ``rep_drivers_violations_state``  each driver's number of violations at the end of a day, a part per day
* ``rep_clients_hist``    the client history in hash buckets by client; only touched buckets are written
* ``work_batchdate``      the batch ledger; ``work_counts`` rows read and rejected by run and drop
* ``rejected_rows``       rows of the drops that do not parse, with the reason
* ``quarantine_rides``    finished rides without a matching waybill
* ``open_rides``, ``open_events``  headers and events of rides that are no facts yet (not finished, no header, no
  waybill): the next batch starts from them, so a ride that outlasts the look-back is not lost; after
  ``OPEN_RIDE_DAYS`` they move to ``expired_open_rides`` and ``expired_open_events``
* ``touched_phones``      phones that loads touched since the last history report; it recomputes only those

Each write is one Spark job; a lost executor only re-runs its tasks from the deterministic inputs, and the deltas
reused by several writes are stored in the shared checkpoint folder, as Parquet: what reads a few of their columns reads
no others, and their rows take a fraction of the disk that checkpointed ones take.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.constants import (
    LOOKBACK_RIDES_H,
    LOOKBACK_WAYBILLS_H,
    OPEN_RIDE_DAYS,
    STATUS_FAILURE,
    STATUS_SUCCESS,
)
from cabwh.functions import ts_lit
from cabwh.operators.buckets import BUCKETS
from cabwh.operators.key_index import KeyIndex
from cabwh.operators.scd2 import open_end
from cabwh.operators.writes import one_per_key
from cabwh.plans import dims, facts, marts
from cabwh.plans.maintained import ClientHistory, ViolationCounts
from cabwh.session import ensure_checkpoint_dir, scratch_path, stored
from cabwh.sources import extract, rejects
from cabwh.sources.store import Load, Store


def append_mart(df: DataFrame, path: str, partition_col: str = "report_dt") -> None:
    """Add one day's report. Dynamic partition overwrite makes a re-run of a day replace
    that day's partition instead of duplicating it; other days are untouched."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


# fact table -> (partition column, timestamp it is the date of)
FACT_PARTITION = {
    "fact_rides": ("end_date", "ride_end_dt"),
    "fact_waybills": ("start_date", "work_start_dt"),
    "fact_payments": ("pay_date", "transaction_dt"),
}


@dataclass
class Inputs:
    """What a batch reads: the source tables (whole; the pipeline applies the watermark, which
    is pushed to the scan) and the file drops of this run (already selected by file time)."""

    rides: DataFrame
    movement: DataFrame
    drivers: DataFrame          # all drivers (the key lookup needs every licence)
    car_pool: DataFrame
    waybills: DataFrame         # flat waybills of the files that arrived since the last run
    payments: DataFrame         # raw payment rows of the files that arrived since the last run
    #: checked rows of the drops ("waybills", "payments"), which replace the two frames above once they are accounted for
    checked: dict[str, DataFrame] = field(default_factory=dict)

    @classmethod
    def read(cls, spark: SparkSession, source: str, waybill_dir: str, payment_dir: str,
             watermark: _dt.datetime, properties: dict | None = None, zone: str = "UTC") -> "Inputs":
        """Source tables from ``source`` (a ``jdbc:`` URL or a Parquet folder) and the drops:
        waybill files changed after watermark - 12 h, payment files after the watermark
        (a wall-clock time of ``zone``)."""
        from cabwh.sources.relational import read_source

        def table(name, split_column=None):
            # the split is planned for the increment; the watermark itself is applied (and pushed) by the load
            return read_source(spark, source, name, properties=properties, split_column=split_column,
                               **({"since_col": "dt", "since": watermark, "lookback_hours": LOOKBACK_RIDES_H}
                                  if split_column else {}))

        waybills = rejects.check_waybills(rejects.read_waybill_documents(
            spark, waybill_dir, watermark - _dt.timedelta(hours=LOOKBACK_WAYBILLS_H), zone))
        payments = rejects.check_payments(rejects.read_payment_text(spark, payment_dir, watermark, zone))
        return cls(
            rides=table("rides", "ride_id"), movement=table("movement", "movement_id"), drivers=table("drivers"),
            car_pool=table("car_pool"), waybills=rejects.good_rows(waybills), payments=rejects.good_rows(payments),
            checked={"waybills": waybills, "payments": payments},
        )


class LoadFailed(RuntimeError):
    """The newest load failed: its reports would show a state that no load left."""


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.store = spark, Store(spark, root)
        self.history, self.violations = ClientHistory(buckets), ViolationCounts()
        ensure_checkpoint_dir(spark)

    # -- ledger (C1, C23) ------------------------------------------------------------------
    def ledger(self) -> DataFrame | None:
        return self.store.read("work_batchdate")

    def watermark(self) -> _dt.datetime:
        led = self.ledger()
        if led is None:
            return _dt.datetime(1900, 1, 1)
        return extract.last_success(led)

    def _add_to_ledger(self, load: Load, started_at: _dt.datetime, status: str) -> None:
        # a row per run: one small file
        rows = extract.record_batch(self.spark, load.read("work_batchdate"), started_at, status)
        load.write("work_batchdate", rows.coalesce(1), "all")

    def record(self, started_at: _dt.datetime, status: str) -> None:
        load = self.store.begin()
        self._add_to_ledger(load, started_at, status)
        load.commit()

    def _account(self, load: Load, inp: Inputs, started_at: _dt.datetime) -> Inputs:
        """Set rows of the drops aside that do not parse, and count them: (loaded_until, source, rows_read,
        rows_rejected) of each run. The drops are read here, once."""
        good, counts = {}, []
        for source, rows in inp.checked.items():
            rows, seen = rejects.counted(rows, source)
            path = scratch_path(self.spark, f"checked-{source}")
            rows.write.parquet(path)
            rows = self.spark.read.schema(rows.schema).parquet(path)
            load.write("rejected_rows", rejects.rejected_rows(rows, source), f"{load.id}/{source}")
            good[source] = rejects.good_rows(rows)
            counts.append((started_at, source, seen.get["rows_read"], seen.get["rows_rejected"]))
        if counts:
            self._count(load, counts, "drops")
        return replace(inp, **good)

    # -- facts --------------------------------------------------------------------------------
    def _append_new(self, load: Load, new: DataFrame, table: str, index: KeyIndex) -> DataFrame:
        """Append rows whose keys the table does not hold (one per key), in parts by date, and their keys; returns the
        rows as they are stored now, so that nothing computes them again.

        Rows are dealt out by date, where a day too large for a task is split: written as they come, every task would
        write a file for each of its dates."""
        part, ts = FACT_PARTITION[table]
        rows = new.withColumn(part, F.to_date(ts)).hint("rebalance", part)
        load.write(table, rows.sortWithinPartitions(part, ts), load.id, part)
        new = load.read(table, lambda k: k.endswith(f"/{load.id}"))
        index.add(load, new)
        return new

    def _insert_ignore(self, load: Load, delta: DataFrame, table: str, key: str) -> DataFrame:
        """A key may come again with another date (a re-issued waybill), so the whole index is probed."""
        index = KeyIndex(table, [key])
        return self._append_new(load, index.unseen(load, delta), table, index)

    def _with_open(self, load: Load, new: DataFrame, table: str, key: str) -> DataFrame:
        """``new`` and the rows the last batch left open, one per key."""
        left = load.read(table)
        return new if left is None else one_per_key(new.unionByName(left), [key])

    def _keep_open(self, load: Load, table: str, rows: DataFrame, started_at: _dt.datetime) -> None:
        """Rows the next batch starts from; those older than ``OPEN_RIDE_DAYS`` are set aside in ``expired_<table>`` and
        counted, so that what stays open does not grow for good."""
        rows = stored(rows, table)
        old = F.col("dt") < ts_lit(started_at - _dt.timedelta(days=OPEN_RIDE_DAYS))
        load.write(table, rows.filter(~F.coalesce(old, F.lit(False))), "now")
        expired = rows.filter(old)
        n = expired.count()
        if n:
            load.write(f"expired_{table}", expired, load.id)
            self._count(load, [(started_at, table, rows.count(), n)], table)

    def _count(self, load: Load, counts: list[tuple], key: str) -> None:
        load.write("work_counts", self.spark.createDataFrame(
            counts, "loaded_until timestamp_ntz, source string, rows_read bigint, rows_rejected bigint").coalesce(1),
            f"{load.id}/{key}")

    def load_facts(self, load: Load, inp: Inputs, wm: _dt.datetime,
                   started_at: _dt.datetime) -> tuple[DataFrame, DataFrame]:
        """The new fact rides and payments."""
        since = extract.extract_since
        # waybills: the files of this run (selected by file time); repeats are ignored by key
        self._insert_ignore(load, facts.build_fact_waybills(inp.waybills, inp.drivers), "fact_waybills", "waybill_num")

        # rides: the look-back window plus what earlier batches left open (stored rows: no source is read again)
        rd = since(inp.rides, "dt", wm, LOOKBACK_RIDES_H)
        mv = since(inp.movement, "dt", wm, LOOKBACK_RIDES_H)
        rd = stored(self._with_open(load, rd, "open_rides", "ride_id"), "batch-rides")
        mv = stored(self._with_open(load, mv, "open_events", "movement_id"), "batch-events")
        # the index is probed once, for all rides the batch has heard of
        index = KeyIndex("fact_rides", ["ride_id"])
        heard = rd.select("ride_id").unionByName(mv.select(F.col("ride").alias("ride_id")))
        seen = stored(index.seen(load, heard), "seen-rides")
        first_order = rd.agg(F.min("dt")).first()[0]
        # only waybills still open at the earliest order time can contain a ride of the batch
        waybills = load.read("fact_waybills")
        if first_order is not None:
            waybills = waybills.filter(F.col("work_end_dt") >= F.lit(first_order))
        # the lookup is computed once; fact rows and quarantine are both read from it
        looked = facts.build_fact_rides(mv, rd, waybills).looked.select(*facts.FACT_RIDES_COLUMNS, "dt")
        fr = facts.split_lookup(stored(looked, "looked-rides"))
        new_rides = one_per_key(fr.rides, ["ride_id"]).join(seen, "ride_id", "left_anti")
        new_rides = self._append_new(load, new_rides, "fact_rides", index)
        done = seen.unionByName(new_rides.select("ride_id"))
        load.write("quarantine_rides", fr.quarantine.join(done, "ride_id", "left_anti"), "now")
        # a header without a client's phone never becomes a fact
        closed = done.unionByName(rd.filter(F.col("client_phone").isNull()).select("ride_id"))
        self._keep_open(load, "open_rides", rd.join(closed, "ride_id", "left_anti"), started_at)
        self._keep_open(load, "open_events", mv.join(closed.withColumnRenamed("ride_id", "ride"), "ride", "left_anti"),
                        started_at)

        # payments come from files already selected by modification time (modifiedAfter)
        pay = self._insert_ignore(load, facts.build_fact_payments(inp.payments), "fact_payments", "transaction_id")
        return new_rides, pay

    # -- dimensions (C12-C15) -----------------------------------------------------------------
    def _dim(self, load: Load, table: str, delta: DataFrame, apply) -> None:
        """Close-and-append on the open versions only: the part ``open`` (one version per key) is replaced, the
        versions this load closed are a part of their own (history is never rewritten)."""
        cur = load.read(table, lambda k: k == "open")
        out = stored(apply(cur, delta), table)      # written twice below: computed once
        is_open = F.col("end_dt") == open_end()
        load.write(table, out.filter(~is_open), f"closed/{load.id}")
        load.write(table, out.filter(is_open), "open")

    def load_dims(self, load: Load, inp: Inputs, wm: _dt.datetime) -> DataFrame:
        """The new client versions."""
        w = ts_lit(wm)
        self._dim(load, "dim_cars", dims.cars_delta(inp.car_pool, w), lambda cur, d: dims.apply_cars(cur, d))
        self._dim(load, "dim_drivers", dims.drivers_delta(inp.drivers, w), lambda cur, d: dims.apply_drivers(cur, d))
        # cards first seen: rides of this batch whose (phone, card) the dimension does not hold, not the whole history
        recent = inp.rides.filter(F.col("dt") > w)
        known = load.read("dim_clients")
        if known is not None:
            known = known.select(F.col("phone_num").alias("_phone"), F.col("card_num").alias("_card"))
            recent = recent.join(known, F.col("client_phone").eqNullSafe(F.col("_phone"))
                                 & F.col("card_num").eqNullSafe(F.col("_card")), "left_anti")
        new_versions = stored(dims.clients_delta(recent), "new-versions")
        self._dim(load, "dim_clients", new_versions, lambda cur, d: dims.apply_clients(cur, d))
        return new_versions

    # -- the two jobs --------------------------------------------------------------------------
    def run_etl(self, inp: Inputs, started_at: _dt.datetime) -> None:
        """Facts -> dimensions -> sums -> ledger, published together. A failure records ``Failure`` and re-raises."""
        load = self.store.begin()
        try:
            wm = self.watermark()
            inp = self._account(load, inp, started_at)
            old_clients = load.read("dim_clients")
            new_rides, new_payments = self.load_facts(load, inp, wm, started_at)
            new_versions = self.load_dims(load, inp, wm)
            self.history.add(load, old_clients, load.read("dim_clients"), new_versions, new_rides, new_payments)
            self._add_to_ledger(load, started_at, STATUS_SUCCESS)
            load.commit()
        except Exception:
            self.record(started_at, STATUS_FAILURE)
            raise

    def table(self, name: str, since: _dt.date | None = None, on: _dt.date | None = None) -> DataFrame:
        """A committed table; for facts ``since`` / ``on`` pick the parts of those dates (the plans filter on the
        timestamps themselves too)."""
        return dated(self.store.read, name, since, on)

    def refuse_after_failure(self) -> None:
        newest = self.ledger().orderBy(F.col("loaded_until").desc(), F.col("status") == STATUS_SUCCESS).first() \
            if self.ledger() is not None else None
        if newest is None or newest.status != STATUS_SUCCESS:
            raise LoadFailed(f"the newest load did not succeed: {newest}")

    def run_marts(self, report_dt: _dt.date) -> None:
        """The four reports for ``report_dt``, published together; re-running a day replaces that day. As in the
        original, where the reports run only after a load that ended well."""
        self.refuse_after_failure()
        load, day = self.store.begin(), str(report_dt)
        rides_of_day = dated(load.read, "fact_rides", on=report_dt)
        shifts = dated(load.read, "fact_waybills", since=report_dt)   # from the day on
        load.write("rep_drivers_payments", marts.drivers_payments(rides_of_day, load.read("dim_drivers"), report_dt), day)
        load.write("rep_drivers_overtime", marts.drivers_overtime(shifts, report_dt), day)
        load.write("rep_drivers_overtime_clipped", marts.drivers_overtime_clipped(shifts, report_dt), day)
        self.violations.run(load, lambda a, b: dated(load.read, "fact_rides", a, until=b), report_dt)
        self.history.report(load)
        load.commit()

    def daily_run(self, inp: Inputs, started_at: _dt.datetime, report_dt: _dt.date) -> None:
        """Both jobs: the reports run only if the load succeeded."""
        self.run_etl(inp, started_at)
        self.run_marts(report_dt)


def dated(read, name: str, since: _dt.date | None = None, on: _dt.date | None = None,
          until: _dt.date | None = None) -> DataFrame:
    """A table by ``read`` (of a store or a load), only the parts of some dates; undated parts always."""
    low, high = str(on or since or ""), str(on or until or "9999-12-31")
    return read(name, lambda k: k.startswith("null/") or low <= k.split("/")[0] <= high) if on or since or until \
        else read(name)


def default_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "warehouse")
