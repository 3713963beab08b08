"""Reports that carry state from day to day (C18, C20; A3-A5, S15): a run reads the state and the new rows, not the
history.

* :class:`ViolationCounts`: how many violations each driver had at the end of a day, one row per driver and a snapshot
  per day. A day's report numbers its own violations and adds the newest snapshot before it.
* :class:`ClientHistory`: sums of payments by card and of rides by phone and card version. A load adds its own rows;
  where it opens or closes a client version before rides that are counted already, those move to the version that
  now covers them. The report reads the sums of the clients that were touched.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabwh.functions import format_card
from cabwh.operators.buckets import BUCKETS, BucketedTable
from cabwh.plans import marts
from cabwh.session import stored
from cabwh.sources.store import Load

#: Snapshots of the running counts that are kept.
KEPT_SNAPSHOTS = 62


class ViolationCounts:
    """``rep_drivers_violations``, a part per day, and its state, a snapshot per run's last day.

    A run covers all days after the newest snapshot before it, so a day that was left out is made up for. If later
    days have been reported already (a day is run again), their counts rest on this one: they are run again too, and
    the snapshots after the first day are replaced.
    """

    REPORT, STATE = "rep_drivers_violations", "rep_drivers_violations_state"

    def __init__(self, kept: int = KEPT_SNAPSHOTS):
        self.kept = kept

    def base(self, load: Load, day: _dt.date) -> str | None:
        """The day of the newest snapshot before ``day``."""
        return max((k for k in load.parts(self.STATE) if k < str(day)), default=None)

    def state(self, load: Load, day: _dt.date) -> DataFrame | None:
        """(personnel_num, violations): the newest snapshot before ``day``; one part is read."""
        base = self.base(load, day)
        return None if base is None else load.read(self.STATE, lambda k: k == base)

    def run(self, load: Load, rides: Callable[[_dt.date | None, _dt.date], DataFrame], day: _dt.date) -> None:
        """Report ``day``; ``rides(a, b)`` are the fact rides that ended on the days a to b (a None: from the first)."""
        base = self.base(load, day)
        first = _dt.date.fromisoformat(base) + _dt.timedelta(days=1) if base else None
        reported = [_dt.date.fromisoformat(k) for k in load.parts(self.REPORT)]
        last = max([day, *reported])
        rows = stored(marts.drivers_violations_from(rides(first, last), self.state(load, day), first, last), "violations")
        again = [d for d in reported if first is None or d >= first]
        load.replace(self.REPORT, rows.withColumn("_day", F.col("report_dt")), "_day", [*map(str, again), str(day)])
        counts = rows.groupBy("personnel_num").agg((F.max("violations_cnt") + 1).cast("bigint").alias("violations"))
        if base is not None:                             # the running number is the count: the larger one is the newer
            counts = self.state(load, day).unionByName(counts).groupBy("personnel_num").agg(
                F.max("violations").alias("violations"))
        load.drop(self.STATE, lambda k: base is not None and k <= base)
        load.write(self.STATE, counts, str(last))
        newest = sorted(load.parts(self.STATE))[-self.kept:]
        load.drop(self.STATE, lambda k: k in newest)


class ClientHistory:
    """``rep_clients_hist`` and the sums it is made of, all in hash buckets."""

    def __init__(self, buckets: int = BUCKETS):
        self.paid = BucketedTable("agg_paid", ["card_num"], buckets)
        self.rides = BucketedTable("agg_rides", ["client_phone_num", "card_num"], buckets, by=["client_phone_num"])
        self.report_table = BucketedTable("rep_clients_hist", ["client_id"], buckets)
        self.touched = "touched_phones"

    @staticmethod
    def _counted(rides: DataFrame, clients: DataFrame, sign: int) -> DataFrame:
        """The rides' counts and sums by (phone, card version), with ``sign``."""
        sums = marts.rides_by_client_card(rides, clients)
        return sums.select("client_phone_num", "card_num", *[
            (F.coalesce(c, F.lit(0)) * sign).cast(sums.schema[c].dataType).alias(c)
            for c in ("total_rides_cnt", "cancelled_cnt", "total_amt")])

    def ride_changes(self, load: Load, old_clients: DataFrame | None, clients: DataFrame, new_versions: DataFrame,
                     new_rides: DataFrame) -> DataFrame:
        """What to add to the sums: the new rides, and the moves of rides counted before.

        A new version changes only which version covers the phone's rides from its start on, so of the facts only
        the parts from the earliest new start on are read.
        """
        changes = self._counted(new_rides, _of_phones(clients, new_rides), 1)
        since = new_versions.groupBy(F.col("phone_num").alias("_phone")).agg(F.min("start_dt").alias("_since"))
        earliest = since.agg(F.min("_since")).first()[0]
        if old_clients is None or earliest is None:
            return changes
        counted = load.read("fact_rides", lambda k: not k.endswith(load.id) and (
            k.startswith("null/") or k.split("/")[0] >= str(earliest.date())))
        moved = stored(counted.join(since, (F.col("client_phone_num") == F.col("_phone"))
                                    & (F.col("ride_arrival_dt") >= F.col("_since"))).select(*marts.CLIENT_RIDE_COLS),
                       "moved-rides")
        return (changes.unionByName(self._counted(moved, _of_phones(old_clients, moved), -1))
                .unionByName(self._counted(moved, _of_phones(clients, moved), 1)))

    def add(self, load: Load, old_clients: DataFrame | None, clients: DataFrame, new_versions: DataFrame,
            new_rides: DataFrame, new_payments: DataFrame) -> None:
        """Add a load's rides and payments (those it stored), and note the phones whose history changed."""
        changes = self.rides.add(load, self.ride_changes(load, old_clients, clients, new_versions, new_rides))
        paid = new_payments.filter(F.col("card_num").isNotNull()).groupBy(format_card("card_num").alias("card_num")).agg(
            F.sum("transaction_amt").cast("decimal(18,2)").alias("paid_amt"))
        paid = self.paid.add(load, paid)
        by_card = clients.select("phone_num", "card_num").join(paid.select("card_num"), "card_num", "left_semi")
        phones = (new_versions.select("phone_num").unionByName(by_card.select("phone_num"))
                  .unionByName(changes.select(F.col("client_phone_num").alias("phone_num"))).distinct())
        load.write(self.touched, phones, load.id)

    def report(self, load: Load) -> None:
        """Bring the history up to date: the rows of the touched phones, from their versions and sums."""
        if not load.parts(self.touched):
            return
        phones = stored(load.read(self.touched).distinct(), "touched-phones")
        rows = self.rows_of(load, phones)
        self.report_table.upsert(load, rows, marts.HISTORY_UPDATE_COLS)
        load.drop(self.touched, lambda k: False)         # taken into account

    def rows_of(self, load: Load, phones: DataFrame) -> DataFrame:
        versions = stored(load.read("dim_clients").join(phones, "phone_num", "left_semi"), "touched-versions")
        paid = self.paid.read(load, versions.select("card_num").distinct())
        rides = self.rides.read(load, versions.select(F.col("phone_num").alias("client_phone_num")).distinct())
        return marts.history_rows(versions, paid, rides)


def _of_phones(clients: DataFrame, rides: DataFrame) -> DataFrame:
    return clients.join(rides.select(F.col("client_phone_num").alias("phone_num")).distinct(), "phone_num", "left_semi")
