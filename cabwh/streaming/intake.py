"""Incremental intake of the file drops with Structured Streaming.

The file source remembers in its checkpoint which files it has processed, so "files changed since the last successful
run" needs no ledger and no listing by hand. With ``trigger(availableNow=True)`` a run processes what is there and
stops (a daily job).

A key that comes again soon (a file sent twice, a replay) is dropped in the stream's own state store: keys are kept
until the event-time watermark has passed them by ``KEEP``. Behind that each micro-batch is insert-ignored against the
table's key index and published by a commit: a micro-batch that is replayed after a failure, or a key that comes back
after its state is gone, adds nothing. Neither reads the target's rows.

Late rows, older than the newest event by more than ``KEEP``, are dropped by the stream and counted in its progress
(:func:`late_rows`); they are not lost: :func:`sweep_payments` inserts whatever of the drop's files is not stored yet.
Rows that do not parse go to ``rejected_rows`` with their reason, and never into the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabwh.operators.key_index import KeyIndex, insert_ignore_indexed
from cabwh.plans.facts import build_fact_payments, build_fact_waybills
from cabwh.sources import rejects
from cabwh.sources.files import WAYBILL_XML_SCHEMA, flatten_waybills
from cabwh.sources.store import Store

#: How long a key is remembered by the stream, and how late a row may be.
KEEP = "2 days"


def _append(store: Store, table: str, rows: DataFrame, keys: list[str]) -> None:
    """One commit: the rows with keys the table does not hold."""
    load = store.begin()
    insert_ignore_indexed(load, table, rows, keys, KeyIndex(table, keys))
    load.commit()


def _appender(store: Store, table: str, keys: list[str],
              transform: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, epoch_id: int) -> None:
        _append(store, table, transform(batch), keys)
    return run


def payments_stream(spark: SparkSession, drop_dir: str) -> DataFrame:
    """Checked payment lines (``problem`` is NULL for good ones)."""
    return rejects.check_payments(
        spark.readStream.schema(rejects.PAYMENT_TEXT_SCHEMA)
        .options(sep="\t", header="false", pathGlobFilter="*.csv", columnNameOfCorruptRecord=rejects.CORRUPT)
        .csv(drop_dir))


def waybills_stream(spark: SparkSession, drop_dir: str) -> DataFrame:
    return (spark.readStream.schema(WAYBILL_XML_SCHEMA)
            .options(rowTag="waybill", pathGlobFilter="*.xml")
            .format("xml").load(drop_dir))


def distinct_in_time(rows: DataFrame, keys: list[str], event_time: str, keep: str = KEEP) -> DataFrame:
    """A stream without keys that come again within ``keep`` of event time (state store, bounded by the watermark)."""
    return (rows.withColumn("_event_time", F.col(event_time).cast("timestamp"))
            .withWatermark("_event_time", keep).dropDuplicatesWithinWatermark(keys).drop("_event_time"))


def start_payments_intake(spark: SparkSession, drop_dir: str, root: str, checkpoint: str, available_now: bool = True,
                          keep: str = KEEP) -> tuple[StreamingQuery, StreamingQuery]:
    """TSV payments -> checked -> keyed -> distinct in time -> insert-ignore into ``fact_payments`` of the store at
    ``root``; the second query writes the lines that do not parse."""
    store = Store(spark, root)
    checked = payments_stream(spark, drop_dir)
    good = distinct_in_time(build_fact_payments(rejects.good_rows(checked)), ["transaction_id"], "transaction_dt", keep)
    intake = (good.writeStream.foreachBatch(_appender(store, "fact_payments", ["transaction_id"], lambda b: b))
              .option("checkpointLocation", f"{checkpoint}/good"))
    aside = (rejects.rejected_rows(checked, "payments").writeStream.format("parquet")
             .option("path", f"{root}/rejected_payments").option("checkpointLocation", f"{checkpoint}/rejected"))
    if available_now:
        intake, aside = intake.trigger(availableNow=True), aside.trigger(availableNow=True)
    return intake.start(), aside.start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that a run's watermark left out."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def sweep_payments(spark: SparkSession, drop_dir: str, root: str, since=None, zone: str = "UTC") -> None:
    """Insert what of the drop's files (changed after ``since``) is not stored yet: late rows, for one."""
    checked = rejects.check_payments(rejects.read_payment_text(spark, drop_dir, since, zone))
    _append(Store(spark, root), "fact_payments", build_fact_payments(rejects.good_rows(checked)), ["transaction_id"])


def start_waybills_intake(spark: SparkSession, drop_dir: str, drivers: DataFrame, root: str,
                          checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """XML waybills -> flat -> licence to personnel number -> insert-ignore into ``fact_waybills``."""
    def transform(batch: DataFrame) -> DataFrame:
        return build_fact_waybills(flatten_waybills(batch), drivers)

    w = (waybills_stream(spark, drop_dir).writeStream
         .foreachBatch(_appender(Store(spark, root), "fact_waybills", ["waybill_num"], transform))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if available_now else w).start()
