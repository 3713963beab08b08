"""File drops (C3, C4): XML waybills (one per file or many) and headerless TSV payments.

Both readers take a directory and an optional ``since``: only files modified after it
are read (``modifiedAfter``), which replaces listing a remote folder and comparing its
timestamps by hand. ``pathGlobFilter`` keeps only the right suffix.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabwh.functions.time import parse_dayfirst

WAYBILL_XML_SCHEMA = T.StructType([
    T.StructField("_number", T.StringType(), True),
    T.StructField("_issuedt", T.StringType(), True),
    T.StructField("model", T.StringType(), True),
    T.StructField("car", T.StringType(), True),
    T.StructField("driver", T.StructType([
        T.StructField("name", T.StringType(), True),
        T.StructField("license", T.StringType(), True),
        T.StructField("validto", T.StringType(), True),
    ]), True),
    T.StructField("period", T.StructType([
        T.StructField("start", T.StringType(), True),
        T.StructField("stop", T.StringType(), True),
    ]), True),
])

#: Waybills in a file that is written, at most (about 400 bytes each): a reader takes an XML file whole, in one task.
WAYBILLS_PER_FILE = 100_000

PAYMENT_TSV_SCHEMA = T.StructType([
    T.StructField("transaction_dt", T.StringType(), True),
    T.StructField("card_num", T.StringType(), True),   # text: keeps leading zeros
    T.StructField("transaction_amt", T.DecimalType(18, 2), True),
])


def _since_opt(since, zone: str) -> dict:
    """``since`` is a wall-clock time of ``zone``, whatever the session's zone is."""
    if since is None:
        return {}
    if isinstance(since, _dt.datetime):
        since = since.strftime("%Y-%m-%dT%H:%M:%S")
    return {"modifiedAfter": str(since).replace(" ", "T"), "timeZone": zone}


def read_waybills_raw(spark: SparkSession, path: str, since=None, zone: str = "UTC") -> DataFrame:
    return (spark.read.schema(WAYBILL_XML_SCHEMA)
            .options(rowTag="waybill", pathGlobFilter="*.xml", **_since_opt(since, zone))
            .xml(path))


def flatten_waybills(raw: DataFrame, *more) -> DataFrame:
    """The nine scalars of a waybill (attributes, driver/*, period/*), times parsed, and ``more`` columns of ``raw``."""
    return raw.select(
        F.col("_number").alias("number"),
        parse_dayfirst(F.col("_issuedt")).alias("issuedt"),
        F.col("model"),
        F.col("car"),
        F.col("driver.name").alias("name"),
        F.col("driver.license").alias("license"),
        F.to_date(parse_dayfirst(F.concat(F.col("driver.validto"), F.lit(" 00:00:00")))).alias("validto"),
        parse_dayfirst(F.col("period.start")).alias("start"),
        parse_dayfirst(F.col("period.stop")).alias("stop"),
        *more,
    )


def read_waybills(spark: SparkSession, path: str, since=None, zone: str = "UTC") -> DataFrame:
    """XML waybills -> flat typed rows."""
    return flatten_waybills(read_waybills_raw(spark, path, since, zone))


def read_payments(spark: SparkSession, path: str, since=None, zone: str = "UTC") -> DataFrame:
    """C4: headerless tab-separated payments, card number kept as text."""
    return (spark.read.schema(PAYMENT_TSV_SCHEMA)
            .options(sep="\t", header="false", pathGlobFilter="*.csv", mode="PERMISSIVE", **_since_opt(since, zone))
            .csv(path))


def waybills_to_xml_frame(flat: DataFrame) -> DataFrame:
    """Flat waybills -> the nested layout of a waybill document (for writing a drop)."""
    ts = "yyyy-MM-dd HH:mm:ss"
    return flat.select(
        F.col("number").alias("_number"),
        F.date_format("issuedt", ts).alias("_issuedt"),
        "model", "car",
        F.struct(F.col("name"), F.col("license"), F.date_format("validto", "yyyy-MM-dd").alias("validto"))
        .alias("driver"),
        F.struct(F.date_format("start", ts).alias("start"), F.date_format("stop", ts).alias("stop")).alias("period"),
    )


def write_waybills(flat: DataFrame, path: str) -> None:
    (waybills_to_xml_frame(flat).write.mode("overwrite")
     .options(rowTag="waybill", rootTag="waybills", maxRecordsPerFile=WAYBILLS_PER_FILE).format("xml").save(path))


def write_payments(payments: DataFrame, path: str) -> None:
    (payments.select("transaction_dt", "card_num", F.col("transaction_amt").cast("string"))
     .write.mode("overwrite").options(sep="\t", header="false").csv(path))
