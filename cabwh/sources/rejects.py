"""Accounting of bad input in the file drops (C3, C4, F7): what does not parse is set aside, with its reason and its
text, and counted; it never turns into a NULL silently.

A check adds to each raw row ``problem`` (the first thing wrong with it, NULL if nothing is) and ``record`` (the row as
it came). Good rows go on as before; the others are the rows of ``rejected_rows``. Counts are gathered by an
``Observation`` while the checked rows are written, so the drop is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabwh.functions.time import parse_dayfirst
from cabwh.sources.files import WAYBILL_XML_SCHEMA, _since_opt, flatten_waybills

CORRUPT = "_corrupt"
#: Amounts as text: what is no number is told apart from what is missing.
PAYMENT_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True)
                                    for c in ("transaction_dt", "card_num", "transaction_amt", CORRUPT)])
WAYBILL_CHECK_SCHEMA = T.StructType([*WAYBILL_XML_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])
REJECTED = "source string, problem string, record string"


def _first(*problems: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(wrong, F.lit(name)) for wrong, name in problems])


def _blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit("")) == ""


def read_payment_text(spark: SparkSession, path: str, since=None, zone: str = "UTC", glob: str = "*.csv") -> DataFrame:
    """Payment lines as text; a line without exactly three fields is in ``_corrupt`` as a whole."""
    return (spark.read.schema(PAYMENT_TEXT_SCHEMA)
            .options(sep="\t", header="false", pathGlobFilter=glob, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                     **_since_opt(since, zone)).csv(path))


def check_payments(raw: DataFrame) -> DataFrame:
    """(transaction_dt, card_num, transaction_amt, problem, record) of payment lines."""
    amount = F.col("transaction_amt").try_cast("decimal(18,2)")
    fields = [F.coalesce(F.col(c), F.lit("")) for c in ("transaction_dt", "card_num", "transaction_amt")]
    return raw.select(
        "transaction_dt", "card_num", amount.alias("transaction_amt"),
        _first((F.col(CORRUPT).isNotNull(), "record"), (parse_dayfirst("transaction_dt").isNull(), "transaction_dt"),
               (_blank("card_num"), "card_num"), (amount.isNull(), "transaction_amt")).alias("problem"),
        F.coalesce(F.col(CORRUPT), F.concat_ws("\t", *fields)).alias("record"))


def read_waybill_documents(spark: SparkSession, path: str, since=None, zone: str = "UTC") -> DataFrame:
    return (spark.read.schema(WAYBILL_CHECK_SCHEMA)
            .options(rowTag="waybill", pathGlobFilter="*.xml", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
                     **_since_opt(since, zone)).xml(path))


def check_waybills(raw: DataFrame) -> DataFrame:
    """The flat waybill columns with ``problem`` and ``record`` (the document as JSON, or its text if it is no XML).

    The licence's expiry may be missing: no later step needs it.
    """
    rows = flatten_waybills(raw, CORRUPT, F.struct(*WAYBILL_XML_SCHEMA.names).alias("_document"))
    problem = _first((F.col(CORRUPT).isNotNull(), "record"), (_blank("number"), "number"),
                     (F.col("issuedt").isNull(), "issuedt"), (_blank("car"), "car"), (_blank("license"), "license"),
                     (F.col("start").isNull(), "start"), (F.col("stop").isNull(), "stop"))
    return rows.withColumns({"problem": problem, "record": F.coalesce(F.col(CORRUPT), F.to_json("_document"))}).drop(
        CORRUPT, "_document")


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("problem IS NULL").drop("problem", "record")


def rejected_rows(checked: DataFrame, source: str) -> DataFrame:
    """(source, problem, record) of the rows that were set aside."""
    return checked.filter("problem IS NOT NULL").select(F.lit(source).alias("source"), "problem", "record")


def counted(checked: DataFrame, source: str) -> tuple[DataFrame, Observation]:
    """``checked`` that counts ``rows_read`` and ``rows_rejected`` when it is written."""
    seen = Observation(f"checked_{source}")
    return checked.observe(seen, F.count(F.lit(1)).alias("rows_read"), F.count("problem").alias("rows_rejected")), seen
