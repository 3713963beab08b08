"""Source tables of the operational database.

``read_source`` takes either a ``jdbc:`` URL or a folder of Parquet tables; the rest of the call is the same. With
JDBC, Spark sends the pruned column list and the watermark predicate inside the generated SELECT (filter push-down),
so only the increment crosses the network. TLS is a connection property (e.g. ``{"sslmode": "require"}`` for
PostgreSQL drivers).

A table with a ``split_column`` is read by several connections. Their number and bounds are planned from the source:
one small query asks for the least and greatest value and the number of rows *of the increment*, and each connection
gets a stride of the column. Every row falls into exactly one stride: the first one also takes NULLs and whatever is
below its bound, the last one whatever is above (rows that arrived since the question was asked).
"""

from __future__ import annotations

import datetime as _dt
import os
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from cabwh.sources.extract import extract_since

#: Rows a connection reads, and connections a table is read by at most (a limit of the source, not of the rows).
ROWS_PER_READ = 1_000_000
MAX_READS = 32

_EPOCH = _dt.datetime(1970, 1, 1)
_US = _dt.timedelta(microseconds=1)


class Increment(NamedTuple):
    """What a read is about to fetch: the bounds of the split column and the number of rows."""

    low: int | _dt.datetime | _dt.date | None
    high: int | _dt.datetime | _dt.date | None
    rows: int


def since_sql(since_col: str, since: _dt.datetime, lookback_hours: int = 0) -> str:
    return f"{since_col} > {_literal(since - _dt.timedelta(hours=lookback_hours))}"


def increment_of(spark: SparkSession, url: str, table: str, column: str, where: str | None = None,
                 properties: dict | None = None) -> Increment:
    """Ask the source (one row)."""
    question = f"(SELECT min({column}) AS low, max({column}) AS high, count(*) AS n FROM {table}" + (
        f" WHERE {where}" if where else "") + ") increment"
    row = spark.read.jdbc(url, question, properties=dict(properties or {})).first()
    return Increment(row[0], row[1], int(row[2] or 0))


def _literal(value) -> str:
    if isinstance(value, _dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return f"DATE '{value}'" if isinstance(value, _dt.date) else str(value)


def _bounds(low, high, strides: int) -> list:
    """The inner bounds of ``strides`` strides of about equal width, without repetitions."""
    if isinstance(low, _dt.datetime):
        a, b, back = (low - _EPOCH) // _US, (high - _EPOCH) // _US, lambda x: _EPOCH + x * _US
    elif isinstance(low, _dt.date):
        a, b, back = low.toordinal(), high.toordinal(), _dt.date.fromordinal
    else:
        a, b, back = int(low), int(high), lambda x: x
    return [back(x) for x in sorted({a + (b - a + 1) * i // strides for i in range(1, strides)} - {a})]


def stride_predicates(column: str, increment: Increment, rows_per_read: int = ROWS_PER_READ,
                      max_reads: int = MAX_READS) -> list[str]:
    """One predicate per connection; each row of the table satisfies exactly one of them."""
    strides = min(max_reads, -(-increment.rows // rows_per_read))
    inner = [] if increment.low is None or strides < 2 else _bounds(increment.low, increment.high, strides)
    if not inner:
        return ["1 = 1"]
    at = [_literal(b) for b in inner]
    return ([f"{column} < {at[0]} OR {column} IS NULL"]
            + [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at[:-1], at[1:], strict=True)]
            + [f"{column} >= {at[-1]}"])


def read_source(spark: SparkSession, location: str, table: str, columns: list[str] | None = None,
                since_col: str | None = None, since=None, lookback_hours: int = 0,
                properties: dict | None = None, split_column: str | None = None,
                rows_per_read: int = ROWS_PER_READ, max_reads: int = MAX_READS) -> DataFrame:
    """One source table, projected and filtered to rows newer than ``since - lookback``."""
    if location.startswith("jdbc:"):
        predicates = None
        if split_column is not None:
            where = since_sql(since_col, since, lookback_hours) if since_col is not None and since is not None else None
            predicates = stride_predicates(split_column, increment_of(spark, location, table, split_column, where, properties),
                                           rows_per_read, max_reads)
        df = spark.read.jdbc(location, table, predicates=predicates, properties=dict(properties or {}))
    else:
        df = spark.read.parquet(os.path.join(location, table))
    if columns:
        df = df.select(*columns)
    if since_col is not None and since is not None:
        df = extract_since(df, since_col, since, lookback_hours)
    return df
