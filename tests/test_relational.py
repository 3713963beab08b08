"""The source reader on a Parquet folder (no database server runs here)."""

import datetime as dt
import tempfile

from cabwh.sources.fixtures import load_sources
from cabwh.sources.relational import Increment, read_source, stride_predicates


def test_read_source_parquet_with_watermark(spark, sf_small):
    root = tempfile.mkdtemp(prefix="src-")
    src = load_sources(spark, sf_small)
    src.rides.write.parquet(f"{root}/rides")
    wm = dt.datetime(2024, 1, 20)
    got = read_source(spark, root, "rides", ["ride_id", "dt"], since_col="dt", since=wm, lookback_hours=2)
    assert got.columns == ["ride_id", "dt"]
    want = src.rides.filter(src.rides.dt > wm - dt.timedelta(hours=2)).count()
    assert got.count() == want > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dt), GreaterThan(dt," in plan      # the watermark reaches the scan


# --- planned parallel reads ----------------------------------------------------------------------------------------


def test_strides_take_every_row_once(spark):
    at = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n * 977, microseconds=n)
    rows = [(i, at(i), at(i).date()) for i in range(-40, 400, 3)] + [(None, None, None), (7, at(7), at(7).date())] * 3
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, d date")
    for column, place in (("k", 0), ("t", 1), ("d", 2)):
        known = [r[place] for r in rows if r[place] is not None]
        for low, high in ((min(known), max(known)), (sorted(known)[20], sorted(known)[90]), (known[3], known[3])):
            for rows_per_read, max_reads in ((1, 8), (20, 3), (10_000, 8), (1, 500)):
                found = stride_predicates(column, Increment(low, high, len(rows)), rows_per_read, max_reads)
                assert 1 <= len(found) <= max_reads
                # also rows outside the bounds: they arrived after the source was asked
                assert sorted(str(r) for p in found for r in df.filter(p).collect()) == sorted(map(str, df.collect()))
    assert len(stride_predicates("k", Increment(0, 999, 1000), 100, 32)) == 10
    assert stride_predicates("k", Increment(None, None, 0)) == ["1 = 1"]          # an empty increment
    assert stride_predicates("k", Increment(None, None, 9), 1) == ["1 = 1"]       # only NULLs


def test_jdbc_reads_are_planned_for_the_increment(spark, monkeypatch):
    """The reader is a stand-in that answers with Spark itself: no database runs here."""
    from pyspark.sql.readwriter import DataFrameReader

    table = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(100)] + [(None, dt.datetime(2024, 2, 1))],
                                  "ride_id int, dt timestamp_ntz")
    table.createOrReplaceTempView("rides_at_the_source")
    asked = []

    def jdbc(self, url, table, predicates=None, properties=None, **more):
        asked.append((table, predicates))
        if table.startswith("("):
            return spark.sql(f"SELECT * FROM {table.replace('TIMESTAMP ', 'TIMESTAMP_NTZ ')}")
        whole = spark.table(table)
        parts = [whole.filter(p) for p in predicates or ["1 = 1"]]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    since = dt.datetime(2024, 1, 3)
    got = read_source(spark, "jdbc:none", "rides_at_the_source", ["ride_id"], since_col="dt", since=since, lookback_hours=2,
                      split_column="ride_id", rows_per_read=10, max_reads=4)
    assert "dt > TIMESTAMP '2024-01-02 22:00:00'" in asked[0][0]                    # the question is about the increment
    assert len(asked[1][1]) == 4 and asked[1][1][0] == "ride_id < 60 OR ride_id IS NULL"
    assert sorted(r[0] for r in got.collect() if r[0] is not None) == list(range(47, 100))
    assert got.filter("ride_id IS NULL").count() == 1
    empty = read_source(spark, "jdbc:none", "rides_at_the_source", since_col="dt", since=dt.datetime(2030, 1, 1), split_column="ride_id")
    assert empty.count() == 0 and asked[-1][1] == ["1 = 1"]
