"""File drops: XML waybills and TSV payments, modifiedAfter, suffix filter, streaming intake."""

import datetime as dt
import os
import tempfile
import time
from decimal import Decimal

from cabwh.sources.files import read_payments, read_waybills
from cabwh.sources.store import Store
from cabwh.streaming.intake import late_rows, start_payments_intake, start_waybills_intake, sweep_payments

WAYBILL = """<?xml version="1.0" encoding="UTF-8"?>
<waybills>
  <waybill number="{num}" issuedt="2024-01-05 00:00:00">
    <model>M</model>
    <car>K00001</car>
    <driver><name>Ivanov</name><license>L000001</license>{validto}</driver>
    <period><start>2024-01-05 00:30:00</start><stop>2024-01-05 12:00:00</stop></period>
  </waybill>
</waybills>
"""


def _write(path, text, mtime=None):
    with open(path, "w") as f:
        f.write(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


def test_xml_waybills(spark):
    d = tempfile.mkdtemp(prefix="wb-")
    old = time.mktime(dt.datetime(2023, 1, 1).timetuple())
    _write(f"{d}/a.xml", WAYBILL.format(num="W1", validto="<validto>2030-01-01</validto>"))
    _write(f"{d}/b.xml", WAYBILL.format(num="W2", validto=""))                     # no validto element
    _write(f"{d}/c.txt", WAYBILL.format(num="W3", validto=""))                     # wrong suffix: ignored
    _write(f"{d}/old.xml", WAYBILL.format(num="W0", validto=""), mtime=old)         # before the watermark
    rows = {r.number: r for r in read_waybills(spark, d).collect()}
    assert set(rows) == {"W0", "W1", "W2"}
    assert rows["W1"].validto == dt.date(2030, 1, 1) and rows["W2"].validto is None
    assert rows["W1"].start == dt.datetime(2024, 1, 5, 0, 30) and rows["W1"].license == "L000001"
    since = {r.number for r in read_waybills(spark, d, since=dt.datetime(2024, 1, 1)).collect()}
    assert since == {"W1", "W2"}


def test_written_waybills_are_files_of_bounded_size(spark, monkeypatch, tmp_path):
    """A reader takes an XML file whole, in one task."""
    from cabwh.sources import files
    from cabwh.sources.fixtures import load_sources

    monkeypatch.setattr(files, "WAYBILLS_PER_FILE", 10)
    flat = load_sources(spark, "/root/testdata/sf0.001").waybills
    assert flat.rdd.getNumPartitions() > 1                                         # made in several tasks
    flat = flat.limit(95).coalesce(1)
    files.write_waybills(flat, str(tmp_path / "drop"))
    names = list((tmp_path / "drop").glob("part-*"))
    assert len(names) == 10 and max(p.read_text().count("<waybill ") for p in names) == 10
    assert sorted(map(str, read_waybills(spark, str(tmp_path / "drop")).collect())) == sorted(map(str, flat.collect()))


def test_tsv_payments(spark):
    d = tempfile.mkdtemp(prefix="pay-")
    _write(f"{d}/p1.csv", "05.01.2024 10:00:00\t0000123412341234\t100.50\n"
                          "05.01.2024 10:00:00\t0000123412341234\t100.50\n"     # same time and card: one id
                          "junk\t4000000000000001\t1.00\n")
    rows = read_payments(spark, d).collect()
    assert rows[0].card_num == "0000123412341234"                                 # leading zeros kept
    assert rows[0].transaction_amt == Decimal("100.50")
    from cabwh.plans.facts import build_fact_payments
    fp = build_fact_payments(read_payments(spark, d)).collect()
    assert len({r.transaction_id for r in fp}) == 2
    assert sorted(r.transaction_dt is None for r in fp) == [False, False, True]


def _payments_run(spark, drop, root, **options):
    queries = start_payments_intake(spark, drop, root, f"{root}/_checkpoints", **options)
    for q in queries:
        assert q.awaitTermination(180) is not False
    return queries[0]


def _stored(spark, root):
    return sorted((r.card_num, str(r.transaction_dt)) for r in Store(spark, root).read("fact_payments").collect())


def test_streaming_intake_processes_each_file_once(spark):
    drop, root = tempfile.mkdtemp(prefix="drop-"), tempfile.mkdtemp(prefix="wh-")
    _write(f"{drop}/p1.csv", "05.01.2024 10:00:00\t4000000000000001\t10.00\n")
    _payments_run(spark, drop, root)
    assert len(_stored(spark, root)) == 1
    # a new file plus a re-sent copy of an old line: only the new key is appended
    _write(f"{drop}/p2.csv", "05.01.2024 10:00:00\t4000000000000001\t10.00\n"
                             "06.01.2024 11:00:00\t4000000000000002\t20.00\n"
                             "06.01.2024 11:00:00\t4000000000000002\t20.00\n")
    _payments_run(spark, drop, root)                      # goes on from the checkpoint
    assert len(_stored(spark, root)) == 2
    # nothing new: a third run appends nothing
    _payments_run(spark, drop, root)
    assert len(_stored(spark, root)) == 2


def test_streaming_replays_late_and_bad_rows(spark):
    drop, root = tempfile.mkdtemp(prefix="drop-"), tempfile.mkdtemp(prefix="wh-")
    _write(f"{drop}/p1.csv", "20.01.2024 10:00:00\t4000000000000001\t10.00\n"
                             "99.01.2024 10:00:00\t4000000000000001\t10.00\n"
                             "20.01.2024 10:00:00\t4000000000000001\n")
    _payments_run(spark, drop, root)
    # late by 15 days when the watermark stands at the 18th; 1 day old is in time; a replay of the first line
    _write(f"{drop}/p2.csv", "05.01.2024 10:00:00\t4000000000000005\t10.00\n"
                             "19.01.2024 10:00:00\t4000000000000004\t10.00\n"
                             "20.01.2024 10:00:00\t4000000000000001\t10.00\n")
    run = _payments_run(spark, drop, root)
    assert late_rows(run) == 1
    in_time = [("4000000000000001", "2024-01-20 10:00:00"), ("4000000000000004", "2024-01-19 10:00:00")]
    assert _stored(spark, root) == in_time
    # a key that comes back when its state is gone is known to the index
    _write(f"{drop}/p3.csv", "25.01.2024 10:00:00\t4000000000000006\t10.00\n")
    _payments_run(spark, drop, root)
    _write(f"{drop}/p4.csv", "24.01.2024 10:00:00\t4000000000000007\t1.00\n25.01.2024 10:00:00\t4000000000000006\t10.00\n")
    _payments_run(spark, drop, root)
    now = [*in_time, ("4000000000000006", "2024-01-25 10:00:00"), ("4000000000000007", "2024-01-24 10:00:00")]
    assert _stored(spark, root) == sorted(now)
    # the sweep stores what was late, once
    for _ in range(2):
        sweep_payments(spark, drop, root)
        assert _stored(spark, root) == sorted([*now, ("4000000000000005", "2024-01-05 10:00:00")])
    bad = spark.read.parquet(f"{root}/rejected_payments").collect()
    assert sorted((r.problem, r.record.split("\t")[0]) for r in bad) == [
        ("record", "20.01.2024 10:00:00"), ("transaction_dt", "99.01.2024 10:00:00")]


def test_rejected_waybills_and_counts(spark, sf_small):
    from cabwh.plans.pipeline import Inputs, Pipeline
    from cabwh.sources.fixtures import load_sources

    src, root = load_sources(spark, sf_small), tempfile.mkdtemp(prefix="rej-")
    at = dt.datetime(2024, 1, 10)
    for name in ("rides", "movement", "car_pool"):
        getattr(src, name).limit(50).write.parquet(f"{root}/{name}")
    src.current("drivers", at).write.parquet(f"{root}/drivers")
    os.makedirs(f"{root}/wb")
    os.makedirs(f"{root}/pay")
    good = WAYBILL.format(num="W1", validto="")
    _write(f"{root}/wb/a.xml", good)
    _write(f"{root}/wb/b.xml", good.replace("W1", "W2").replace("2024-01-05 12:00:00", "soon"))
    _write(f"{root}/wb/c.xml", good.replace('number="W1"', 'number=""'))
    _write(f"{root}/pay/p.csv", "05.01.2024 10:00:00\t4000000000000001\t10.00\n05.01.2024\t\t3\n\tx\t1\n05.01.2024\t4\tmuch\n")
    p = Pipeline(spark, f"{root}/warehouse", buckets=2)
    p.run_etl(Inputs.read(spark, root, f"{root}/wb", f"{root}/pay", p.watermark()), at)
    assert sorted((r.source, r.problem) for r in p.table("rejected_rows").collect()) == [
        ("payments", "card_num"), ("payments", "transaction_amt"), ("payments", "transaction_dt"),
        ("waybills", "number"), ("waybills", "stop")]
    counts = {r.source: (r.loaded_until, r.rows_read, r.rows_rejected) for r in p.table("work_counts").collect()}
    assert counts == {"waybills": (at, 3, 2), "payments": (at, 4, 3)}
    assert [r.waybill_num for r in p.table("fact_waybills").collect()] in ([], ["W1"])
    assert p.table("fact_payments").count() == 1
    stop = next(r for r in p.table("rejected_rows").collect() if r.problem == "stop")
    assert "W2" in stop.record and "soon" in stop.record     # the row as it came


def test_streaming_waybills_intake(spark):
    drop = tempfile.mkdtemp(prefix="dropwb-")
    root = tempfile.mkdtemp(prefix="whwb-")
    _write(f"{drop}/a.xml", WAYBILL.format(num="W1", validto="<validto>2030-01-01</validto>"))
    drivers = spark.createDataFrame(
        [("L000001", "F", "Ivanov", "M", dt.date(1980, 1, 1), "5000", dt.date(2030, 1, 1), dt.datetime(2024, 1, 1))],
        "driver_license string, first_name string, last_name string, middle_name string, birth_dt date, "
        "card_num string, driver_valid_to date, update_dt timestamp_ntz")
    start_waybills_intake(spark, drop, drivers, root, f"{root}/_ckpt").awaitTermination(120)
    rows = Store(spark, root).read("fact_waybills").collect()
    assert [r.waybill_num for r in rows] == ["W1"] and rows[0].driver_pers_num is not None
