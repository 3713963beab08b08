"""Every registered warehouse query equals its DuckDB oracle on the smallest scale factor."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cabwh.oracle.compare import canon, duck_rows
from cabwh.oracle.sql import ORACLE
from cabwh.plans.queries import REGISTRY as QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_driver_contract_lists_them():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, duck_small, name):
    df = QUERIES[name](spark, sf_small)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    d_cols, d_rows = duck_rows(duck_small, ORACLE[name])
    assert sorted(cols) == sorted(d_cols)
    assert len(rows) == len(d_rows)
    assert canon(rows, cols) == canon(d_rows, d_cols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["personnel_num", "last_name", "first_name", "middle_name", "card_num", "amount", "report_dt"]
    assert df.count() > 0
