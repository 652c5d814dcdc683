"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from loyalflow.plans.queries import QUERIES as OWN
from tests.conftest import SMALL
from tools.oracle_check import canon, duck

QUERIES = {k: f for k, f in entry.queries().items() if k in OWN}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in OWN}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, small_src, name):
    df = QUERIES[name](spark, SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    d_cols, d_rows = duck(SMALL, ORACLE[name])
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert canon(s_cols, s_rows) == canon(d_cols, d_rows)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 38
