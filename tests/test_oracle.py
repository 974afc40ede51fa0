"""Every registered query agrees with its independent DuckDB formulation (smoke scale;
tests/run_oracle.py runs the same comparison at sf0.01)."""

from __future__ import annotations

import pytest
from compare import digest, duck, duck_rows, spark_rows
from conftest import SMOKE_DIR

import __spark_entry__ as E
from spendlens.plans.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sc, sr = spark_rows(E.queries()[name](spark, SMOKE_DIR))
    dc, dr = duck_rows(con, E.oracle_sql()[name])
    assert digest(sc, sr) == digest(dc, dr)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "SPEND" in df.columns
