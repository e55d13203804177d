"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract
from strata.workloads import ORACLE, QUERIES
from tools.check import normal

SF_DIR = os.environ.get("STRATA_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables to read")


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = oracle.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(df.columns, df.collect()) == normal(names, result.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["part"] for r in rows} == {"F", "O", "P"}
