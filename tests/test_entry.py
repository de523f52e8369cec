"""Registered queries against their SQL on the smallest test tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract

from strata.plans.oracle import ORACLE as SQL
from strata.plans.queries import REGISTRY as QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not here")
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"create view {file.split('.')[0]} as select * from '{SF}/{file}'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_sql_has_a_query():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    rows = ordered(frame.columns, frame.collect())
    answer = duck.execute(SQL[name])
    columns = [c[0] for c in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows == ordered(columns, answer.fetchall())
    assert rows or name in {"unapproved_bronze_readers", "top_managers"}


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and frame.schema == contract.entry(spark).schema


NO_PYTHON = sorted(set(QUERIES) - {"ingest_roundtrip", "ingest_twice", "ingest_stream", "ctrl_ingest", "delivery_contract"})


@pytest.mark.parametrize("name", NO_PYTHON)
def test_plan_stays_in_the_jvm_and_has_no_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan
