"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import os
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as contract
from covdrift.checks.oracle import oracle_sql, with_steps
from covdrift.checks.queries import REGISTRY
from covdrift.operators.charges import dispense_charges, last_dispense
from covdrift.plans.reminders import attributed_changes
from covdrift.sources.adapter import AS_OF, SOURCES, TEST_PARAMS, TEST_RULES, TestTables

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


LARGEST = "/root/testdata/sf0.1"


def _connect(folder):
    db = duckdb.connect()
    for table in SOURCES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return db


@pytest.fixture(scope="module")
def duck():
    return _connect(SF)


def _normal(rows, columns):
    def value(v):
        return v.isoformat() if isinstance(v, (date, datetime)) else v

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(SQL) == set(REGISTRY)
    assert set(SQL) <= set(contract.oracle_sql()) and set(REGISTRY) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    found = REGISTRY[name](spark, SF)
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    expected = _normal(cursor.fetchall(), columns)
    assert expected, "the query should find something"
    assert _normal([tuple(r) for r in found.collect()], found.columns) == expected


def test_attribution_of_real_changes(spark):
    """The whole chain from coverage rows to employees; smaller tables hold no match."""
    tables = TestTables(spark, LARGEST)
    charges = dispense_charges(tables, TEST_RULES, AS_OF, TEST_PARAMS.dispense_lookback_days)
    batch = last_dispense(charges, ["patient_id"]).selectExpr("patient_id as forwhom_id")
    found = attributed_changes(batch, tables, TEST_PARAMS)
    cursor = _connect(LARGEST).execute(with_steps("SELECT * FROM resolved_recent"))
    columns = [c[0] for c in cursor.description]
    expected = _normal(cursor.fetchall(), columns)
    assert len(expected) == 69
    assert _normal([tuple(r) for r in found.collect()], found.columns) == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 33
