from __future__ import annotations

import os
import sys
import tempfile
from contextlib import contextmanager
from datetime import date, datetime

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from covdrift import Messages, Params  # noqa: E402
from covdrift.schemas import SCHEMAS  # noqa: E402

TODAY = date(2024, 1, 16)
NOW = datetime(2024, 1, 16, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("covdrift-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-covdrift-warehouse-"))
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """``make(table, row, row, ...)``: a frame of that table; columns left out are NULL."""

    def build(table: str, *rows: dict) -> DataFrame:
        schema = SCHEMAS[table]
        unknown = {key for row in rows for key in row} - set(schema.names)
        assert not unknown, f"{table} has no column {unknown}"
        return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def params():
    return Params.at(NOW, messages=Messages(staff_team="Lead; Backup | Desk"))


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-covdrift-")


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
