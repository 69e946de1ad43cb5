from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from covdrift.operators.ids import positions
from covdrift.schemas import SCHEMAS, conform
from covdrift.sinks.reports import report_metrics, write_report
from covdrift.sources.tables import load_table, load_tables
from tests.conftest import settings, tuples


def test_all_tables_are_declared():
    assert len(SCHEMAS) == 14
    assert len(SCHEMAS["todo"]) == 26 and len(SCHEMAS["tobe_done_detail"]) == 11


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc", "json"])
def test_load_tables(spark, make, folder, fmt):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    source = make("audit_trail", {"user_name": "a, \"b\"", "tran_date": at, "sql_syntax": "x"})
    options = {}
    if fmt in ("csv", "json"):
        options = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "escape": '"'}
    source.write.format(fmt).options(header=True, **options).save(f"{folder}/audit_trail")
    tables = load_tables(spark, folder, fmt, options, names=["audit_trail"])
    assert tables["audit_trail"].schema == SCHEMAS["audit_trail"]
    assert tuples(tables["audit_trail"], *source.columns) == [('a, "b"', at, "x")]


def test_per_table_options(spark, make, folder):
    make("emp_master", {"empid": 1}).write.option("header", True).option("sep", "|").csv(
        f"{folder}/emp_master"
    )
    options = {"emp_master": {"sep": "|"}}
    tables = load_tables(spark, folder, "csv", names=["emp_master"], table_options=options)
    assert tuples(tables["emp_master"], "empid") == [(1,)]


def test_unknown_table(spark, folder):
    with pytest.raises(KeyError):
        load_table(spark, "no_such_table", folder)


def test_conform_adds_and_casts(spark):
    df = spark.createDataFrame([(1, 5)], "empid int, other int")
    row = conform(df, SCHEMAS["emp_master"]).first()
    assert row.asDict() == {"empid": 1, "user_name": None, "firstname": None, "lastname": None}


def test_report_is_quoted_counted_and_never_overwritten(spark, folder):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    rows = [(1, 'say "hi", then\nleave', at), (2, None, None), (3, "back\\slash", at)]
    df = spark.createDataFrame(rows, "id int, note string, at timestamp_ntz")
    path, count = write_report(df.repartition(3), folder, "alerts", "20240116_120000")
    assert path.endswith("/alerts_20240116_120000.csv") and count == 3
    assert os.path.isfile(path) and open(path).read().count("id,note,at") == 1
    assert [f for f in os.listdir(folder) if not f.endswith(".crc")] == ["alerts_20240116_120000.csv"]
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    assert tuples(reader.csv(path), "note") == sorted([(n,) for _, n, _ in rows], key=repr)
    assert ("2024-01-02 03:04:05.678901",) in tuples(reader.csv(path), "at")
    with pytest.raises(Exception, match="(?i)already exists"):
        write_report(df, folder, "alerts", "20240116_120000")
    assert tuples(report_metrics(df), "report_rows") == [(3,)]
    path, none = write_report(df.where("id > 9"), folder, "alerts", "20240116_120001")
    assert none == 0 and open(path).read() == "id,note,at\n"


def test_one_file_keeps_the_order_of_the_ranges(spark, folder):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 1777 % 5003).alias("n"))
    with settings(spark, spark__sql__adaptive__enabled="false"):
        path, count = write_report(rows.orderBy("n"), folder, "ordered", "1")
    read = [int(line) for line in open(path).read().split("\n")[1:-1]]
    assert count == 5000 and read == sorted(read) and len(read) == 5000


def test_positions_follow_the_order(spark):
    rows = spark.range(0, 3000, 1, 5).select((F.col("id") * 7 % 3001).alias("k"), (F.col("id") % 3).alias("g"))
    found = positions(rows, [F.col("g").desc(), F.col("k").asc()], "at").collect()
    assert sorted(r["at"] for r in found) == list(range(1, 3001))
    assert [r.k for r in sorted(found, key=lambda r: r["at"])] == [
        r.k for r in sorted(found, key=lambda r: (-r.g, r.k))
    ]
