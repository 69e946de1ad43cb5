"""The plans Spark makes: what reaches the scan, what is shuffled, how skew is met."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from covdrift.checks.queries import REGISTRY
from covdrift.operators.attribution import logged_since
from covdrift.operators.charges import dispense_charges, last_dispense
from covdrift.operators.coverage import (
    current_primary,
    primary_at_dispense,
    recent_primary_change,
    recent_primary_edits,
)
from covdrift.operators.schedule import open_appointments
from covdrift.schemas import SCHEMAS
from covdrift.sources.tables import load_tables
from tests.conftest import NOW, TODAY, settings

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Every domain table as Parquet, with one row each."""
    root = str(tmp_path_factory.mktemp("tables"))
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([tuple(None for _ in schema)], schema).write.parquet(
            f"{root}/{name}"
        )
    return load_tables(spark, root)


def _pushed(df) -> str:
    return " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(df)))


def test_filters_reach_the_scans(stored, params):
    charges = _pushed(dispense_charges(stored, params.rules, TODAY, 45))
    assert "GreaterThanOrEqual(service_date,2023-12-02)" in charges
    assert "IsNotNull(patient_id)" in charges

    current = _pushed(current_primary(stored["patient_insurance"], TODAY))
    assert "EqualTo(priority,P)" in current
    assert "LessThanOrEqual(start_date,2024-01-16)" in current
    assert "GreaterThanOrEqual(end_date,2024-01-16)" in current

    edits = recent_primary_edits(stored["patient_insurance"], NOW, 3)
    recent = _pushed(recent_primary_change(edits))
    assert "GreaterThanOrEqual(changed_date,2024-01-13T12:00)" in recent
    assert "GreaterThanOrEqual(created_date,2024-01-13T12:00)" in recent

    visits = _pushed(
        open_appointments(stored["schedule_detail"], TODAY, 14, params.procedure_drugs)
    )
    assert "GreaterThanOrEqual(schedule_date,2024-01-16)" in visits
    assert "LessThanOrEqual(schedule_date,2024-01-30)" in visits
    assert "In(procedure_id, [21,53,55])" in visits

    log = _pushed(logged_since(stored["edit_log_header"], "modified_date", NOW, 3, 10))
    assert "GreaterThanOrEqual(modified_date,2024-01-13T11:50)" in log


def test_old_coverage_is_skipped_by_the_scan(stored, params):
    charges = dispense_charges(stored, params.rules, TODAY, 365)
    by_drug = last_dispense(charges, ["patient_id", "biologic_drug"])
    text = _pushed(
        primary_at_dispense(by_drug, stored["patient_insurance"], TODAY - timedelta(days=365))
    )
    assert "GreaterThanOrEqual(end_date,2023-01-16)" in text


def test_scans_read_only_needed_columns(stored):
    small = current_primary(stored["patient_insurance"], TODAY).select("patient_id", "group_no")
    (read,) = re.findall(r"ReadSchema: struct<(.*?)>", plan(small))
    columns = {column.split(":")[0] for column in read.split(",")}
    assert "group_no" in columns
    assert not columns & {"insurance_id", "insurance_no", "membership_id", "group_name"}


def test_top_one_is_limited_before_the_shuffle(stored):
    text = plan(current_primary(stored["patient_insurance"], TODAY))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange hashpartitioning") < partial


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_no_query_uses_a_nested_loop_or_python(spark, broadcast):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=broadcast):
        for name, build in REGISTRY.items():
            text = plan(build(spark, SF))
            for operator in ("NestedLoop", "Cartesian", "EvalPython", "MapInPandas"):
                assert operator not in text, (name, operator)


def _skewed(spark, rows):
    """A third of the rows belong to patient 0; sized so that its partition counts as skewed."""
    return {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
        "spark__sql__adaptive__coalescePartitions__enabled": "false",
        "spark__sql__shuffle__partitions": "16",
    }, spark.range(0, rows, 1, 8).withColumn(
        "patient_id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    )


def test_hot_patient_is_split_in_the_point_in_time_join(spark, folder):
    conf, base = _skewed(spark, 30_000)
    insurance = base.select(
        "patient_id",
        F.col("id").alias("sr_id"),
        F.lit("P").alias("priority"),
        F.date_add(F.lit(date(2020, 1, 1)), F.pmod("id", F.lit(1400)).cast("int")).alias(
            "start_date"
        ),
        F.lit(None).cast("date").alias("end_date"),
        F.lit("Y").alias("active"),
        F.concat(F.lit("M"), F.col("id")).alias("membership_id"),
    )
    dispensed = (
        base.select("patient_id")
        .distinct()
        .select(
            "patient_id",
            F.lit("XOLAIR").alias("biologic_drug"),
            F.lit(date(2023, 6, 1)).alias("dispense_date"),
        )
    )
    # As from the ranking before it, the dispenses are not laid out by patient.
    dispensed.repartition(4, "dispense_date").write.parquet(folder + "/dispensed")
    dispensed = spark.read.parquet(folder + "/dispensed")
    with settings(spark, **conf):
        found = primary_at_dispense(dispensed, insurance)
        text = final_plan(found)
        assert "skew=true" in text
        hot = found.where("patient_id = 0").collect()
        # Row ids of patient 0 are multiples of 3; the latest start on or before June 1st wins.
        best = max((i % 1400, i) for i in range(0, 30_000, 3) if i % 1400 <= 1247)
        assert [r.sr_id for r in hot] == [best[1]]
        covered = [i for i in range(30_000) if i % 3 and i % 1400 <= 1247]
        assert found.count() == 1 + len(covered)


def test_hot_transaction_is_split_in_the_charge_join(spark, make, params):
    conf, base = _skewed(spark, 30_000)
    tables = {
        "billing_detail": base.select(
            F.col("patient_id").alias("tran_id"),
            F.col("id").alias("sr_id"),
            F.lit("XO150").alias("billing_id"),
            F.lit(TODAY).alias("service_date"),
        ),
        "billing_header": base.select(F.col("patient_id").alias("tran_id"), "patient_id").distinct(),
        "billing_master": make("billing_master", {"billing_id": "XO150", "descr": "d"}),
    }
    with settings(spark, **conf):
        newest = last_dispense(
            dispense_charges(tables, params.rules, TODAY, 45), ["patient_id", "biologic_drug"]
        )
        text = final_plan(newest)
        assert "skew=true" in text
        assert [r.dispense_sr_id for r in newest.where("patient_id = 0").collect()] == [29_997]


def test_times_do_not_depend_on_the_session_zone(spark, make):
    bound = datetime(2024, 3, 10, 2, 30)  # skipped by daylight saving time in New York
    rows = make(
        "patient_insurance",
        {"patient_id": 1, "sr_id": 1, "priority": "P", "changed_date": bound},
        {"patient_id": 2, "sr_id": 1, "priority": "P", "changed_date": bound - timedelta(minutes=1)},
    )
    with settings(spark, spark__sql__session__timeZone="America/New_York"):
        edits = recent_primary_edits(rows, bound + timedelta(days=3), 3)
        found = recent_primary_change(edits).collect()
    assert [(r.patient_id, r.insurance_change_ts) for r in found] == [(1, bound)]
