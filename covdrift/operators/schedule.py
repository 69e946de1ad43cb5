"""Upcoming appointments."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import map_code, within
from covdrift.operators.latest import latest_per


def open_appointments(
    schedule: DataFrame, as_of: date, horizon_days: int, procedure_drugs: Mapping[int, str]
) -> DataFrame:
    """Appointments for a drug procedure within the horizon that were not canceled."""
    return schedule.where(
        within(F.col("schedule_date"), as_of, horizon_days)
        & F.col("procedure_id").isin(*procedure_drugs)
        & F.col("forwhom_id").isNotNull()
        & F.col("canceled_date").isNull()
    ).select(
        F.col("tran_id").alias("schedule_tran_id"),
        F.col("forwhom_id").alias("patient_id"),
        F.col("forwhom_name").alias("schedule_patient_name"),
        "procedure_id",
        map_code(F.col("procedure_id"), procedure_drugs).alias("biologic_drug"),
        "schedule_date",
        "schedule_time",
        "office_id",
        F.col("status").alias("schedule_status"),
        "schedule_note",
    )


def next_appointment(appointments: DataFrame) -> DataFrame:
    """Each patient's soonest of the open appointments, per procedure."""
    soonest = [F.col(c).asc_nulls_first() for c in ("schedule_date", "schedule_time")]
    return latest_per(
        appointments, ["patient_id", "procedure_id"], [*soonest, F.col("schedule_tran_id").asc()]
    )
