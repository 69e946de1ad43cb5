"""Alert report: upcoming appointments whose coverage has drifted since the last dispense."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.operators.charges import dispense_charges, last_dispense
from covdrift.operators.coverage import current_primary, primary_at_dispense
from covdrift.operators.drift import NO_ALERT, drift
from covdrift.operators.enrich import plan_lookup, prefixed, with_office, with_patient, with_plan
from covdrift.operators.narrow import keys_of, only_keys
from covdrift.operators.schedule import next_appointment, open_appointments
from covdrift.operators.work import staged
from covdrift.params import Params

REPORT_COLUMNS = [
    "alert_priority",
    "alert_reason",
    "biologic_drug",
    "schedule_date",
    "schedule_time",
    "office_code",
    "patient_id",
    "patient_no",
    "patient_name",
    "schedule_status",
    "dispense_date",
    "dispense_code",
    "dispense_descr",
    "current_insurance_id",
    "current_plan_name",
    "current_carrier_name",
    "current_insurance_no",
    "current_membership_id",
    "current_group_no",
    "current_start_date",
    "current_changed_date",
    "dispense_insurance_id",
    "dispense_plan_name",
    "dispense_carrier_name",
    "dispense_insurance_no",
    "dispense_membership_id",
    "dispense_group_no",
    "dispense_ins_start_date",
    "dispense_ins_end_date",
    "schedule_tran_id",
    "dispense_tran_id",
]
COVERAGE = ["insurance_id", "insurance_no", "membership_id", "group_no", "group_name"]


def assemble(
    appointments: DataFrame, dispenses: DataFrame, current: DataFrame, at_dispense: DataFrame
) -> DataFrame:
    """Appointments with last dispense, current coverage and coverage at the dispense.

    Every side is unique on its join key by now. ``has_*`` is NULL where a side has no row.
    """
    present = F.lit(True)
    dispensed = dispenses.withColumn("has_dispense", present)
    now = prefixed(
        current, "current", [*COVERAGE, "start_date", "end_date", "changed_date"], ["patient_id"]
    ).withColumn("has_current", present)
    then = (
        prefixed(
            at_dispense,
            "dispense",
            [*COVERAGE, "start_date", "end_date", "changed_date"],
            ["patient_id", "biologic_drug"],
        )
        .withColumnsRenamed(
            {
                "dispense_start_date": "dispense_ins_start_date",
                "dispense_end_date": "dispense_ins_end_date",
                "dispense_changed_date": "dispense_ins_changed_date",
            }
        )
        .withColumn("has_at_dispense", present)
    )
    return (
        appointments.join(dispensed, ["patient_id", "biologic_drug"], "left")
        .join(then, ["patient_id", "biologic_drug"], "left")
        .join(now, "patient_id", "left")
    )


def appointment_outcomes(tables: Mapping[str, DataFrame], params: Params) -> DataFrame:
    """Every upcoming appointment with its one outcome, ``NO ALERT`` included."""
    appointments = open_appointments(
        tables["schedule_detail"], params.as_of, params.horizon_days, params.procedure_drugs
    )
    # Only patients with an appointment matter: keep the others out of the big shuffles.
    patients = keys_of(appointments, "patient_id")
    charges = dispense_charges(
        tables, params.rules, params.as_of, params.report_lookback_days, patients
    )
    # Read for the report and again for the coverage at that time: planned and run once.
    dispenses = staged(last_dispense(charges, ["patient_id", "biologic_drug"]))
    insurance = only_keys(tables["patient_insurance"], "patient_id", patients)
    base = assemble(
        next_appointment(appointments),
        dispenses,
        current_primary(insurance, params.as_of),
        primary_at_dispense(
            dispenses, insurance, params.as_of - timedelta(days=params.report_lookback_days)
        ),
    )
    plans = plan_lookup(tables["insurance_plan_master"], tables["insurance_carrier_master"])
    named = with_office(with_patient(base, tables["patient_master"]), tables["office_master"])
    return drift(with_plan(with_plan(named, plans, "current"), plans, "dispense"))


def alert_report(tables: Mapping[str, DataFrame], params: Params) -> DataFrame:
    """The 31 report columns of every appointment with an alert, in no order."""
    outcomes = appointment_outcomes(tables, params)
    return outcomes.where(F.col("alert_reason") != NO_ALERT).select(*REPORT_COLUMNS)


def alert_summary(outcomes: DataFrame) -> DataFrame:
    """Appointments per outcome."""
    return outcomes.groupBy("alert_reason", "alert_priority").agg(
        F.count("*").alias("appointments")
    )
