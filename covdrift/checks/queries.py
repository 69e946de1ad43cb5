"""The registered queries: every operator and pipeline over the whole test tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covdrift.operators.attribution import (
    LogSource,
    attribute,
    audit_trail_source,
    edit_log_source,
    match_logs,
)
from covdrift.operators.charges import classify, dispense_charges, last_dispense
from covdrift.operators.coverage import (
    change_after_dispense,
    current_primary,
    in_force_at,
    primary_at_dispense,
    recent_primary_change,
    recent_primary_edits,
)
from covdrift.operators.enrich import plan_lookup, prefixed, with_plan
from covdrift.operators.ids import assign_ids, max_id
from covdrift.operators.outbox import (
    capped_numbers,
    shown_numbers,
    staff_outbox,
    user_numbers,
    user_outbox,
)
from covdrift.operators.reminders import (
    missing_details,
    open_count,
    reminder_rows,
    suppress_open,
)
from covdrift.operators.schedule import next_appointment, open_appointments
from covdrift.operators.snapshot import (
    COVERAGE_FIELDS,
    alert_text,
    approval_sources,
    coverage_snapshot,
    dispense_sources,
    snapshot_drift,
    unresolved,
)
from covdrift.operators.users import patient_alerts, resolve_user, unattributed, user_alerts
from covdrift.operators.work import staged, work_folder
from covdrift.plans import alert_report as report
from covdrift.plans import reminders
from covdrift.schemas import SCHEMAS, conform
from covdrift.sinks.reports import numbered_candidates, numbered_report, report_metrics
from covdrift.sinks.store import ReminderStore
from covdrift.sources.adapter import AS_OF, AS_OF_TS, TEST_PARAMS, TEST_RULES, VIEWS, TestTables

P = TEST_PARAMS
MARKER = P.routing.marker
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[TestTables], DataFrame]], None]:
    """Register a query over the test tables under ``name``."""

    def register(build: Callable[[TestTables], DataFrame]) -> None:
        REGISTRY[name] = lambda spark, folder: build(TestTables(spark, folder))

    return register


def _charges(t: TestTables, days: int) -> DataFrame:
    return dispense_charges(t, TEST_RULES, AS_OF, days)


def _last_by_drug(t: TestTables) -> DataFrame:
    return last_dispense(_charges(t, P.report_lookback_days), ["patient_id", "biologic_drug"])


def _last(t: TestTables) -> DataFrame:
    return last_dispense(_charges(t, P.dispense_lookback_days), ["patient_id"])


def _recent(t: TestTables) -> DataFrame:
    edits = recent_primary_edits(t["patient_insurance"], AS_OF_TS, P.change_lookback_days)
    return recent_primary_change(edits)


def _sources(t: TestTables) -> list[LogSource]:
    return [
        edit_log_source(t["edit_log_header"], P.system_users),
        audit_trail_source(t["audit_trail"], P.system_users),
    ]


def _attributed(t: TestTables) -> DataFrame:
    return attribute(t["insurance_change"], _sources(t), P.audit_minutes)


def _resolved(t: TestTables) -> DataFrame:
    # Read twice by the lookup, and again by the alerts: written once instead of planned again.
    return resolve_user(staged(_attributed(t)), t["emp_master"])


def _numbers(t: TestTables) -> DataFrame:
    return user_numbers(user_alerts(_resolved(t), t["patient_master"]))


def _listed(t: TestTables) -> DataFrame:
    return shown_numbers(_numbers(t), P.messages.shown_numbers)


def _rows(t: TestTables) -> DataFrame:
    return reminder_rows(reminders.reminder_candidates(t, P), P)


def _flat(outbox: DataFrame) -> DataFrame:
    return outbox.withColumn("employees", F.array_join("employees", "; "))


def run_tables(t: TestTables) -> dict[str, DataFrame]:
    """The tables of a run: its logs hold entries near the coverage edits as well."""
    tables = {name: t[name] for name in VIEWS}
    for log, near in (("edit_log_header", "coverage_edit_log"), ("audit_trail", "coverage_audit_trail")):
        tables[log] = t[log].unionByName(conform(t[near], SCHEMAS[log]))
    return tables


def _applied(t: TestTables) -> tuple[ReminderStore, reminders.ReminderRun]:
    """An applied run in a store of its own, which starts with the test table's reminders.

    Run again under its id, as by several queries of a session, it reads what it stored.
    """
    spark = t["todo"].sparkSession
    session = hashlib.md5(f"{spark.sparkContext.applicationId} {t.folder}".encode()).hexdigest()
    store = ReminderStore(spark, f"{work_folder(spark)}/store-{session}", buckets=8).create()
    if not store.committed("before"):
        store.commit("before", 0, {name: t[name] for name in ("todo", "tobe_done_detail")})
    return store, reminders.run_reminders(run_tables(t), P, store, "run", apply=True)


@query("classify_dispense")
def _classify_dispense(t):
    return classify(t["billing_master"], "billing_id", "descr", TEST_RULES)


@query("charges_all")
def _charges_all(t):
    return _charges(t, 36_500)


@query("dispense_charges")
def _dispense_charges_recent(t):
    return _charges(t, P.report_lookback_days)


@query("last_dispense_by_drug")
def _last_dispense_by_drug(t):
    return _last_by_drug(t)


@query("last_dispense")
def _last_dispense_by_patient(t):
    return _last(t)


@query("current_primary")
def _current_primary_coverage(t):
    return current_primary(t["patient_insurance"], AS_OF)


@query("primary_at_dispense")
def _primary_coverage_at_dispense(t):
    return primary_at_dispense(_last_by_drug(t), t["patient_insurance"])


@query("recent_primary_change")
def _recent_coverage_change(t):
    return _recent(t)


@query("change_after_dispense")
def _change_after_last_dispense(t):
    found = change_after_dispense(_last(t), _recent(t))
    return found.select(
        "patient_id",
        "biologic_drug",
        "dispense_date",
        "dispense_tran_id",
        "sr_id",
        "start_date",
        "created_date",
        "insurance_change_ts",
    )


@query("next_appointment")
def _next_appointments(t):
    appointments = open_appointments(
        t["schedule_detail"], AS_OF, P.horizon_days, P.procedure_drugs
    )
    return next_appointment(appointments)


@query("enrich_plan_carrier")
def _enrich_plan_carrier(t):
    plans = plan_lookup(t["insurance_plan_master"], t["insurance_carrier_master"])
    rows = prefixed(
        t["patient_insurance"], "current", ["insurance_id"], ["patient_id", "sr_id"]
    )
    return with_plan(rows, plans, "current")


@query("appointment_outcomes")
def _appointment_outcomes(t):
    outcomes = report.appointment_outcomes(t, P)
    return outcomes.select(
        "schedule_tran_id", "patient_id", "biologic_drug", "alert_reason", "alert_priority"
    )


@query("alert_report")
def _alert_report(t):
    return report.alert_report(t, P)


@query("alert_summary")
def _alert_summary(t):
    return report.alert_summary(report.appointment_outcomes(t, P))


@query("report_metrics")
def _alert_report_rows(t):
    return report_metrics(report.alert_report(t, P))


@query("alert_text")
def _alert_texts(t):
    return alert_text(report.alert_report(t, P))


@query("suppress_open")
def _suppress_open_reminders(t):
    return suppress_open(_last(t), t["todo"], MARKER).select(
        "patient_id", "biologic_drug", "dispense_date", "dispense_tran_id"
    )


@query("reminder_candidates")
def _reminder_candidates(t):
    return reminders.reminder_candidates(t, P)


@query("todo_rows")
def _todo_rows(t):
    return reminders.new_reminders(reminders.reminder_candidates(t, P), t["todo"], P)


@query("assign_ids")
def _assign_dispense_ids(t):
    rows = _last(t).select("patient_id", "biologic_drug")
    return assign_ids(rows, max_id(t["todo"]), "patient_id", "new_id")


@query("missing_details")
def _missing_detail_rows(t):
    return missing_details(t["todo"], t["tobe_done_detail"], MARKER).select(
        "tran_id", "forwhom_id", "todo_date"
    )


@query("detail_backfill")
def _detail_backfill(t):
    return reminders.new_details(t["todo"], t["tobe_done_detail"], P)


@query("open_count")
def _open_reminder_count(t):
    return open_count(t["todo"], MARKER)


@query("max_id")
def _highest_ids(t):
    return max_id(t["todo"]).unionByName(max_id(t["tobe_done_detail"]))


@query("match_edit_log")
def _edit_log_match(t):
    return match_logs(t["insurance_change"], _sources(t)[:1], P.audit_minutes).drop("log")


@query("match_audit_trail")
def _audit_trail_match(t):
    return match_logs(t["insurance_change"], _sources(t)[1:], P.audit_minutes).drop("log")


@query("audit_union")
def _audit_union(t):
    return match_logs(t["insurance_change"], _sources(t), P.audit_minutes)


@query("audit_attribution")
def _audit_attribution(t):
    return _attributed(t)


@query("resolve_user")
def _resolve_audit_user(t):
    return _resolved(t)


@query("patient_alerts")
def _patient_alert_numbers(t):
    return patient_alerts(_rows(t), t["patient_master"])


@query("user_alerts")
def _user_alert_rows(t):
    return user_alerts(_resolved(t), t["patient_master"])


@query("unattributed")
def _unattributed_reminders(t):
    return unattributed(_rows(t), _resolved(t))


@query("outbox_user")
def _outbox_user_numbers(t):
    return _numbers(t)


@query("outbox_capped")
def _outbox_capped(t):
    return capped_numbers(_listed(t))


@query("user_outbox")
def _outbox_user(t):
    return _flat(user_outbox(_listed(t), P))


@query("staff_outbox")
def _outbox_staff(t):
    rows = _rows(t)
    return _flat(staff_outbox(patient_alerts(rows, t["patient_master"]), rows, P))


@query("coverage_snapshot")
def _dispense_snapshot(t):
    by_drug = _last_by_drug(t)
    return coverage_snapshot(by_drug, primary_at_dispense(by_drug, t["patient_insurance"]))


@query("snapshot_drift")
def _snapshot_changes(t):
    by_drug = _last_by_drug(t)
    snapshots = coverage_snapshot(by_drug, primary_at_dispense(by_drug, t["patient_insurance"]))
    return snapshot_drift(snapshots, current_primary(t["patient_insurance"], AS_OF))


@query("coverage_at_events")
def _coverage_at_events(t):
    approved = approval_sources(t["approval"]).select("patient_id", "biologic_drug", "source_event", "source_tran_id", "source_date")
    sources = dispense_sources(_charges(t, 36_500)).select(*approved.columns).union(approved.distinct())
    dated = staged(sources.withColumnRenamed("source_date", "event_date"))
    found = in_force_at(dated, t["patient_insurance"]).select("patient_id", "event_date", "sr_id", *COVERAGE_FIELDS)
    # Merged: broadcast, what is a small file would fill the driver's memory.
    return dated.hint("merge").join(found, ["patient_id", "event_date"])


@query("snapshot_state")
def _snapshot_state(t):
    return _applied(t)[0].snapshots()


@query("open_snapshot_drift")
def _open_snapshot_drift(t):
    return snapshot_drift(unresolved(_applied(t)[0].snapshots()), current_primary(t["patient_insurance"], AS_OF))


@query("alert_report_ordered")
def _alert_report_ordered(t):
    return numbered_report(report.alert_report(t, P))


@query("candidates_ordered")
def _candidates_ordered(t):
    return numbered_candidates(reminders.reminder_candidates(t, P))


@query("pipeline_todo")
def _pipeline_todo(t):
    return _applied(t)[0].todo()


@query("pipeline_details")
def _pipeline_details(t):
    return _applied(t)[0].details()


@query("pipeline_attribution")
def _pipeline_attribution(t):
    return _applied(t)[1].attributed


@query("pipeline_user_alerts")
def _pipeline_user_alerts(t):
    return user_alerts(_applied(t)[1].attributed, t["patient_master"])


@query("pipeline_unattributed")
def _pipeline_unattributed(t):
    run = _applied(t)[1]
    return unattributed(run.batch, run.attributed)


@query("outbox_payload")
def _outbox_payload(t):
    return _flat(_applied(t)[1].outbox)
