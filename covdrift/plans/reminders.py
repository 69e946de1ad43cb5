"""Reminder workflow: candidates, new reminders with their task rows, and the notices."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import map_code
from covdrift.functions.text import reminder_text
from covdrift.operators.attribution import (
    attribute,
    audit_trail_source,
    edit_log_source,
    logged_since,
)
from covdrift.operators.charges import dispense_charges, last_dispense
from covdrift.operators.coverage import (
    change_after_dispense,
    current_primary,
    recent_primary_change,
    recent_primary_edits,
)
from covdrift.operators.enrich import plan_lookup, prefixed, with_patient, with_plan
from covdrift.operators.ids import assign_ids, max_id
from covdrift.operators.narrow import keys_of, only_keys
from covdrift.operators.outbox import (
    shown_numbers,
    staff_outbox,
    user_numbers,
    user_outbox,
    with_payload,
)
from covdrift.operators.reminders import (
    as_detail,
    as_todo,
    detail_rows,
    missing_details,
    open_count,
    reminder_rows,
    suppress_open,
)
from covdrift.operators.snapshot import (
    approval_sources,
    dispense_sources,
    new_events,
    resolution_events,
    taken_events,
)
from covdrift.operators.users import patient_alerts, resolve_user, unattributed, user_alerts
from covdrift.operators.work import staged
from covdrift.params import Params
from covdrift.sinks.reports import order_candidates, write_report
from covdrift.sinks.store import ReminderStore

CANDIDATE_COLUMNS = [
    "category_id",
    "biologics_group_id",
    "biologic_drug",
    "patient_id",
    "patient_no",
    "patient_name",
    "dispense_date",
    "dispense_code",
    "dispense_descr",
    "insurance_change_ts",
    "changed_insurance_id",
    "changed_plan_name",
    "changed_carrier_name",
    "changed_membership_id",
    "changed_group_no",
    "changed_insurance_active",
    "changed_insurance_start_date",
    "changed_insurance_end_date",
    "current_insurance_id",
    "current_plan_name",
    "current_carrier_name",
    "current_membership_id",
    "current_group_no",
    "reminder_text",
    "dispense_tran_id",
    "dispense_sr_id",
    "changed_insurance_sr_id",
]


def reminder_candidates(
    tables: Mapping[str, DataFrame], params: Params, extra: Column | None = None
) -> DataFrame:
    """Patients due a reminder, one row each, in no order. ``extra`` restricts them further."""
    insurance = tables["patient_insurance"]
    # A few days' edits, read for the keys and again for the change.
    edits = staged(recent_primary_edits(insurance, params.as_of_ts, params.change_lookback_days))
    # Only patients with a recent change matter: keep the others out of the big shuffles.
    changed_patients = keys_of(edits, "patient_id")
    charges = dispense_charges(
        tables, params.rules, params.as_of, params.dispense_lookback_days, changed_patients
    )
    changed = recent_primary_change(edits).select(
        "patient_id",
        "insurance_change_ts",
        "start_date",
        "created_date",
        F.col("sr_id").alias("changed_insurance_sr_id"),
        F.col("insurance_id").alias("changed_insurance_id"),
        F.col("membership_id").alias("changed_membership_id"),
        F.col("group_no").alias("changed_group_no"),
        F.col("active").alias("changed_insurance_active"),
        F.col("start_date").alias("changed_insurance_start_date"),
        F.col("end_date").alias("changed_insurance_end_date"),
    )
    due = suppress_open(
        change_after_dispense(last_dispense(charges, ["patient_id"]), changed),
        tables["todo"],
        params.routing.marker,
    )
    current = prefixed(
        current_primary(only_keys(insurance, "patient_id", changed_patients), params.as_of),
        "current",
        ["insurance_id", "insurance_no", "membership_id", "group_no"],
        ["patient_id"],
    )
    plans = plan_lookup(tables["insurance_plan_master"], tables["insurance_carrier_master"])
    named = with_patient(due.join(current, "patient_id", "left"), tables["patient_master"])
    named = with_plan(with_plan(named, plans, "changed"), plans, "current")
    result = named.select(
        "*",
        map_code(F.col("biologic_drug"), params.drug_categories).alias("category_id"),
        F.lit(params.routing.group_id).alias("biologics_group_id"),
        reminder_text(
            F.col("biologic_drug"),
            F.col("dispense_date"),
            F.col("dispense_code"),
            F.col("current_plan_name"),
            F.col("current_membership_id"),
            F.col("current_insurance_no"),
            F.col("current_group_no"),
        ).alias("reminder_text"),
    )
    if extra is not None:
        result = result.where(extra)
    return result.select(*CANDIDATE_COLUMNS)


def new_reminders(candidates: DataFrame, todo: DataFrame, params: Params) -> DataFrame:
    """Candidates as complete reminder rows, numbered in the order of their patients."""
    rows = reminder_rows(candidates, params)
    return as_todo(assign_ids(rows, max_id(todo), "forwhom_id", "tran_id"))


def new_details(todo: DataFrame, details: DataFrame, params: Params) -> DataFrame:
    """Task rows for every open reminder without one, numbered in the order of the reminders."""
    missing = missing_details(todo, details, params.routing.marker)
    return assign_ids(detail_rows(missing, params), max_id(details), "todo_id", "tran_id")


def attributed_changes(
    batch: DataFrame, tables: Mapping[str, DataFrame], params: Params
) -> DataFrame:
    """(patient_id, insurance_sr_id, audit_user, audit_ts, employee_name) for new reminders."""
    patients = batch.select(F.col("forwhom_id").alias("patient_id"))
    insurance = tables["patient_insurance"].join(patients.distinct(), "patient_id", "left_semi")
    days, minutes = params.change_lookback_days, params.audit_minutes
    changes = recent_primary_change(
        recent_primary_edits(insurance, params.as_of_ts, days)
    ).withColumnRenamed("sr_id", "insurance_sr_id")
    edits = logged_since(tables["edit_log_header"], "modified_date", params.as_of_ts, days, minutes)
    trail = logged_since(tables["audit_trail"], "tran_date", params.as_of_ts, days, minutes)
    users = params.system_users
    sources = [edit_log_source(edits, users), audit_trail_source(trail, users)]
    # Changes and their authors are few and read several times.
    audited = staged(attribute(staged(changes), sources, minutes))
    return resolve_user(audited, tables["emp_master"])


def coverage_events(tables: Mapping[str, DataFrame], params: Params) -> DataFrame:
    """What a run knows of coverage snapshots: recent dispenses, approvals and resolutions.

    ``approval`` and ``resolution`` are optional tables; see ``operators.snapshot``.
    """
    charges = dispense_charges(tables, params.rules, params.as_of, params.dispense_lookback_days)
    sources = dispense_sources(charges)
    if "approval" in tables:
        sources = sources.unionByName(approval_sources(tables["approval"]), allowMissingColumns=True)
    events = taken_events(staged(sources), tables["patient_insurance"])
    if "resolution" in tables:
        events = events.unionByName(resolution_events(tables["resolution"]))
    return events


@dataclass(frozen=True)
class ReminderRun:
    """What a run found and did: candidates of a dry run, the new reminders of an applied one."""

    candidates: DataFrame | None = None
    candidate_rows: int | None = None
    batch: DataFrame | None = None
    inserted: int = 0
    open_reminders: int | None = None
    attributed: DataFrame | None = None
    unattributed: int = 0
    report_path: str | None = None
    outbox: DataFrame | None = None


def _reserved(store: ReminderStore, table: str, owner: str, rows: int) -> DataFrame:
    """The highest id that comes before the range reserved for ``rows`` new rows."""
    start = store.reserve(table, owner, rows) if rows else 1
    return store.spark.createDataFrame([(start - 1,)], "max_id bigint")


def append_run(
    store: ReminderStore, run_id: str, candidates: DataFrame, events: DataFrame, params: Params
) -> None:
    """Commit a run's reminders, task rows and coverage events together, on the newest version.

    If another run commits first, what it opened is left out and the rest is tried again. Rows are
    staged per version that they were decided on, so a run that is started again uses them.
    """
    marker = params.routing.marker
    while not store.committed(run_id):
        version = store.version()
        todo, details = store.todo(version), store.details(version)
        tag = f"{run_id}-v{version}"
        rows, n = store.stage_counted(
            "reminders", tag, lambda: reminder_rows(suppress_open(candidates, todo, marker), params)
        )
        base = _reserved(store, "todo", tag, n)
        batch = store.stage("staging", tag, lambda: as_todo(assign_ids(rows, base, "forwhom_id", "tran_id")))
        both = todo.unionByName(batch)
        lacking, n = store.stage_counted(
            "lacking", tag, lambda: detail_rows(missing_details(both, details, marker), params)
        )
        first = _reserved(store, "tobe_done_detail", tag, n)
        tasks = store.stage("tasks", tag, lambda: as_detail(assign_ids(lacking, first, "todo_id", "tran_id")))
        known = store.read("coverage_event", version)
        fresh = store.stage("new_events", tag, lambda: new_events(events, known))
        store.commit(run_id, version, {"todo": batch, "tobe_done_detail": tasks, "coverage_event": fresh})


def run_reminders(
    tables: Mapping[str, DataFrame],
    params: Params,
    store: ReminderStore,
    run_id: str,
    apply: bool = False,
    extra: Column | None = None,
    report_folder: str | None = None,
) -> ReminderRun:
    """Find the candidates and, with ``apply``, write reminders, task rows, snapshots and notices.

    ``tables`` needs no ``todo`` or ``tobe_done_detail``: those are the store's. A dry run writes
    the candidate report if ``report_folder`` is given, and nothing else.
    """
    tables = {**tables, "todo": store.todo()}
    if not apply:
        candidates = reminder_candidates(tables, params, extra)
        if report_folder is None:
            return ReminderRun(candidates)
        path, rows = write_report(
            order_candidates(candidates), report_folder, "reminder_candidates", run_id
        )
        return ReminderRun(candidates, candidate_rows=rows, report_path=path)

    # From here on everything reads what is staged or committed: once the batch is in ``todo``, the
    # candidates would suppress themselves.
    if not store.committed(run_id):
        found = store.stage("candidates", run_id, lambda: reminder_candidates(tables, params, extra))
        events = store.stage("events", run_id, lambda: coverage_events(tables, params))
        append_run(store, run_id, found, events, params)
    batch = store.read("todo", run_id=run_id)
    inserted = batch.count()
    still_open = open_count(store.todo(), params.routing.marker).first()[0]
    if inserted == 0:
        return ReminderRun(batch=batch, open_reminders=still_open)

    resolved = store.stage("attributed", run_id, lambda: attributed_changes(batch, tables, params))
    return ReminderRun(
        batch=batch,
        inserted=inserted,
        open_reminders=still_open,
        attributed=resolved,
        unattributed=unattributed(batch, resolved).first()[0],
        outbox=store.stage(
            "outbox", run_id, lambda: notices(batch, resolved, tables["patient_master"], params)
        ),
    )


def notices(
    batch: DataFrame, resolved: DataFrame, patients: DataFrame, params: Params
) -> DataFrame:
    """Staff and employee notices of one batch, with their JSON payload."""
    staff = staff_outbox(patient_alerts(batch, patients), batch, params)
    numbers = shown_numbers(
        user_numbers(user_alerts(resolved, patients)), params.messages.shown_numbers
    )
    return with_payload(staff.unionByName(user_outbox(numbers, params)))
