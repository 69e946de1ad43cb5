from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from covdrift.operators.snapshot import (
    alert_text,
    coverage_snapshot,
    new_events,
    resolution_events,
    snapshot_drift,
    taken_events,
    unresolved,
)
from covdrift.operators.charges import dispense_charges, last_dispense
from covdrift.operators.coverage import current_primary, primary_at_dispense
from covdrift.plans.alert_report import (
    REPORT_COLUMNS,
    alert_report,
    alert_summary,
    appointment_outcomes,
)
from covdrift.sinks.reports import order_report
from covdrift.sinks.store import ReminderStore
from tests.conftest import TODAY, settings, tuples

DISPENSED = date(2023, 12, 1)
SINCE = date(2023, 1, 1)
SAME = {
    "insurance_id": 5,
    "insurance_no": "I",
    "membership_id": "M",
    "group_no": "G",
    "group_name": "N",
    "priority": "P",
    "created_date": datetime(2023, 1, 1),
}
# Coverage at the dispense, ended before today; each case adds today's row.
OLD = {**SAME, "sr_id": 1, "start_date": SINCE, "end_date": date(2023, 12, 31)}
NEW = {**SAME, "sr_id": 2, "start_date": SINCE, "created_date": datetime(2023, 6, 1)}


def _old_is_latest_at_dispense(row):
    """Make ``OLD`` the row in force at the dispense although ``row`` starts as early."""
    return {**OLD, "sr_id": row["sr_id"] + 1}


CASES = [
    ("NO RECENT DISPENSE FOUND", 2, False, [OLD, NEW]),
    ("NO CURRENT PRIMARY INSURANCE", 1, True, [OLD]),
    (
        "NO PRIMARY INSURANCE FOUND AT LAST DISPENSE",
        2,
        True,
        [{**NEW, "start_date": date(2024, 1, 1)}],
    ),
    ("PRIMARY PLAN CHANGED", 1, True, [OLD, {**NEW, "insurance_id": 6, "insurance_no": "x"}]),
    ("PRIMARY PLAN CHANGED", 1, True, [OLD, {**NEW, "insurance_id": None}]),
    ("SUBSCRIBER/INSURANCE NO CHANGED", 1, True, [OLD, {**NEW, "insurance_no": "x"}]),
    ("SUBSCRIBER/INSURANCE NO CHANGED", 1, True, [OLD, {**NEW, "insurance_no": None}]),
    ("MEMBER ID CHANGED", 1, True, [OLD, {**NEW, "membership_id": "x", "group_no": "x"}]),
    ("GROUP NO CHANGED", 1, True, [OLD, {**NEW, "group_no": "g"}]),
    (
        "CURRENT PRIMARY STARTS AFTER DISPENSE",
        1,
        True,
        [OLD, {**NEW, "start_date": DISPENSED + timedelta(days=1)}],
    ),
    (
        "CURRENT PRIMARY EDITED AFTER DISPENSE",
        2,
        True,
        [OLD, {**NEW, "changed_date": datetime(2023, 12, 1, 0, 0, 1)}],
    ),
    ("NO ALERT", 9, True, [OLD, {**NEW, "changed_date": datetime(2023, 12, 1)}]),
    ("NO ALERT", 9, True, [OLD, {**NEW, "start_date": DISPENSED}]),
    ("NO ALERT", 9, True, [OLD, {**NEW, "group_name": "other"}]),
    # NULL and the sentinel read alike.
    (
        "NO ALERT",
        9,
        True,
        [
            {**OLD, "insurance_id": None, "insurance_no": "", "group_no": None},
            {**NEW, "insurance_id": -1, "insurance_no": None, "group_no": ""},
        ],
    ),
]


def _tables(make, cases):
    """One patient per case; patient ids are the positions of the cases."""
    visits, insurance, headers, lines = [], [], [], []
    for patient, (_, _, dispensed, rows) in enumerate(cases):
        visits.append(
            {
                "tran_id": 100 + patient,
                "forwhom_id": patient,
                "procedure_id": 21,
                "schedule_date": TODAY,
                "schedule_time": "09:00:00",
                "office_id": 3,
                "status": "S",
            }
        )
        if len(rows) > 1:
            rows = [_old_is_latest_at_dispense(rows[1]) | _own(rows[0]), rows[1]]
        insurance += [{**row, "patient_id": patient} for row in rows]
        headers.append({"tran_id": patient, "patient_id": patient})
        if dispensed:
            lines.append(
                {
                    "tran_id": patient,
                    "sr_id": 1,
                    "billing_id": "XO150",
                    "service_date": DISPENSED,
                }
            )
    return {
        "schedule_detail": make("schedule_detail", *visits),
        "patient_insurance": make("patient_insurance", *insurance),
        "billing_header": make("billing_header", *headers),
        "billing_detail": make("billing_detail", *lines),
        "billing_master": make("billing_master", {"billing_id": "XO150", "descr": "d"}),
        "patient_master": make(
            "patient_master", {"id": 0, "patient_no": "P0", "lastname": "L", "firstname": None}
        ),
        "office_master": make("office_master", {"srno": 3, "office_code": "OFF"}),
        "insurance_plan_master": make(
            "insurance_plan_master", {"srno": 5, "name": "Plan5", "carrier_id": 1}
        ),
        "insurance_carrier_master": make("insurance_carrier_master", {"srno": 1, "name": "Car1"}),
    }


def _own(row):
    return {k: v for k, v in row.items() if k not in ("sr_id",)}


def test_every_rule(make, params):
    outcomes = appointment_outcomes(_tables(make, CASES), params)
    found = {r.patient_id: (r.alert_reason, r.alert_priority) for r in outcomes.collect()}
    assert found == {i: (reason, priority) for i, (reason, priority, _, _) in enumerate(CASES)}


def test_report_columns_names_and_order(make, params):
    report = alert_report(_tables(make, CASES), params)
    assert report.columns == REPORT_COLUMNS and len(REPORT_COLUMNS) == 31
    rows = order_report(report).collect()
    assert len(rows) == sum(reason != "NO ALERT" for reason, *_ in CASES)
    keys = [(r.alert_priority, r.biologic_drug, r.schedule_date) for r in rows]
    assert keys == sorted(keys)
    by_patient = {r.patient_id: r for r in rows}
    assert by_patient[0].patient_name == "L, " and by_patient[0].patient_no == "P0"
    assert by_patient[1].patient_name == ", " and by_patient[1].patient_no is None
    assert by_patient[3].office_code == "OFF"
    assert by_patient[3].current_plan_name is None
    assert by_patient[3].dispense_plan_name == "Plan5"
    assert by_patient[3].dispense_carrier_name == "Car1"
    assert by_patient[0].dispense_date is None


def test_every_appointment_has_one_outcome(make, params):
    outcomes = appointment_outcomes(_tables(make, CASES), params)
    assert outcomes.count() == len(CASES)
    summary = alert_summary(outcomes)
    assert sum(r.appointments for r in summary.collect()) == len(CASES)


def test_input_order_does_not_matter(make, params):
    tables = _tables(make, CASES)
    turned = {name: df.orderBy(*[df[c].desc() for c in df.columns]) for name, df in tables.items()}
    first = tuples(alert_report(tables, params), *REPORT_COLUMNS)
    assert first == tuples(alert_report(turned, params), *REPORT_COLUMNS)


def test_result_is_the_same_without_broadcasts(spark, make, params):
    tables = _tables(make, CASES)
    narrowed = tuples(alert_report(tables, params), *REPORT_COLUMNS)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert tuples(alert_report(tables, params), *REPORT_COLUMNS) == narrowed


def test_alert_text(make, params):
    text = alert_text(alert_report(_tables(make, CASES[3:4]), params)).first().alert_text
    assert text.split("\n") == [
        "Biologic PA check needed before administration.",
        "Reason: PRIMARY PLAN CHANGED",
        "Drug: XOLAIR",
        "Appointment: 2024-01-16 09:00:00 OFF",
        "Last dispense: 2023-12-01 XO150",
        "Current primary:  / M / group G",
        "Primary at dispense: Plan5 / M / group G",
    ]


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        (None, "NO CURRENT PRIMARY INSURANCE"),
        ({"insurance_id": 6}, "PRIMARY PLAN CHANGED"),
        ({"group_no": "x"}, "GROUP NO CHANGED"),
        ({"group_name": "x", "changed_date": datetime(2024, 1, 10)}, None),
    ],
)
def test_snapshot_drift(make, params, row, reason):
    rows = [OLD] if row is None else [OLD, {**NEW, **row}]
    tables = _tables(make, [("", 0, True, rows)])
    charges = dispense_charges(tables, params.rules, TODAY, 365)
    by_drug = last_dispense(charges, ["patient_id", "biologic_drug"])
    snapshot = coverage_snapshot(
        by_drug, primary_at_dispense(by_drug, tables["patient_insurance"])
    )
    assert len(snapshot.columns) == 15
    drifted = snapshot_drift(snapshot, current_primary(tables["patient_insurance"], TODAY))
    assert tuples(drifted, "alert_reason") == ([(reason,)] if reason else [])


SOURCE = (
    "patient_id bigint, biologic_drug string, source_event string, source_tran_id bigint, "
    "source_date date, event_ts timestamp_ntz, pa_status string, pa_expiration_date date"
)


def test_an_edit_in_place_is_found_through_the_stored_snapshot(spark, make, folder):
    coverage = {
        "patient_id": 1, "sr_id": 1, "priority": "P", "active": "Y", "insurance_id": 5,
        "insurance_no": "I1", "membership_id": "M1", "group_no": "G1",
    }
    before, edited = (make("patient_insurance", {**coverage, "membership_id": m}) for m in ("M1", "M2"))
    store = ReminderStore(spark, folder, buckets=2).create()

    def at(day):
        return datetime(2024, 1, day)

    def add(run, sources, insurance, closed=()):
        events = taken_events(spark.createDataFrame(sources, SOURCE), insurance)
        if closed:
            columns = "patient_id bigint, biologic_drug string, source_event string, source_tran_id bigint, "
            columns += "resolved_status string, resolved_by string, resolved_at timestamp_ntz"
            events = events.unionByName(resolution_events(spark.createDataFrame(closed, columns)))
        fresh = store.stage("fresh", run, lambda: new_events(events, store.read("coverage_event")))
        assert store.commit(run, store.version(), {"coverage_event": fresh})
        return fresh.count()

    dispense = (1, "XOLAIR", "DISPENSE", 7, at(10).date(), at(10), None, None)
    asked = (1, "FASENRA", "APPROVAL", 8, at(11).date(), at(11), "REQUESTED", None)
    granted = (1, "FASENRA", "APPROVAL", 8, at(11).date(), at(12), "APPROVED", date(2024, 7, 1))
    nobody = (2, "FASENRA", "APPROVAL", 9, at(11).date(), at(12), "APPROVED", None)
    assert add("r1", [dispense, dispense, asked, nobody], before) == 2
    # The rows have been edited since: what was taken stays, and only the approval's state is new.
    late = [("r", 1), ("DONE", 2)]
    resolved = [(1, "XOLAIR", "DISPENSE", 7, s, f"user{n}", at(13 + n)) for s, n in late]
    assert add("r2", [dispense, asked, granted], edited, [*resolved, (1, "XOLAIR", "DISPENSE", 99, "DONE", "x", at(9))]) == 4
    assert add("r3", [dispense, granted], edited, resolved) == 0
    columns = ("source_event", "membership_id", "pa_status", "pa_expiration_date", "resolved_status", "resolved_by", "resolved_at")
    assert tuples(store.snapshots(), *columns) == [
        ("APPROVAL", "M1", "APPROVED", date(2024, 7, 1), None, None, None),
        ("DISPENSE", "M1", None, None, "DONE", "user2", at(15)),
    ]
    now = current_primary(edited, TODAY)
    assert tuples(snapshot_drift(store.snapshots(), now), "biologic_drug", "alert_reason") == [
        ("FASENRA", "MEMBER ID CHANGED"), ("XOLAIR", "MEMBER ID CHANGED"),
    ]
    assert tuples(snapshot_drift(unresolved(store.snapshots()), now), "biologic_drug") == [("FASENRA",)]
    assert store.read("coverage_event", version=1).count() == 2
