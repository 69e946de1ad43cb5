from __future__ import annotations

import json

import pytest
from dataclasses import replace

from covdrift import Messages
from covdrift.operators.outbox import (
    capped_numbers,
    staff_outbox,
    shown_numbers,
    user_numbers,
    user_outbox,
    with_payload,
)
from covdrift.operators.users import patient_alerts, resolve_user, unattributed, user_alerts
from tests.conftest import tuples


@pytest.fixture
def alerts(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(employee, "u", number) for employee, number in rows],
            "employee_name string, audit_user string, patient_no string",
        )

    return build


@pytest.fixture
def numbers(spark):
    def build(*values):
        return spark.createDataFrame([(v,) for v in values], "patient_no string")

    return build


@pytest.fixture
def batch(spark):
    def build(rows):
        return spark.range(1, rows + 1).withColumnRenamed("id", "forwhom_id")

    return build


def test_resolve_user(spark, make):
    employees = make(
        "emp_master",
        {"empid": 1, "user_name": "ALee", "firstname": "Ann", "lastname": "Lee"},
        {"empid": 2, "user_name": None, "firstname": "Bo", "lastname": "Ray"},
        {"empid": 3, "user_name": "blank", "firstname": None, "lastname": ""},
        {"empid": 4, "user_name": "solo", "firstname": "Cy", "lastname": None},
        {"empid": 5, "user_name": "shared", "firstname": "D", "lastname": "One"},
        {"empid": 6, "user_name": "SHARED", "firstname": "D", "lastname": "Two"},
        {"empid": None, "user_name": "ghost", "firstname": "No", "lastname": "Id"},
        # Found by login and by name at once: still one row.
        {"empid": 7, "user_name": "eve poe", "firstname": "Eve", "lastname": "Poe"},
    )
    names = ["alee", "ANN LEE", "bo ray", "blank", "solo", "shared", "ghost", "none", "Eve Poe"]
    users = spark.createDataFrame(
        list(enumerate(names)), "patient_id bigint, audit_user string"
    )
    assert tuples(resolve_user(users, employees), "audit_user", "employee_name") == sorted(
        [
            ("alee", "Ann Lee"),
            ("ANN LEE", "Ann Lee"),
            ("bo ray", "Bo Ray"),
            ("blank", "blank"),
            ("solo", "Cy "),
            ("shared", "D One"),
            ("shared", "D Two"),
            ("ghost", "ghost"),
            ("none", "none"),
            ("Eve Poe", "Eve Poe"),
        ]
    )


def test_alert_targets(spark, make):
    patients = make(
        "patient_master",
        {"id": 1, "patient_no": "N1"},
        {"id": 2, "patient_no": ""},
        {"id": 3, "patient_no": None},
    )
    batch = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,)], "forwhom_id bigint")
    assert tuples(patient_alerts(batch, patients), "patient_no") == [("N1",)]
    resolved = spark.createDataFrame(
        [(1, "u", "E"), (1, "u", "E"), (2, "u", "E"), (4, "v", "F"), (4, "w", "")],
        "patient_id bigint, audit_user string, employee_name string",
    )
    assert tuples(
        user_alerts(resolved, patients), "employee_name", "audit_user", "patient_no"
    ) == [("E", "u", ""), ("E", "u", "N1"), ("F", "v", "")]
    assert tuples(unattributed(batch, resolved), "unattributed_reminders") == [(1,)]


def test_numbers_are_merged_by_case_and_spacing(alerts):
    rows = alerts(
        (" E ", "a  1"), ("E", "A 1 "), ("E", " A\t1"), ("E", " B2"), ("E", ""), ("E", None)
    )
    assert tuples(user_numbers(rows), "employee", "patient_no") == sorted(
        [("E", "A 1"), ("E", "B2"), ("E", None)], key=repr
    )
    found = shown_numbers(user_numbers(rows), 8).collect()
    assert [(r.employee, r.n_numbers, r.numbers) for r in found] == [("E", 2, ["A 1", "B2"])]


def test_all_numbers_of_an_employee_are_rows(alerts):
    rows = alerts(*[("E", f"P{i:03}") for i in range(40)])
    assert tuples(user_numbers(rows), "patient_no") == [(f"P{i:03}",) for i in range(40)]


@pytest.mark.parametrize(
    ("count", "text"),
    [
        (0, ""),
        (1, "P1"),
        (8, "P1, P2, P3, P4, P5, P6, P7, P8"),
        (9, "P1, P2, P3, P4, P5, P6, P7, P8 +1 more"),
    ],
)
def test_capped_list(alerts, count, text):
    rows = alerts(("E", ""), *[("E", f"P{i + 1}") for i in range(count)])
    assert tuples(capped_numbers(shown_numbers(user_numbers(rows), 8)), "employee", "numbers_text") == [
        ("E", text)
    ]


def test_user_notices(alerts, params):
    rows = alerts(("E", "P1"), ("F", ""), ("  ", "P9"), ("", "P9"))
    found = user_outbox(shown_numbers(user_numbers(rows), 8), params)
    assert tuples(found, "employees", "marker_prefix", "source") == [
        (["E"], "bio_auth:202401161200:user", "BIO_INS_CHANGE_PA"),
        (["F"], "bio_auth:202401161200:user", "BIO_INS_CHANGE_PA"),
    ]
    messages = {r.employees[0]: r.message for r in found.collect()}
    assert messages["E"].startswith(
        "You changed insurance for patient_no P1, who receives a buy-and-bill biologic. It is "
    )
    assert messages["F"] == params.messages.user_default


@pytest.mark.parametrize(
    ("new", "shown", "start"),
    [
        (1, ["P1"], "New biologic insurance/auth alert created in S for patient_no P1. Check"),
        (1, [], "New biologic insurance/auth alert created in S. Check"),
        (3, ["P2", "P1"], "3 new biologic insurance/auth alerts created in S for patient_no P1, P2."),
        (3, [], "3 new biologic insurance/auth alerts created in S. Check"),
        (0, [], None),
    ],
)
def test_staff_notice(numbers, batch, params, new, shown, start):
    named = replace(params, messages=Messages(system="S", staff_team=" A ;; B|C "))
    found = staff_outbox(numbers(*shown), batch(new), named).collect()
    if start is None:
        assert found == []
        return
    (notice,) = found
    assert notice.employees == ["A", "B", "C"]
    assert notice.message.startswith(start)


def test_long_staff_list_is_capped(numbers, batch, params):
    many = numbers(*[f"P{i:03}" for i in range(40)], "p000")
    (notice,) = staff_outbox(many, batch(41), params).collect()
    assert "P006, P007 +32 more." in notice.message


def test_no_team_no_staff_notice(numbers, batch, params):
    nobody = replace(params, messages=Messages(staff_team=" ; | "))
    assert staff_outbox(numbers("P1"), batch(1), nobody).count() == 0


def test_payload(alerts, params):
    listed = shown_numbers(user_numbers(alerts(("E", "P1"))), 8)
    (row,) = with_payload(user_outbox(listed, params)).collect()
    assert json.loads(row.payload) == {
        "employees": ["E"],
        "message": row.message,
        "marker_prefix": "bio_auth:202401161200:user",
        "source": "BIO_INS_CHANGE_PA",
    }
