from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from covdrift.operators.schedule import next_appointment, open_appointments
from tests.conftest import TODAY, tuples


def _visit(tran, **values):
    return {
        "tran_id": tran,
        "forwhom_id": 1,
        "procedure_id": 21,
        "schedule_date": TODAY,
        "schedule_time": "09:00:00",
        **values,
    }


def _next(make, params, *rows):
    return next_appointment(
        open_appointments(
            make("schedule_detail", *rows), TODAY, params.horizon_days, params.procedure_drugs
        )
    )


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({}, True),
        ({"schedule_date": TODAY + timedelta(days=14)}, True),
        ({"schedule_date": TODAY + timedelta(days=15)}, False),
        ({"schedule_date": TODAY - timedelta(days=1)}, False),
        ({"canceled_date": datetime(2024, 1, 1)}, False),
        ({"forwhom_id": None}, False),
        ({"procedure_id": 51}, False),
        ({"procedure_id": None}, False),
    ],
)
def test_which_appointments_count(make, params, values, kept):
    assert _next(make, params, _visit(1, **values)).count() == int(kept)


def test_soonest_per_procedure(make, params):
    rows = [
        _visit(1, schedule_date=TODAY + timedelta(days=1), schedule_time="08:00:00"),
        _visit(2, schedule_time="10:00:00"),
        _visit(3, schedule_time="09:30:00"),
        _visit(4, procedure_id=55),
        _visit(6, forwhom_id=2),
        _visit(5, forwhom_id=2),
        _visit(7, forwhom_id=2, schedule_time=None),
    ]
    found = _next(make, params, *rows)
    assert tuples(found, "patient_id", "biologic_drug", "schedule_tran_id") == [
        (1, "TEZSPIRE", 4),
        (1, "XOLAIR", 3),
        (2, "XOLAIR", 7),
    ]
    without_null_time = _next(make, params, *rows[:-1])
    assert (2, "XOLAIR", 5) in tuples(
        without_null_time, "patient_id", "biologic_drug", "schedule_tran_id"
    )
