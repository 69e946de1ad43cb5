from __future__ import annotations

from datetime import date, timedelta

import pytest

from covdrift.operators.charges import classify, dispense_charges, last_dispense
from covdrift.params import DEFAULT_RULES
from tests.conftest import TODAY, tuples


@pytest.mark.parametrize(
    ("code", "descr", "drug"),
    [
        ("XO150", None, "XOLAIR"),
        ("xo300", "", "XOLAIR"),
        ("disfa", "anything", "FASENRA"),
        ("TEZ", None, "TEZSPIRE"),
        ("A1", "Xolair dispense 150", "XOLAIR"),
        ("A2", "disp fasenra pen", "FASENRA"),
        ("A3", "Tezspire (DISPENSED)", "TEZSPIRE"),
        ("A4", "Xolair injection", None),
        ("A5", "dispensing fee", None),
        ("A6", None, None),
        # The first rule wins, whether by code or by text.
        ("A7", "disp tezspire or xolair", "XOLAIR"),
        ("FAS30", "xolair disp", "XOLAIR"),
        ("TEZ", "fasenra disp", "FASENRA"),
    ],
)
def test_classify(make, code, descr, drug):
    master = make("billing_master", {"billing_id": code, "descr": descr})
    found = classify(master, "billing_id", "descr", DEFAULT_RULES)
    assert tuples(found, "biologic_drug") == ([(drug,)] if drug else [])


def _tables(make, lines, headers=({"tran_id": 1, "patient_id": 7},)):
    return {
        "billing_detail": make("billing_detail", *lines),
        "billing_header": make("billing_header", *headers),
        "billing_master": make(
            "billing_master",
            {"billing_id": "XO150", "descr": "x"},
            {"billing_id": "TEZ", "descr": "t"},
            {"billing_id": "ZZ", "descr": "other"},
        ),
    }


def _line(day, tran=1, sr=1, code="XO150"):
    return {"tran_id": tran, "sr_id": sr, "billing_id": code, "service_date": day}


def test_lookback_is_inclusive_and_open_above(make):
    bound = TODAY - timedelta(days=45)
    lines = [
        _line(bound, sr=1),
        _line(bound - timedelta(days=1), sr=2),
        _line(TODAY + timedelta(days=400), sr=3),
        _line(None, sr=4),
        _line(TODAY, sr=5, code="ZZ"),
    ]
    charges = dispense_charges(_tables(make, lines), DEFAULT_RULES, TODAY, 45)
    assert tuples(charges, "dispense_sr_id", "patient_id", "dispense_code") == [
        (1, 7, "XO150"),
        (3, 7, "XO150"),
    ]


def test_charges_need_a_patient(make):
    headers = ({"tran_id": 1, "patient_id": None}, {"tran_id": 2, "patient_id": 9})
    lines = [_line(TODAY, tran=1), _line(TODAY, tran=2), _line(TODAY, tran=3)]
    charges = dispense_charges(_tables(make, lines, headers), DEFAULT_RULES, TODAY, 45)
    assert tuples(charges, "patient_id") == [(9,)]


def test_patient_restriction_changes_nothing_for_those_patients(make, spark):
    headers = ({"tran_id": 1, "patient_id": 7}, {"tran_id": 2, "patient_id": 9})
    tables = _tables(make, [_line(TODAY, tran=1), _line(TODAY, tran=2)], headers)
    only = spark.createDataFrame([(9,)], "patient_id bigint")
    charges = dispense_charges(tables, DEFAULT_RULES, TODAY, 45, only)
    assert tuples(charges, "patient_id", "dispense_tran_id") == [(9, 2)]


def test_last_dispense_tie_breaks(make):
    older = date(2024, 1, 1)
    headers = tuple({"tran_id": t, "patient_id": p} for t, p in [(1, 7), (2, 7), (3, 8)])
    lines = [
        _line(older, tran=2, sr=9),
        _line(TODAY, tran=1, sr=1),
        _line(TODAY, tran=1, sr=2),
        _line(TODAY, tran=1, sr=3, code="TEZ"),
        _line(TODAY, tran=3, sr=1, code="TEZ"),
    ]
    charges = dispense_charges(_tables(make, lines, headers), DEFAULT_RULES, TODAY, 45)
    by_drug = last_dispense(charges, ["patient_id", "biologic_drug"])
    assert tuples(by_drug, "patient_id", "biologic_drug", "dispense_sr_id") == [
        (7, "TEZSPIRE", 3),
        (7, "XOLAIR", 2),
        (8, "TEZSPIRE", 1),
    ]
    by_patient = last_dispense(charges, ["patient_id"])
    assert tuples(by_patient, "patient_id", "dispense_tran_id", "dispense_sr_id") == [
        (7, 1, 3),
        (8, 3, 1),
    ]


def test_higher_transaction_wins_on_one_day(make):
    headers = tuple({"tran_id": t, "patient_id": 7} for t in (1, 2))
    lines = [_line(TODAY, tran=1, sr=9), _line(TODAY, tran=2, sr=1)]
    charges = dispense_charges(_tables(make, lines, headers), DEFAULT_RULES, TODAY, 45)
    assert tuples(last_dispense(charges, ["patient_id"]), "dispense_tran_id") == [(2,)]
