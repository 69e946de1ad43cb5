from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from covdrift.operators.coverage import (
    change_after_dispense,
    current_primary,
    in_force_at,
    primary_at_dispense,
    recent_primary_change,
    recent_primary_edits,
)
from tests.conftest import NOW, TODAY, tuples

DAY = timedelta(days=1)


def _row(sr, **values):
    return {"patient_id": 1, "sr_id": sr, "priority": "P", **values}


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({"active": None}, True),
        ({"active": "Y"}, True),
        ({"active": "N"}, False),
        ({"active": "y"}, False),
        ({"priority": "S"}, False),
        ({"priority": None}, False),
        ({"end_date": TODAY}, True),
        ({"end_date": TODAY - DAY}, False),
        ({"start_date": TODAY}, True),
        ({"start_date": TODAY + DAY}, False),
        ({"start_date": None, "end_date": None}, True),
    ],
)
def test_current_primary_filter(make, values, kept):
    rows = make("patient_insurance", _row(1, **values))
    assert current_primary(rows, TODAY).count() == int(kept)


def test_current_primary_takes_the_last_edit(make):
    rows = make(
        "patient_insurance",
        _row(1, changed_date=datetime(2024, 1, 2), created_date=datetime(2020, 1, 1)),
        _row(2, created_date=datetime(2024, 1, 1)),
        _row(3, start_date=date(2023, 1, 1)),
        _row(9),
    )
    assert tuples(current_primary(rows, TODAY), "sr_id") == [(1,)]
    only_undated = make("patient_insurance", _row(4), _row(5))
    assert tuples(current_primary(only_undated, TODAY), "sr_id") == [(5,)]
    start_counts = make("patient_insurance", _row(3, start_date=date(2023, 1, 1)), _row(9))
    assert tuples(current_primary(start_counts, TODAY), "sr_id") == [(3,)]


def _dispensed(spark, day, patient=1, drug="XOLAIR"):
    return spark.createDataFrame(
        [(patient, drug, day, 5)],
        "patient_id bigint, biologic_drug string, dispense_date date, dispense_tran_id bigint",
    )


def test_primary_at_dispense(make, spark):
    day = date(2023, 12, 1)
    rows = make(
        "patient_insurance",
        _row(1, start_date=None, active="N"),
        _row(2, start_date=date(2023, 1, 1), end_date=day, active="N"),
        _row(3, start_date=day + DAY),
        _row(4, start_date=date(2023, 6, 1), end_date=day - DAY),
        _row(5, start_date=date(2023, 11, 1), priority="S"),
    )
    found = primary_at_dispense(_dispensed(spark, day), rows)
    assert tuples(found, "patient_id", "biologic_drug", "sr_id") == [(1, "XOLAIR", 2)]
    bounded = primary_at_dispense(_dispensed(spark, day), rows, oldest=day)
    assert tuples(bounded, "sr_id") == [(2,)]
    undated = primary_at_dispense(_dispensed(spark, day), rows.where("sr_id in (1, 3)"))
    assert tuples(undated, "sr_id") == [(1,)]
    starts_that_day = make("patient_insurance", _row(6, start_date=day), _row(7, start_date=day))
    assert tuples(primary_at_dispense(_dispensed(spark, day), starts_that_day), "sr_id") == [(7,)]


def test_primary_at_dispense_per_drug(make, spark):
    dispensed = _dispensed(spark, date(2023, 12, 1)).union(
        _dispensed(spark, date(2023, 6, 1), drug="TEZSPIRE")
    )
    rows = make(
        "patient_insurance",
        _row(1, start_date=date(2023, 1, 1)),
        _row(2, start_date=date(2023, 9, 1)),
    )
    assert tuples(primary_at_dispense(dispensed, rows), "biologic_drug", "sr_id") == [
        ("TEZSPIRE", 1),
        ("XOLAIR", 2),
    ]


def test_recent_change_bounds(make):
    bound = NOW - timedelta(days=3)
    rows = make(
        "patient_insurance",
        {**_row(1, changed_date=bound), "patient_id": 1},
        {**_row(1, changed_date=bound - timedelta(microseconds=1)), "patient_id": 2},
        {**_row(1, created_date=bound, active="N"), "patient_id": 3},
        # The change time hides the creation time.
        {**_row(1, changed_date=datetime(2023, 1, 1), created_date=NOW), "patient_id": 4},
        {**_row(1, priority="S", changed_date=NOW), "patient_id": 5},
        {**_row(1), "patient_id": 6},
    )
    found = recent_primary_change(recent_primary_edits(rows, NOW, 3))
    assert tuples(found, "patient_id", "insurance_change_ts") == [(1, bound), (3, bound)]


def _change(make, *rows):
    edits = recent_primary_edits(make("patient_insurance", *rows), NOW, 3)
    return recent_primary_change(edits)


@pytest.mark.parametrize(
    ("rows", "due"),
    [
        # Started on the dispense day, changed after it.
        ([_row(1, changed_date=NOW, start_date=date(2024, 1, 14))], True),
        # Created on the dispense day at midnight.
        ([_row(1, created_date=datetime(2024, 1, 14))], True),
        # An inactive row counts.
        ([_row(1, created_date=NOW, active="N")], True),
        # An edit of an older row is no change.
        ([_row(1, changed_date=NOW, start_date=date(2024, 1, 13))], False),
        (
            [_row(1, changed_date=NOW, start_date=date(2020, 1, 1), created_date=datetime(2020, 1, 1))],
            False,
        ),
        # Changed before the dispense.
        ([_row(1, changed_date=datetime(2024, 1, 13, 23, 59), start_date=TODAY)], False),
        # The newest change fails, so an older one that would pass does not count.
        (
            [
                _row(1, created_date=datetime(2024, 1, 15), start_date=date(2024, 1, 15)),
                _row(2, changed_date=NOW, created_date=datetime(2020, 1, 1)),
            ],
            False,
        ),
    ],
)
def test_change_after_dispense(make, spark, rows, due):
    dispensed = _dispensed(spark, date(2024, 1, 14))
    assert change_after_dispense(dispensed, _change(make, *rows)).count() == int(due)


@pytest.mark.parametrize("span", [0, 1, 2, 6, 7, 300])
def test_in_force_at_matches_all_pairs(spark, make, span):
    rng = random.Random(span)
    first = date(2023, 12, 28)

    def day(spread):
        return None if rng.random() < 0.2 else first + DAY * rng.randrange(-spread, span + spread + 1)

    rows = [
        {
            "patient_id": rng.choice([1, 1, 2, 3, None]), "sr_id": sr, "priority": rng.choice("PPPS"),
            "start_date": day(9), "end_date": day(9),
        }
        for sr in range(120)
    ]
    rows.append({"patient_id": 4, "sr_id": None, "priority": "P"})
    events = [(p, first + DAY * d) for p in (1, 2, 4, 5) for d in range(span + 1) if rng.random() < 0.6 or d in (0, span)]
    events += [(None, first), (1, None), events[0]]
    want = set()
    for patient, at in events:
        fit = [
            (r["start_date"] or date(1900, 1, 1), r["sr_id"] or 0)
            for r in rows[: -1 if patient != 4 else None]
            if patient is not None and at is not None and r["patient_id"] == patient and r["priority"] == "P"
            and (r.get("start_date") or at) <= at <= (r.get("end_date") or at)
        ] if patient != 4 else [(date(1900, 1, 1), 0)]
        if fit:
            want.add((patient, at, max(fit)[1]))
    frame = spark.createDataFrame(events, "patient_id bigint, event_date date")
    found = in_force_at(frame, make("patient_insurance", *rows)).select(
        "patient_id", "event_date", F.coalesce("sr_id", F.lit(0)).alias("sr_id")
    )
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_in_force_at_of_nothing(spark, make):
    none = spark.createDataFrame([], "patient_id bigint, event_date date")
    assert in_force_at(none, make("patient_insurance", _row(1))).count() == 0
    some = spark.createDataFrame([(1, TODAY)], "patient_id bigint, event_date date")
    assert in_force_at(some, make("patient_insurance")).count() == 0


def test_one_patient_with_very_many_rows_and_events_is_not_paired(spark, folder):
    """100,000 rows and as many events of one patient: 10 thousand million pairs, were they formed."""
    n, days = 100_000, 3000
    origin = F.lit(date(2015, 1, 1))
    start = (F.col("id") * 7919 % days).cast("int")
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("patient_id"), F.col("id").alias("sr_id"), F.lit("P").alias("priority"),
        F.date_add(origin, start).alias("start_date"),
        F.date_add(origin, start + (F.col("id") % 50).cast("int")).alias("end_date"),
    )
    events = spark.range(n).select(
        F.lit(1).cast("long").alias("patient_id"), F.date_add(origin, (F.col("id") % days).cast("int")).alias("event_date")
    )
    rows.write.parquet(f"{folder}/rows")
    events.write.parquet(f"{folder}/events")
    rows, events = (spark.read.parquet(f"{folder}/{name}") for name in ("rows", "events"))
    found = events.join(in_force_at(events, rows), ["patient_id", "event_date"])
    text = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    got = {r.event_date: r.sr_id for r in found.select("event_date", "sr_id").distinct().collect()}
    assert found.count() == n and len(got) == days
    best = {}
    for i in range(n):
        at, length = i * 7919 % days, i % 50
        for day in range(at, min(days, at + length + 1)):
            best[day] = max(best.get(day, (-1, -1)), (at, i))
    assert got == {date(2015, 1, 1) + DAY * d: i for d, (_, i) in best.items()}


def _joins(df):
    """Join operators of the executed plan that take ``event_date`` or a block of days as a key or a column."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text, [line for line in text.splitlines() if "Join" in line]


@pytest.mark.parametrize("n", [5, 500])
def test_days_are_never_broadcast(spark, make, n):
    """A small file of days is large in memory: each stood in the driver once per block size."""
    days = [(p, date(2020, 1, 1) + DAY * d) for p in range(3) for d in range(0, 2000, 100)]
    events = spark.createDataFrame(days, "patient_id bigint, event_date date")
    rows = make("patient_insurance", *[
        {"patient_id": p, "sr_id": i, "priority": "P", "start_date": date(2020, 1, 1) + DAY * (i * 7 % 2000)}
        for p in range(3) for i in range(n)
    ])
    text, joins = _joins(in_force_at(events, rows))
    # Only the keys of patients may be sent to all executors.
    assert joins and all("LeftSemi" in line or "LeftAnti" in line for line in joins if "Broadcast" in line), joins
    assert any("SortMergeJoin" in line for line in joins)


def test_rows_of_ordinary_patients_are_not_copied_into_blocks(spark, make):
    """Each row stood in some eight blocks, with all its columns, where its patient's days look through a list."""
    events = spark.createDataFrame([(1, date(2020, 1, 1)), (1, date(2024, 1, 1))], "patient_id bigint, event_date date")
    rows = make("patient_insurance", *[_row(i, start_date=date(2020, 1, 1 + i)) for i in range(20)])
    text, _ = _joins(in_force_at(events, rows))
    assert "explode" not in text and "collect_list" in text


@pytest.mark.parametrize("n", [63, 64, 65])
def test_listed_and_crowded_patients_get_the_same_row(spark, make, n):
    """Rows of one start and id differ in other columns only: the greatest wins, listed or in blocks."""
    rows = [
        _row(i // 2, membership_id=f"M{i * 37 % 100:02}", start_date=date(2024, 1, 1), end_date=TODAY if i % 3 else None)
        for i in range(n)
    ]
    events = spark.createDataFrame([(1, TODAY), (1, TODAY + DAY)], "patient_id bigint, event_date date")
    found = in_force_at(events, make("patient_insurance", *rows)).select("event_date", "sr_id", "membership_id")
    want = []
    for at in (TODAY, TODAY + DAY):
        fit = [(r["sr_id"], r["membership_id"]) for r in rows if (r["end_date"] or at) >= at]
        want.append((at, *max(fit)))
    assert sorted(map(tuple, found.collect())) == want
