from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from covdrift.operators.attribution import (
    WORDS,
    _gram_bins,
    attribute,
    audit_trail_source,
    edit_log_source,
    match_logs,
)
from covdrift.params import SYSTEM_USERS
from tests.conftest import settings, tuples

AT = datetime(2024, 1, 16, 9, 59, 59, 999_999)
TEN = timedelta(minutes=10)
TICK = timedelta(microseconds=1)


@pytest.fixture
def changes(spark):
    def build(*rows):
        return spark.createDataFrame(
            [
                (
                    r.get("patient_id", 7),
                    r.get("insurance_sr_id", 31),
                    r.get("membership_id"),
                    r.get("insurance_no"),
                    r.get("at", AT),
                )
                for r in rows
            ],
            "patient_id bigint, insurance_sr_id bigint, membership_id string, "
            "insurance_no string, insurance_change_ts timestamp_ntz",
        )

    return build


def _edit(make, *rows):
    return edit_log_source(
        make("edit_log_header", *[{"modified_by": "ann", "modified_date": AT, **r} for r in rows]),
        SYSTEM_USERS,
    )


def _trail(make, *rows):
    return audit_trail_source(
        make("audit_trail", *[{"user_name": "bob", "tran_date": AT, **r} for r in rows]),
        SYSTEM_USERS,
    )


def _users(found):
    return tuples(found, "audit_user")


# Each case gets its own change, days apart: patient {pid}, row {sr}, numbers MEM1 and INS%9.
EDIT_CASES = [
    ({"PK_1": "{pid}"}, True),
    ({"PK_2": "{sr}"}, True),
    ({"pk_3": "{pid}"}, True),
    ({"PK_1": "{pid}7"}, False),
    ({"PK_1": " {pid}"}, False),
    ({"old_values": "{pid} {sr}"}, False),
    ({"old_values": "id=MEM1;"}, True),
    ({"new_values": "MEM1"}, True),
    ({"column_detail": "xMEM1x"}, True),
    ({"new_values": "mem1"}, False),
    ({"new_values": "MEM"}, False),
    ({"column_detail": "a INS%9 b"}, True),
    # Only the literal text counts, not a pattern.
    ({"column_detail": "a INSx9 b"}, False),
    ({"old_values": "back\\slash MEM1 \n next"}, True),
    ({"old_values": "\U0001f600MEM1\U0001f600"}, True),
    ({}, False),
    ({"PK_1": "{pid}", "modified_by": None}, False),
    *[({"PK_1": "{pid}", "modified_by": u}, False) for u in SYSTEM_USERS],
    ({"PK_1": "{pid}", "modified_by": "System"}, True),
    ({"PK_1": "{pid}", "modified_date": TEN}, True),
    ({"PK_1": "{pid}", "modified_date": -TEN}, True),
    ({"PK_1": "{pid}", "modified_date": TEN + TICK}, False),
    ({"PK_1": "{pid}", "modified_date": -TEN - TICK}, False),
]
TRAIL_CASES = [
    ({"sql_syntax": "update patient_insurance set x"}, True),
    ({"sql_syntax": "update patient set id = 1{pid}0"}, True),
    ({"sql_syntax": "update t set id = {sr}"}, False),
    ({"sql_syntax": "x MEM1"}, True),
    ({"sql_syntax": "x" * 5000 + "MEM1"}, True),
    ({"sql_syntax": None}, False),
    ({"sql_syntax": ""}, False),
    ({"sql_syntax": "x MEM1", "tran_date": TEN}, True),
    ({"sql_syntax": "x MEM1", "tran_date": TEN + TICK}, False),
]


def _run_cases(changes, cases, at_column, source):
    change_rows, log_rows = [], []
    for i, (row, _) in enumerate(cases):
        pid, sr, at = 7000 + i, 31000 + i, AT + timedelta(days=i)
        change_rows.append(
            {
                "patient_id": pid,
                "insurance_sr_id": sr,
                "membership_id": "MEM1",
                "insurance_no": "INS%9",
                "at": at,
            }
        )
        filled = {
            k: v.format(pid=pid, sr=sr) if isinstance(v, str) else v for k, v in row.items()
        }
        log_rows.append({**filled, at_column: at + row.get(at_column, timedelta(0))})
    found = match_logs(changes(*change_rows), [source(log_rows)], 10)
    hits = {r.patient_id - 7000 for r in found.collect()}
    assert hits == {i for i, (_, hit) in enumerate(cases) if hit}


def test_edit_log_matches(make, changes):
    _run_cases(changes, EDIT_CASES, "modified_date", lambda rows: _edit(make, *rows))


def test_audit_trail_matches(make, changes):
    _run_cases(changes, TRAIL_CASES, "tran_date", lambda rows: _trail(make, *rows))


def test_half_a_surrogate_pair_is_no_text(make, changes):
    change = changes({"membership_id": "?bc", "insurance_no": "\U0001f600b"})
    only_first = [_edit(make, {"old_values": "a\U0001f601bc"})]
    assert match_logs(change, only_first, 10).count() == 0
    assert match_logs(change, [_edit(make, {"old_values": "a\U0001f600bc"})], 10).count() == 1


def test_blank_numbers_never_match(make, changes):
    change = changes({"membership_id": "", "insurance_no": ""}, {"patient_id": 8})
    assert match_logs(change, [_edit(make, {"old_values": "any text"})], 10).count() == 0


def test_logs_do_not_share_keys(make, changes):
    """A patient id inside a logged value counts in the trail only."""
    sources = [_edit(make, {"old_values": "7"}), _trail(make, {"sql_syntax": "none"})]
    assert match_logs(changes({}), sources, 10).count() == 0


def test_table_name_ties_to_every_change_near_it(make, changes):
    change = changes({"patient_id": 7}, {"patient_id": 8}, {"patient_id": 9, "at": AT + 3 * TEN})
    found = attribute(change, [_trail(make, {"sql_syntax": "patient_insurance"})])
    assert tuples(found, "patient_id") == [(7,), (8,)]


def test_newest_entry_wins_and_then_the_highest_user(make, changes):
    rows = [
        {"PK_1": "7", "modified_by": "old", "modified_date": AT - TEN},
        {"PK_1": "7", "modified_by": "late", "modified_date": AT + TICK},
        {"PK_1": "7", "modified_by": "zoe", "modified_date": AT + TEN + TICK},
    ]
    assert _users(attribute(changes({}), [_edit(make, *rows)])) == [("late",)]
    rows[0]["modified_date"] = AT + TICK
    assert _users(attribute(changes({}), [_edit(make, *rows)])) == [("old",)]
    both = [_edit(make, *rows), _trail(make, {"sql_syntax": "7", "tran_date": AT + 2 * TICK})]
    assert _users(attribute(changes({}), both)) == [("bob",)]
    per_log = match_logs(changes({}), both, 10)
    assert tuples(per_log, "log", "audit_user") == [("audit_trail", "bob"), ("edit_log", "old")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(make, changes, seed):
    """Dense random logs, one moment and one key far more common than the rest."""
    rng = random.Random(seed)
    hot = AT - timedelta(seconds=3)

    def moment():
        if rng.random() < 0.35:
            return hot
        return AT + timedelta(microseconds=rng.randrange(-(10**9) * 3, 10**9 * 3))

    change_rows = [
        {
            "patient_id": rng.randrange(40),
            "insurance_sr_id": 1000 + i,
            "membership_id": rng.choice([None, "", "A1", f"B{rng.randrange(5)}", "LONG-77"]),
            "insurance_no": rng.choice([None, "", "Z", "ZZ9"]),
            "at": moment(),
        }
        for i in range(60)
    ]
    text = lambda: rng.choice([None, "", "A1 B3", "zLONG-77", "Z", "xZZ9", "B", "12 3"])
    edits = [
        {
            "PK_1": str(rng.randrange(40)) if rng.random() < 0.2 else None,
            "pk_3": str(1000 + rng.randrange(60)) if rng.random() < 0.2 else None,
            "old_values": text(),
            "column_detail": text(),
            "modified_by": rng.choice(["ann", "bea", "system", ""]),
            "modified_date": moment(),
        }
        for _ in range(150)
    ]
    trail = [
        {
            "user_name": rng.choice(["cal", "dan", None]),
            "tran_date": moment(),
            "sql_syntax": rng.choice([text(), "patient_insurance", "no 5"]),
        }
        for _ in range(80)
    ]
    expected = {}
    for c in change_rows:
        pid, sr = str(c["patient_id"]), str(c["insurance_sr_id"])
        numbers = [v for v in (c["membership_id"], c["insurance_no"]) if v]
        best = []
        for e in edits:
            texts = [e["old_values"] or "", e["column_detail"] or ""]
            hit = {pid, sr} & {e["PK_1"], e["pk_3"]} or any(n in t for n in numbers for t in texts)
            if hit and e["modified_by"] not in SYSTEM_USERS and abs(e["modified_date"] - c["at"]) <= TEN:
                best.append((e["modified_date"], e["modified_by"]))
        for a in trail:
            sql = a["sql_syntax"] or ""
            hit = "patient_insurance" in sql or any(n in sql for n in [pid, *numbers])
            if hit and a["user_name"] and abs(a["tran_date"] - c["at"]) <= TEN:
                best.append((a["tran_date"], a["user_name"]))
        if best:
            expected[c["insurance_sr_id"]] = max(best)
    assert len(expected) > 20
    found = attribute(changes(*change_rows), [_edit(make, *edits), _trail(make, *trail)])
    assert {
        r.insurance_sr_id: (r.audit_ts, r.audit_user) for r in found.collect()
    } == expected


def test_everything_in_one_window(spark, make):
    """20,000 changes and 20,000 log rows within five minutes: pairing them would be 400 million."""
    moment = "timestamp_ntz'2024-01-16 10:00:00' + make_dt_interval(0, 0, 0, id / 100)"
    rows = spark.range(0, 20_000, 1, 4)
    change = rows.selectExpr(
        "id as patient_id",
        "id as insurance_sr_id",
        "'MEM' as membership_id",
        "cast(null as string) as insurance_no",
        f"{moment} as insurance_change_ts",
    )
    trail = rows.selectExpr(
        "concat('u', id) as user_name",
        f"{moment} as tran_date",
        "if(id % 2 = 0, 'update patient_insurance set MEM', 'MEM') as sql_syntax",
    )
    edits = rows.selectExpr(
        *[f"cast(null as string) as {c}" for c in ("PK_1", "PK_2", "pk_3", "new_values")],
        "'x MEM x' as old_values",
        "cast(null as string) as column_detail",
        "concat('e', id) as modified_by",
        f"{moment} as modified_date",
    ).where("id < 15000")
    sources = [edit_log_source(edits, SYSTEM_USERS), audit_trail_source(trail, SYSTEM_USERS)]
    found = match_logs(change, sources, 10).groupBy("log", "audit_user").count()
    assert tuples(found, "log", "audit_user", "count") == [
        ("audit_trail", "u19999", 20_000),
        ("edit_log", "e14999", 20_000),
    ]


def test_same_rows_without_broadcasts(spark, make, changes):
    change = changes({"membership_id": "MEM1"}, {"patient_id": 8, "membership_id": "X9"})
    sources = [
        _edit(make, {"PK_1": "7"}, {"new_values": "aX9b", "modified_by": "bea"}),
        _trail(make, {"sql_syntax": "MEM1"}),
    ]
    columns = ("patient_id", "log", "audit_user", "audit_ts")
    broadcast = tuples(match_logs(change, sources, 10), *columns)
    assert len(broadcast) == 3
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert tuples(match_logs(change, sources, 10), *columns) == broadcast


def test_changes_of_one_instant_without_broadcasts(spark, make, changes):
    change = changes(*[{"patient_id": i, "insurance_sr_id": i} for i in range(3000)])
    trail = make(
        "audit_trail",
        {"user_name": "bob", "tran_date": AT, "sql_syntax": "update patient_insurance"},
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        found = match_logs(change, [audit_trail_source(trail, SYSTEM_USERS)], 10)
        assert tuples(found.groupBy("audit_user").count(), "audit_user", "count") == [("bob", 3000)]


@pytest.mark.parametrize("letters", ["ab", "01234567", "a\\EQ.*(é\U0001f600"])
def test_numbers_of_any_length_are_found_in_texts(make, changes, letters):
    """Overlapping, repeated and special characters; numbers shorter and longer than a gram."""
    rng = random.Random(len(letters))

    def word(longest):
        return "".join(rng.choice(letters) for _ in range(rng.randrange(1, longest)))

    rows = [
        {"patient_id": i, "insurance_sr_id": i, "membership_id": word(14), "insurance_no": word(7)} for i in range(40)
    ]
    texts = [word(90) for _ in range(30)] + [f"{word(9)}{r['membership_id']}{word(9)}" for r in rows[:20]]
    log = [
        {"modified_by": f"u{i:02}", "new_values": t, "modified_date": AT + timedelta(seconds=i)}
        for i, t in enumerate(texts)
    ]
    want = []
    for r in rows:
        hits = [i for i, t in enumerate(texts) if r["membership_id"] in t or r["insurance_no"] in t]
        want += [(r["patient_id"], f"u{hits[-1]:02}")] if hits else []
    found = match_logs(changes(*rows), [_edit(make, *log)], 10)
    assert tuples(found, "patient_id", "audit_user") == sorted(want, key=repr) and len(want) > 20


def test_a_bin_of_very_many_numbers_has_a_bounded_size(spark):
    """Every log entry was tested against a list of all grams sought near it, which grew with the changes."""
    searched = spark.range(0, 20_000, 1, 4).selectExpr(
        "'edit_log' as log", "0L as bin", "'text' as kind", "hex(xxhash64(id)) as value"
    )
    # A bin of few numbers, and one in which only whole values are sought.
    searched = searched.union(spark.sql("select 'edit_log', 1L, 'text', 'ab'"))
    searched = searched.union(spark.sql("select 'edit_log', 2L, 'id', 'cd'"))
    bins = _gram_bins(searched)
    lists = [c for c, kind in bins.dtypes if kind.startswith("array")]
    sizes = {r[0]: sum(r[1:]) for r in bins.select("bin", *[F.size(c) for c in lists]).collect()}
    assert sizes == {0: WORDS + 1, 1: 2, 2: 1}


def test_numbers_are_found_among_very_many_in_one_bin(spark, make, changes):
    """So many that most grams have a bit, sought or not: only texts that hold a number match."""
    numbers = [f"{i * 7919 % 1_000_000:06}x{i:05}" for i in range(6000)]
    rows = [{"patient_id": i, "insurance_sr_id": i, "membership_id": n} for i, n in enumerate(numbers)]
    log = [{"modified_by": f"u{i}", "new_values": f"a {numbers[i]} b"} for i in range(0, 6000, 500)]
    # All grams of a number, but not the number.
    log += [{"modified_by": "nobody", "new_values": f"{numbers[7][:8]} {numbers[7][5:]}"}]
    found = match_logs(changes(*rows), [_edit(make, *log)], 10)
    assert tuples(found, "patient_id", "audit_user") == sorted([(i, f"u{i}") for i in range(0, 6000, 500)], key=repr)
