from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from covdrift import Params
from covdrift.operators.ids import assign_ids, max_id
from covdrift.operators.reminders import detail_rows, missing_details, open_count, suppress_open
from covdrift.plans.reminders import (
    CANDIDATE_COLUMNS,
    new_details,
    new_reminders,
    reminder_candidates,
    run_reminders,
)
from covdrift.schemas import SCHEMAS
from covdrift.sinks.commits import CommitLog
from covdrift.sinks.reports import order_candidates
from covdrift.sinks.store import ReminderStore
from tests.conftest import NOW, TODAY, settings, tuples

MARKER = "BIO_INS_CHANGE_PA"
DISPENSED = date(2024, 1, 10)
CHANGED = datetime(2024, 1, 15, 9, 0, 0)


def _insurance(patient, **values):
    return {
        "patient_id": patient,
        "sr_id": patient * 10,
        "insurance_id": 5,
        "membership_id": "M1",
        "group_no": "G1",
        "priority": "P",
        "active": "Y",
        "start_date": date(2024, 1, 12),
        "created_date": CHANGED,
        **values,
    }


@pytest.fixture
def tables(make):
    """Patients 1 to 4 are due a reminder; 5 only had an edit and 6 no dispense."""
    patients = range(1, 7)
    codes = {1: "XO150", 2: "FAS30", 3: "TEZ", 4: "XO150", 5: "XO150"}
    return {
        "billing_header": make(
            "billing_header", *[{"tran_id": p, "patient_id": p} for p in patients]
        ),
        "billing_detail": make(
            "billing_detail",
            *[
                {"tran_id": p, "sr_id": 1, "billing_id": code, "service_date": DISPENSED}
                for p, code in codes.items()
            ],
            # Older, so patient 1 still gets one reminder, for the newest dispense.
            {"tran_id": 1, "sr_id": 2, "billing_id": "TEZ", "service_date": date(2024, 1, 2)},
        ),
        "billing_master": make(
            "billing_master", *[{"billing_id": c, "descr": c} for c in set(codes.values())]
        ),
        "patient_insurance": make(
            "patient_insurance",
            _insurance(1),
            _insurance(2, membership_id=None, insurance_no="I2", insurance_id=None),
            _insurance(3, active="N"),
            _insurance(4, membership_id=None, group_no=None),
            _insurance(
                5,
                start_date=date(2020, 1, 1),
                created_date=datetime(2020, 1, 1),
                changed_date=CHANGED,
            ),
            _insurance(6),
        ),
        "patient_master": make(
            "patient_master",
            *[{"id": p, "patient_no": f"N{p}", "lastname": f"L{p}"} for p in (1, 2, 4, 5, 6)],
        ),
        "insurance_plan_master": make(
            "insurance_plan_master", {"srno": 5, "name": "Plan5", "carrier_id": 1}
        ),
        "insurance_carrier_master": make("insurance_carrier_master", {"srno": 1, "name": "Car1"}),
        "todo": make("todo"),
        "tobe_done_detail": make("tobe_done_detail"),
        "edit_log_header": make(
            "edit_log_header",
            {"PK_1": "1", "modified_by": "ann", "modified_date": CHANGED},
            {"PK_1": "2", "modified_by": "ann", "modified_date": CHANGED},
            {"PK_1": "6", "modified_by": "bob", "modified_date": CHANGED},
        ),
        "audit_trail": make("audit_trail"),
        "emp_master": make(
            "emp_master", {"empid": 1, "user_name": "ANN", "firstname": "Ann", "lastname": "Lee"}
        ),
    }


def _todo(tran, **values):
    return {
        "tran_id": tran,
        "status": "G",
        "forwhom": "P",
        "forwhom_id": 1,
        "source": MARKER,
        "todo_date": TODAY,
        **values,
    }


def test_candidates(tables, params):
    found = reminder_candidates(tables, params)
    assert found.columns == CANDIDATE_COLUMNS and len(CANDIDATE_COLUMNS) == 27
    assert tuples(found, "patient_id", "biologic_drug", "category_id", "patient_name") == [
        (1, "XOLAIR", 14, "L1, "),
        (2, "FASENRA", 81, "L2, "),
        (3, "TEZSPIRE", 123, ", "),
        (4, "XOLAIR", 14, "L4, "),
    ]
    ordered = [(r.biologic_drug, r.patient_name) for r in order_candidates(found).collect()]
    assert ordered == [
        ("FASENRA", "L2, "),
        ("TEZSPIRE", ", "),
        ("XOLAIR", "L1, "),
        ("XOLAIR", "L4, "),
    ]


def test_reminder_text(tables, params):
    texts = dict(tuples(reminder_candidates(tables, params), "patient_id", "reminder_text"))
    assert texts[1] == (
        "CHECK AUTH / REFERRAL STATUS BEFORE NEXT BUY-AND-BILL BIOLOGIC. Insurance changed after "
        "recent XOLAIR dispense. Verify PA/no-PA and referral status before administration. "
        "Last dispense 2024-01-10 XO150. Current primary: Plan5, member M1, group G1."
    )
    assert texts[2].endswith("Current primary: (none), member I2, group G1.")
    assert texts[3].endswith("Current primary: (none), member , group .")
    assert texts[4].endswith("Current primary: Plan5, member , group .")


def test_extra_condition(tables, params):
    none = reminder_candidates(tables, params, extra=F.lit(False))
    assert none.count() == 0
    one = reminder_candidates(tables, params, extra=F.col("patient_id") == 2)
    assert tuples(one, "patient_id") == [(2,)]


def test_same_candidates_without_broadcasts(spark, tables, params):
    narrowed = tuples(reminder_candidates(tables, params), *CANDIDATE_COLUMNS)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert tuples(reminder_candidates(tables, params), *CANDIDATE_COLUMNS) == narrowed


@pytest.mark.parametrize(
    ("row", "blocked"),
    [
        ({}, True),
        ({"status": "C"}, False),
        ({"source": None}, False),
        ({"source": "OTHER"}, False),
        ({"forwhom": "E"}, False),
        ({"forwhom_id": None}, False),
        ({"forwhom_id": 2}, False),
    ],
)
def test_suppress_open(make, spark, row, blocked):
    candidates = spark.createDataFrame([(1,)], "patient_id bigint")
    todo = make("todo", _todo(1, **row), _todo(2, **row))
    assert suppress_open(candidates, todo, MARKER).count() == int(not blocked)


def test_missing_details_and_open_count(make):
    todo = make(
        "todo",
        _todo(1),
        _todo(2),
        _todo(3, forwhom="E"),
        _todo(4, status="C"),
        _todo(5, source=None),
    )
    details = make("tobe_done_detail", {"tran_id": 9, "todo_id": 2}, {"tran_id": 8})
    assert tuples(missing_details(todo, details, MARKER), "tran_id") == [(1,), (3,)]
    assert tuples(open_count(todo, MARKER), "open_reminders") == [(3,)]


def test_new_details(make, params):
    todo = make("todo", _todo(7, iteration=2, todo_at="T", createdby_id=-1), _todo(3))
    details = make("tobe_done_detail", {"tran_id": 40, "todo_id": 1})
    rows = new_details(todo, details, params)
    columns = ("tran_id", "todo_id", "task_status", "show_date", "iteration", "created_date")
    shown = TODAY - timedelta(days=7)
    assert tuples(rows, *columns) == [
        (41, 3, "P", shown, None, NOW),
        (42, 7, "P", shown, 2, NOW),
    ]
    assert set(detail_rows(todo, params).columns) | {"tran_id"} == set(
        SCHEMAS["tobe_done_detail"].names
    )


def test_new_reminders(tables, params, make):
    rows = new_reminders(reminder_candidates(tables, params), make("todo", _todo(100)), params)
    assert rows.columns == SCHEMAS["todo"].names
    first = rows.orderBy("tran_id").first().asDict()
    note = first.pop("note")
    assert note.startswith("CHECK AUTH")
    assert first == {
        "tran_id": 101,
        "tran_date": TODAY,
        "status": "G",
        "forwhom": "P",
        "forwhom_name": "L1, ",
        "category_id": 14,
        "todo": "ALERT! Check auth/referral before buy-and-bill biologic",
        "todo_at": "T",
        "todo_date": TODAY,
        "todo_time": "12:00:00",
        "tobe_doneby": "Biologics ",
        "generated_by": "U",
        "priority": "H",
        "todo_by_multi_group": ",14,",
        "assignto_flag": "N",
        "forwhom_id": 1,
        "ref_tran_id": 1,
        "ref_sr_id": 1,
        "source": MARKER,
        "is_auto": "Y",
        "created_date": NOW,
        "changed_date": NOW,
        "createdby_id": -1,
        "changedby_id": -1,
        "iteration": None,
    }


@pytest.mark.parametrize("parts", [1, 7])
def test_ids_are_consecutive_and_follow_the_key(spark, make, parts):
    keys = spark.range(0, 3000, 1, parts).select((F.col("id") * 7919 % 3001).alias("k"))
    base = max_id(make("todo", _todo(50)))
    rows = tuples(assign_ids(keys, base, "k", "new_id"), "k", "new_id")
    in_order = sorted(rows)
    assert [new for _, new in in_order] == list(range(51, 3051))


def test_ids_start_at_one(spark, make):
    keys = spark.createDataFrame([(5,), (3,)], "k bigint")
    rows = assign_ids(keys, max_id(make("todo")), "k", "new_id")
    assert tuples(rows, "k", "new_id") == [(3, 1), (5, 2)]
    empty = assign_ids(keys.where("k > 9"), max_id(make("todo")), "k", "new_id")
    assert empty.count() == 0


def test_dry_run_writes_only_the_report(spark, tables, params, folder):
    store = ReminderStore(spark, folder + "/store").create()
    run = run_reminders(tables, params, store, "r1", report_folder=folder + "/reports")
    assert run.candidate_rows == 4 and run.inserted == 0
    assert store.todo().count() == 0 and store.details().count() == 0
    report = spark.read.option("header", True).csv(run.report_path)
    assert report.columns == CANDIDATE_COLUMNS and report.count() == 4


def test_apply_and_apply_again(spark, tables, params, folder):
    store = ReminderStore(spark, folder).create()
    first = run_reminders(tables, params, store, "r1", apply=True)
    assert first.inserted == 4 and first.open_reminders == 4
    assert tuples(store.todo(), "tran_id", "forwhom_id") == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert tuples(store.details(), "tran_id", "todo_id") == [(1, 1), (2, 2), (3, 3), (4, 4)]
    # Patients 3 and 4 have no log entry; patient 6 has one but no reminder.
    assert first.unattributed == 2
    notices = {r.marker_prefix: r for r in first.outbox.collect()}
    staff = notices["bio_auth:202401161200"]
    assert staff.employees == ["Lead", "Backup", "Desk"]
    assert staff.message == (
        "4 new biologic insurance/auth alerts created in the practice system for patient_no "
        "N1, N2, N4. Check Biologics reminders now for PA/referral status before next "
        "buy-and-bill dose."
    )
    user = notices["bio_auth:202401161200:user"]
    assert user.employees == ["Ann Lee"] and "patient_no N1, N2, who" in user.message

    second = run_reminders(tables, params, store, "r2", apply=True)
    assert second.inserted == 0 and second.open_reminders == 4 and second.outbox is None
    assert store.todo().count() == 4 and store.details().count() == 4


@pytest.mark.parametrize(
    "step", ["events", "staging", "tasks", "insert 1", "insert 2", "insert 3", "log", "attributed", "outbox"]
)
def test_a_run_that_died_goes_on_under_its_id(spark, tables, params, folder, step, monkeypatch):
    """Stopped before any write, readers see no part of the run; started again, it is made once."""
    store = ReminderStore(spark, folder, buckets=3).create()
    stage, insert, inserts = ReminderStore.stage_counted, type(spark).sql, []

    def die_at(self, name, *rest):
        if name == step:
            raise RuntimeError("lost")
        return stage(self, name, *rest)

    def die_inserting(self, text, *rest):
        inserts.append(text.startswith("INSERT"))
        if text.startswith("INSERT") and step == f"insert {sum(inserts)}":
            raise RuntimeError("lost")
        return insert(self, text, *rest)

    def die_logging(self, number, entry):
        if "tables" in entry and step == "log":
            raise RuntimeError("lost")
        return append(self, number, entry)

    append = CommitLog.append
    with monkeypatch.context() as broken:
        broken.setattr(ReminderStore, "stage_counted", die_at)
        broken.setattr(type(spark), "sql", die_inserting)
        broken.setattr(CommitLog, "append", die_logging)
        with pytest.raises(RuntimeError):
            run_reminders(tables, params, store, "r1", apply=True)
    seen = 4 if step in ("attributed", "outbox") else 0
    assert store.todo().count() == store.details().count() == seen
    assert bool(store.snapshots().count()) == bool(seen)
    run = run_reminders(tables, params, store, "r1", apply=True)
    assert run.inserted == 4 and run.outbox.count() == 2
    assert tuples(store.todo(), "tran_id", "forwhom_id") == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert tuples(store.details(), "tran_id", "todo_id") == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_a_finished_run_is_read_not_made_again(spark, tables, params, folder, monkeypatch):
    store = ReminderStore(spark, folder, buckets=3).create()
    run = run_reminders(tables, params, store, "r1", apply=True)
    monkeypatch.setattr("covdrift.plans.reminders.reminder_candidates", None)
    monkeypatch.setattr("covdrift.plans.reminders.attributed_changes", None)
    again = run_reminders(tables, params, ReminderStore(spark, folder, buckets=3).create(), "r1", apply=True)
    assert tuples(again.outbox, "message") == tuples(run.outbox, "message")
    assert store.todo().count() == 4 and store.details().count() == 4 and store.version() == 1


def test_a_run_adds_the_task_rows_that_imported_reminders_lack(spark, tables, params, make, folder):
    store = ReminderStore(spark, folder, buckets=3).create()
    batch = new_reminders(reminder_candidates(tables, params), make("todo", _todo(40)), params)
    assert store.commit("import", 0, {"todo": batch, "tobe_done_detail": make("tobe_done_detail")})
    run = run_reminders(tables, params, store, "r2", apply=True)
    assert run.inserted == 0 and run.open_reminders == 4
    assert tuples(store.details(), "tran_id", "todo_id") == [(1, 41), (2, 42), (3, 43), (4, 44)]


def test_two_runs_at_once_open_each_reminder_once(spark, tables, params, folder, monkeypatch):
    """Run b commits after run a has decided and before it commits; a looks again."""
    mine, other = (ReminderStore(spark, folder, buckets=3).create() for _ in range(2))
    commit = ReminderStore.commit
    late = []

    def between(self, run_id, version, rows):
        if run_id == "a" and not late:
            late.append(run_reminders(tables, params, other, "b", apply=True, extra=F.col("patient_id") > 2))
        return commit(self, run_id, version, rows)

    monkeypatch.setattr(ReminderStore, "commit", between)
    first = run_reminders(tables, params, mine, "a", apply=True)
    assert late[0].inserted == 2 and first.inserted == 2 and first.open_reminders == 4
    rows = tuples(mine.todo(), "forwhom_id", "tran_id")
    assert [patient for patient, _ in rows] == [1, 2, 3, 4] and len({new for _, new in rows}) == 4
    assert tuples(mine.details(), "todo_id") == sorted((new,) for _, new in rows)
    assert len({r.tran_id for r in mine.details().collect()}) == 4


def test_reserved_ranges_are_disjoint_and_leave_no_gap(spark, make, folder, monkeypatch):
    one, two = (ReminderStore(spark, folder, buckets=3).create() for _ in range(2))
    one.commit("import", 0, {"todo": make("todo", _todo(7), _todo(9))})
    assert [one.reserve("todo", "a", 5), two.reserve("todo", "b", 3), one.reserve("todo", "c", 1)] == [10, 15, 18]
    assert two.reserve("todo", "a", 5) == 10 and one.reserve("tobe_done_detail", "a", 2) == 1
    # A writer that read the log before another one wrote to it takes the next range.
    entries, raced = CommitLog.entries, []

    def read_then_overtaken(self):
        found = entries(self)
        if not raced:
            raced.append("once")
            raced.append(two.reserve("todo", "fast", 4))
        return found

    monkeypatch.setattr(CommitLog, "entries", read_then_overtaken)
    assert (one.reserve("todo", "slow", 2), raced) == (23, ["once", 19])


def test_history_is_not_shuffled(spark, make, folder):
    store = ReminderStore(spark, folder, buckets=5).create()
    for run in ("r1", "it's r2"):
        number = store.version()
        todo = make("todo", *[_todo(number * 50 + i, forwhom_id=i) for i in range(40)])
        tasks = make("tobe_done_detail", *[{"tran_id": number * 50 + i, "todo_id": i} for i in range(40)])
        assert store.commit(run, number, {"todo": todo, "tobe_done_detail": tasks})
    assert store.commit("late", 0, {"todo": make("todo", _todo(999, forwhom_id=77))}) is False
    candidates = spark.createDataFrame([(i,) for i in range(30, 90)], "patient_id bigint")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        kept = suppress_open(candidates, store.todo(), MARKER)
        assert sorted(r.patient_id for r in kept.collect()) == list(range(40, 90))
        missing = missing_details(store.todo(), store.details(), MARKER)
        for frame, history in ((kept, "todo"), (missing, "tobe_done_detail")):
            text = frame._jdf.queryExecution().executedPlan().toString()
            assert text.count("Exchange") == 1, text
            # The one exchange stands above the other side's scan.
            join = text.split("LeftAnti")[1]
            assert "Exchange" not in join[join.index("HashAggregate") :], history
        assert missing.count() == 40


def test_notices_hold_no_identifier_but_the_number(spark, tables, params, folder):
    store = ReminderStore(spark, folder).create()
    run = run_reminders(tables, params, store, "r1", apply=True)
    assert run.outbox.columns == ["employees", "message", "marker_prefix", "source", "payload"]
    text = " ".join(r.payload + r.message for r in run.outbox.collect())
    for secret in ("L1", "L2", "M1", "I2", "G1", "Plan5", "2024-01-10", "XO150"):
        assert secret not in text


@pytest.mark.parametrize(
    "bad",
    [
        {"dispense_lookback_days": 0},
        {"dispense_lookback_days": 366},
        {"change_lookback_days": 0},
        {"change_lookback_days": 31},
    ],
)
def test_lookback_bounds(bad):
    with pytest.raises(ValueError, match="between"):
        Params.at(NOW, **bad)
    assert Params.at(NOW, dispense_lookback_days=365, change_lookback_days=30).as_of == TODAY
