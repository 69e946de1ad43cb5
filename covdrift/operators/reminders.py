"""Reminder rows and their task rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import wall_clock
from covdrift.params import Params
from covdrift.schemas import SCHEMAS, conform

OPEN = "G"
FOR_PATIENT = "P"
AUTOMATIC_USER = -1


def open_reminders(todo: DataFrame, marker: str) -> DataFrame:
    return todo.where((F.col("status") == OPEN) & (F.col("source") == marker))


def suppress_open(candidates: DataFrame, todo: DataFrame, marker: str) -> DataFrame:
    """Candidates whose patient has no open reminder of this kind.

    Open reminders are reduced to distinct patients first, so a patient with very many of them is
    one row in the anti-join.
    """
    blocked = (
        open_reminders(todo, marker)
        .where(F.col("forwhom") == FOR_PATIENT)
        .select(F.col("forwhom_id").alias("patient_id"))
        .distinct()
    )
    return candidates.join(blocked, "patient_id", "left_anti")


def open_count(todo: DataFrame, marker: str) -> DataFrame:
    """One row: how many reminders of this kind are open."""
    return open_reminders(todo, marker).agg(F.count("*").alias("open_reminders"))


def reminder_rows(candidates: DataFrame, params: Params) -> DataFrame:
    """Candidates as reminder rows, still without an id."""
    routing = params.routing
    today, now = F.lit(params.as_of), wall_clock(params.as_of_ts)
    values = {
        "tran_date": today,
        "status": F.lit(OPEN),
        "forwhom": F.lit(FOR_PATIENT),
        "forwhom_name": F.col("patient_name"),
        "category_id": F.col("category_id"),
        "todo": F.lit(routing.heading),
        "todo_at": F.lit("T"),
        "todo_date": today,
        "todo_time": F.lit(params.as_of_ts.strftime("%H:%M:%S")),
        "tobe_doneby": F.lit(routing.done_by),
        "generated_by": F.lit("U"),
        "priority": F.lit("H"),
        "todo_by_multi_group": F.lit(routing.multi_group),
        "assignto_flag": F.lit("N"),
        "forwhom_id": F.col("patient_id"),
        "ref_tran_id": F.col("dispense_tran_id"),
        "ref_sr_id": F.col("dispense_sr_id"),
        "note": F.col("reminder_text"),
        "source": F.lit(routing.marker),
        "is_auto": F.lit("Y"),
        "created_date": now,
        "changed_date": now,
        "createdby_id": F.lit(AUTOMATIC_USER),
        "changedby_id": F.lit(AUTOMATIC_USER),
    }
    return candidates.select(*[value.alias(name) for name, value in values.items()])


def as_todo(rows: DataFrame) -> DataFrame:
    return conform(rows, SCHEMAS["todo"])


def missing_details(todo: DataFrame, details: DataFrame, marker: str) -> DataFrame:
    """Open reminders of this kind, from any run and for anyone, that have no task row."""
    have = details.select(F.col("todo_id").alias("tran_id")).distinct()
    return open_reminders(todo, marker).join(have, "tran_id", "left_anti")


def detail_rows(missing: DataFrame, params: Params) -> DataFrame:
    """Task rows for ``missing``, still without an id."""
    now = wall_clock(params.as_of_ts)
    return missing.select(
        F.col("tran_id").alias("todo_id"),
        "todo_date",
        "todo_at",
        "iteration",
        F.lit("P").alias("task_status"),
        F.date_sub("todo_date", params.routing.show_days_before).alias("show_date"),
        now.alias("created_date"),
        now.alias("changed_date"),
        "createdby_id",
        "changedby_id",
    )


def as_detail(rows: DataFrame) -> DataFrame:
    return conform(rows, SCHEMAS["tobe_done_detail"])
