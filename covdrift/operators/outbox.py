"""Notices, one row each, that carry patient numbers and nothing else about a patient.

All numbers of an employee stay rows. A notice shows the first few and how many more there are, so
only those few and a count are gathered; no task ever holds all numbers of an employee.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covdrift.functions.predicates import wall_clock
from covdrift.functions.text import capped_list, fold_case, split_team, squeeze
from covdrift.params import Params


def distinct_numbers(alerts: DataFrame, *group: str) -> DataFrame:
    """Patient numbers per group, once each whatever their case and spacing.

    A blank number stays, as NULL, so a group without any number is not lost.
    """
    number = squeeze(F.col("patient_no"))
    return (
        alerts.select(*group, F.when(number != "", number).alias("patient_no"))
        .groupBy(*group, fold_case(F.col("patient_no")).alias("_folded"))
        .agg(F.min("patient_no").alias("patient_no"))
        .drop("_folded")
    )


def user_numbers(user_alerts: DataFrame) -> DataFrame:
    """(employee, patient_no): every number of each employee, one row each.

    A NULL number stands for alerts that lack one, so no employee is lost.
    """
    employee = F.trim("employee_name").alias("employee")
    return distinct_numbers(
        user_alerts.select(employee, "patient_no").where("employee <> ''"), "employee"
    )


def shown_numbers(numbers: DataFrame, shown: int) -> DataFrame:
    """(employee, n_numbers, numbers): the first ``shown`` numbers in order, and how many exist."""
    in_order = Window.partitionBy("employee").orderBy("patient_no")
    first = (
        numbers.where(F.col("patient_no").isNotNull())
        .withColumn("_rank", F.row_number().over(in_order))
        .where(F.col("_rank") <= shown)
        .groupBy("employee")
        .agg(F.sort_array(F.collect_list("patient_no")).alias("numbers"))
    )
    totals = numbers.groupBy("employee").agg(F.count("patient_no").alias("n_numbers"))
    return totals.join(first, "employee", "left").select(
        "employee",
        "n_numbers",
        F.coalesce("numbers", F.array().cast("array<string>")).alias("numbers"),
    )


def _number_text() -> Column:
    return capped_list(F.col("numbers"), F.col("n_numbers"))


def capped_numbers(listed: DataFrame) -> DataFrame:
    """(employee, numbers_text) from ``shown_numbers``."""
    return listed.select("employee", _number_text().alias("numbers_text"))


def _marker(params: Params, suffix: str = "") -> Column:
    minute = F.date_format(wall_clock(params.as_of_ts), "yyyyMMddHHmm")
    return F.concat(F.lit(f"{params.messages.marker_prefix}:"), minute, F.lit(suffix))


def _notice(df: DataFrame, employees: Column, message: Column, marker: Column, source: str):
    return df.select(
        employees.alias("employees"),
        message.alias("message"),
        marker.alias("marker_prefix"),
        F.lit(source).alias("source"),
    )


def user_outbox(listed: DataFrame, params: Params) -> DataFrame:
    """One notice per employee who made a change, from ``shown_numbers``."""
    texts = params.messages
    named = F.concat(
        F.lit("You changed insurance for patient_no "),
        _number_text(),
        F.lit(f", who receives a buy-and-bill biologic. {texts.user_action}"),
    )
    message = F.when(F.col("n_numbers") > 0, named).otherwise(texts.user_default)
    return _notice(
        listed,
        F.array("employee"),
        message,
        _marker(params, ":user"),
        params.routing.marker,
    )


def staff_outbox(patient_alerts: DataFrame, batch: DataFrame, params: Params) -> DataFrame:
    """The staff team's notice: one row, or none without new reminders or without a team.

    The wording goes by the number of new reminders, the list by distinct patient numbers.
    """
    texts = params.messages
    team = split_team(texts.staff_team)
    numbers = distinct_numbers(patient_alerts).where(F.col("patient_no").isNotNull())
    no_number, zero = F.lit(None).cast("string"), F.lit(0).cast("bigint")
    parts = (
        numbers.orderBy("patient_no")
        .limit(texts.shown_numbers)
        .select("patient_no", zero.alias("n_numbers"), zero.alias("n_new"))
        .unionByName(
            numbers.agg(F.count("*").alias("n_numbers")).select(
                no_number.alias("patient_no"), "n_numbers", zero.alias("n_new")
            )
        )
        .unionByName(
            batch.agg(F.count("*").alias("n_new")).select(
                no_number.alias("patient_no"), zero.alias("n_numbers"), "n_new"
            )
        )
    )
    # A handful of shown numbers and two count rows: collect_list skips the latter's NULLs.
    summary = parts.agg(
        F.sort_array(F.collect_list("patient_no")).alias("numbers"),
        F.sum("n_numbers").alias("n_numbers"),
        F.sum("n_new").alias("n_new"),
    ).where(F.col("n_new") > 0)
    many = F.col("n_new") > 1
    alerts = F.when(
        many,
        F.concat(
            F.col("n_new").cast("string"),
            F.lit(f" new biologic insurance/auth alerts created in {texts.system}"),
        ),
    ).otherwise(f"New biologic insurance/auth alert created in {texts.system}")
    named = F.concat(
        alerts, F.lit(" for patient_no "), _number_text(), F.lit(f". {texts.staff_action}")
    )
    message = (
        F.when(F.col("n_numbers") > 0, named)
        .when(many, F.concat(alerts, F.lit(f". {texts.staff_action}")))
        .otherwise(texts.staff_default)
    )
    notice = _notice(
        summary,
        F.array(*[F.lit(name) for name in team]).cast("array<string>"),
        message,
        _marker(params),
        params.routing.marker,
    )
    return notice.where(F.size("employees") > 0)


def with_payload(outbox: DataFrame) -> DataFrame:
    """Add the notice as one JSON text, as a delivery service would take it."""
    return outbox.withColumn("payload", F.to_json(F.struct(*outbox.columns)))
