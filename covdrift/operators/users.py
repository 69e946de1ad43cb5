"""From a log user to an employee, and from there to the alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.functions.text import or_blank


def employee_keys(employees: DataFrame) -> DataFrame:
    """(login_key, display_name): an employee is found by login or by full name, in lower case."""
    first, last = or_blank(F.col("firstname")), or_blank(F.col("lastname"))
    full_name = F.concat(first, F.lit(" "), last)
    keys = F.array(F.lower(or_blank(F.col("user_name"))), F.lower(full_name))
    # An employee without any name leaves the log user as it is.
    shown = F.when(F.concat(first, last) != "", full_name)
    return (
        employees.where(F.col("empid").isNotNull())
        .select(F.explode(F.array_distinct(keys)).alias("login_key"), shown.alias("display_name"))
        .distinct()
    )


def resolve_user(users: DataFrame, employees: DataFrame) -> DataFrame:
    """Add ``employee_name``: the employee's full name, or the log user when none is found.

    One equi-join on either key instead of a join on an OR. It runs on the distinct log users, so
    a user behind a large share of the changes is looked up once; a user who matches several
    employees gives a row for each name.
    """
    names = (
        users.select("audit_user")
        .distinct()
        .withColumn("login_key", F.lower("audit_user"))
        .join(employee_keys(employees), "login_key", "left")
        .select("audit_user", F.coalesce("display_name", "audit_user").alias("employee_name"))
        .distinct()
    )
    return users.join(names, "audit_user")


def patient_alerts(batch: DataFrame, patients: DataFrame) -> DataFrame:
    """Distinct patient numbers of the new reminders; patients without a number are left out."""
    numbers = patients.select(F.col("id").alias("forwhom_id"), "patient_no")
    return (
        batch.join(numbers, "forwhom_id")
        .where(or_blank(F.col("patient_no")) != "")
        .select("patient_no")
        .distinct()
    )


def user_alerts(resolved: DataFrame, patients: DataFrame) -> DataFrame:
    """Distinct (employee, log user, patient number); a missing number stays as blank."""
    numbers = patients.select(F.col("id").alias("patient_id"), "patient_no")
    return (
        resolved.where(or_blank(F.col("employee_name")) != "")
        .join(numbers, "patient_id", "left")
        .select("employee_name", "audit_user", or_blank(F.col("patient_no")).alias("patient_no"))
        .distinct()
    )


def unattributed(batch: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row: how many new reminders have no known author."""
    known = resolved.select(F.col("patient_id").alias("forwhom_id")).distinct()
    return batch.join(known, "forwhom_id", "left_anti").agg(
        F.count("*").alias("unattributed_reminders")
    )
