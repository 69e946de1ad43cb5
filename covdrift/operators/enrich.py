"""Lookups of names. Every lookup is a left join, so no row is lost for want of a name.

None carries a broadcast hint: Spark broadcasts a lookup table whose measured size is under its
threshold, and for a larger one shuffles and lets AQE split a key many rows share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.functions.text import patient_name


def plan_lookup(plan: DataFrame, carrier: DataFrame) -> DataFrame:
    """Plan id with plan and carrier names; built once and used for every plan column."""
    carriers = carrier.select(
        F.col("srno").alias("carrier_id"), F.col("name").alias("carrier_name")
    )
    return (
        plan.select(F.col("srno").alias("plan_id"), F.col("name").alias("plan_name"), "carrier_id")
        .join(carriers, "carrier_id", "left")
        .select("plan_id", "plan_name", "carrier_name")
    )


def with_plan(df: DataFrame, lookup: DataFrame, prefix: str) -> DataFrame:
    """Add ``<prefix>_plan_name`` and ``<prefix>_carrier_name`` for ``<prefix>_insurance_id``."""
    names = lookup.select(
        F.col("plan_id").alias(f"{prefix}_insurance_id"),
        F.col("plan_name").alias(f"{prefix}_plan_name"),
        F.col("carrier_name").alias(f"{prefix}_carrier_name"),
    )
    return df.join(names, f"{prefix}_insurance_id", "left")


def with_patient(df: DataFrame, patients: DataFrame) -> DataFrame:
    """Add ``patient_no`` and ``patient_name`` for ``patient_id``."""
    names = patients.select(F.col("id").alias("patient_id"), "patient_no", "lastname", "firstname")
    return (
        df.join(names, "patient_id", "left")
        .withColumn("patient_name", patient_name(F.col("lastname"), F.col("firstname")))
        .drop("lastname", "firstname")
    )


def with_office(df: DataFrame, offices: DataFrame) -> DataFrame:
    """Add ``office_code`` for ``office_id``."""
    codes = offices.select(F.col("srno").alias("office_id"), "office_code")
    return df.join(codes, "office_id", "left")


def prefixed(df: DataFrame, prefix: str, columns: list[str], keep: list[str]) -> DataFrame:
    """``keep`` as is, and ``columns`` renamed to ``<prefix>_<column>``."""
    return df.select(*keep, *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
