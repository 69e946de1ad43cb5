"""Dispense charges: which drug a charge is for, and each patient's last one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import since
from covdrift.functions.text import or_blank
from covdrift.operators.latest import latest_per
from covdrift.operators.narrow import only_keys
from covdrift.params import DrugRule


def drug_of(code: Column, descr: Column, rules: Sequence[DrugRule]) -> Column:
    """Drug of the first rule that matches; NULL when none does."""
    code = F.upper(code.cast("string"))
    text = F.upper(or_blank(descr))
    drug = F.lit(None).cast("string")
    for rule in reversed(rules):
        listed = code.isin(*[c.upper() for c in rule.codes])
        named = text.contains(rule.text.upper()) & text.contains(rule.dispense_word.upper())
        drug = F.when(listed | named, rule.drug).otherwise(drug)
    return drug


def classify(df: DataFrame, code: str, descr: str, rules: Sequence[DrugRule]) -> DataFrame:
    """Add ``biologic_drug``; rows no rule matches are dropped."""
    drug = drug_of(F.col(code), F.col(descr), rules)
    return df.withColumn("biologic_drug", drug).where(F.col("biologic_drug").isNotNull())


def charge_join(detail: DataFrame, header: DataFrame, codes: DataFrame) -> DataFrame:
    """Charge lines with their patient and code text.

    The code table is joined first: once classified it holds a handful of codes, so it removes
    most lines before the shuffle on ``tran_id``. No side is hinted; Spark broadcasts by measured
    size and splits skewed partitions otherwise.
    """
    return detail.join(codes, "billing_id").join(
        header.where(F.col("patient_id").isNotNull()), "tran_id"
    )


def dispense_charges(
    tables: Mapping[str, DataFrame],
    rules: Sequence[DrugRule],
    as_of: date,
    lookback_days: int,
    patients: DataFrame | None = None,
) -> DataFrame:
    """Charges of the rules' drugs since the lookback date, future-dated ones included."""
    lines = tables["billing_detail"].where(since(F.col("service_date"), as_of, lookback_days))
    codes = classify(tables["billing_master"], "billing_id", "descr", rules)
    header = only_keys(tables["billing_header"], "patient_id", patients)
    return charge_join(lines, header, codes).select(
        "patient_id",
        "biologic_drug",
        F.col("service_date").alias("dispense_date"),
        F.col("tran_id").alias("dispense_tran_id"),
        F.col("sr_id").alias("dispense_sr_id"),
        F.col("billing_id").alias("dispense_code"),
        F.col("descr").alias("dispense_descr"),
    )


def last_dispense(charges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest charge per key: (patient, drug) for the report, patient alone for reminders."""
    newest_first = [
        F.col(c).desc_nulls_last()
        for c in ("dispense_date", "dispense_tran_id", "dispense_sr_id", "dispense_code")
    ]
    return latest_per(charges, keys, newest_first)
