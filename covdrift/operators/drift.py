"""The rule cascade that says whether, and how, coverage has drifted since the last dispense."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import at_midnight, differs

NO_ALERT = "NO ALERT"


@dataclass(frozen=True)
class DriftRule:
    reason: str
    priority: int
    holds: Column


def drift_rules() -> list[DriftRule]:
    """Fixed rules in order; the first that holds gives an appointment its reason.

    NULL reads as -1 for the plan and as blank for texts, so NULL and blank are the same. The
    group name is carried along but never compared.
    """
    col = F.col
    changed_after = col("current_changed_date") > at_midnight(col("dispense_date"))
    return [
        DriftRule("NO RECENT DISPENSE FOUND", 2, col("has_dispense").isNull()),
        DriftRule("NO CURRENT PRIMARY INSURANCE", 1, col("has_current").isNull()),
        DriftRule(
            "NO PRIMARY INSURANCE FOUND AT LAST DISPENSE", 2, col("has_at_dispense").isNull()
        ),
        DriftRule("PRIMARY PLAN CHANGED", 1, _differs("insurance_id", -1)),
        DriftRule("SUBSCRIBER/INSURANCE NO CHANGED", 1, _differs("insurance_no", "")),
        DriftRule("MEMBER ID CHANGED", 1, _differs("membership_id", "")),
        DriftRule("GROUP NO CHANGED", 1, _differs("group_no", "")),
        DriftRule(
            "CURRENT PRIMARY STARTS AFTER DISPENSE",
            1,
            col("current_start_date") > col("dispense_date"),
        ),
        DriftRule("CURRENT PRIMARY EDITED AFTER DISPENSE", 2, changed_after),
    ]


def _differs(field: str, blank: int | str) -> Column:
    return differs(F.col(f"current_{field}"), F.col(f"dispense_{field}"), blank)


def _outcome(reason: str, priority: int) -> Column:
    return F.struct(
        F.lit(reason).alias("alert_reason"), F.lit(priority).alias("alert_priority")
    )


def first_match(rules: list[DriftRule]) -> Column:
    """(reason, priority) of the first rule that holds; a NULL test does not hold."""
    outcome = _outcome(NO_ALERT, 9)
    for rule in reversed(rules):
        outcome = F.when(rule.holds, _outcome(rule.reason, rule.priority)).otherwise(outcome)
    return outcome


def drift(base: DataFrame) -> DataFrame:
    """Add ``alert_reason`` and ``alert_priority`` to every appointment."""
    return base.select("*", first_match(drift_rules()).alias("_drift")).select(
        *base.columns, "_drift.*"
    )
