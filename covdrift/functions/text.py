"""Text built from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def patient_name(last: Column, first: Column) -> Column:
    """``last, first``; just the separator when the patient row is missing."""
    return F.concat(or_blank(last), F.lit(", "), or_blank(first))


def reminder_text(
    drug: Column,
    dispense_date: Column,
    dispense_code: Column,
    plan_name: Column,
    membership_id: Column,
    insurance_no: Column,
    group_no: Column,
) -> Column:
    """Fixed wording of a reminder note."""
    return F.concat(
        F.lit(
            "CHECK AUTH / REFERRAL STATUS BEFORE NEXT BUY-AND-BILL BIOLOGIC. "
            "Insurance changed after recent "
        ),
        or_blank(drug),
        F.lit(
            " dispense. Verify PA/no-PA and referral status before administration. Last dispense "
        ),
        or_blank(dispense_date.cast("string")),
        F.lit(" "),
        or_blank(dispense_code),
        F.lit(". Current primary: "),
        F.coalesce(plan_name, F.lit("(none)")),
        F.lit(", member "),
        F.coalesce(membership_id, insurance_no, F.lit("")),
        F.lit(", group "),
        or_blank(group_no),
        F.lit("."),
    )


def squeeze(col: Column) -> Column:
    """Trim, and make every inner run of white space one blank."""
    return F.trim(F.regexp_replace(or_blank(col), r"(?U)\s+", " "))


def fold_case(col: Column) -> Column:
    """Case-free form for comparing; going through upper case also folds sharp s."""
    return F.lower(F.upper(col))


def capped_list(shown: Column, total: Column) -> Column:
    """``a, b, c`` or ``a, b, c +N more`` when more values exist than are shown; blank if none."""
    rest = total - F.size(shown)
    return F.concat(
        F.array_join(shown, ", "),
        F.when(rest > 0, F.concat(F.lit(" +"), rest.cast("string"), F.lit(" more"))).otherwise(""),
    )


def split_team(team: str) -> list[str]:
    """Names of a team setting, which separates them with ``;`` or ``|``."""
    return [name.strip() for name in team.replace("|", ";").split(";") if name.strip()]
