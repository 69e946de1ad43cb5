"""Typed run parameters.

Every "today" or "now" in a run is ``as_of`` / ``as_of_ts``: one date and one wall-clock
timestamp for all steps, so a long job cannot straddle midnight and a rerun gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime


@dataclass(frozen=True)
class DrugRule:
    """How one drug is recognised in charges and appointments, and where its reminders go.

    A charge matches when its code is listed, or when its text holds both ``text`` and
    ``dispense_word``. Codes and words are compared in upper case.
    """

    drug: str
    codes: tuple[str, ...]
    text: str
    procedure_id: int
    category_id: int
    dispense_word: str = "DISP"


# Drug codes, procedure ids and reminder categories.
DEFAULT_RULES = (
    DrugRule("XOLAIR", ("XO150", "XO300", "XOL75", "DISXO"), "XOLAIR", 21, 14),
    DrugRule("FASENRA", ("FAS30", "FASDI", "DISFA"), "FASENRA", 53, 81),
    DrugRule("TEZSPIRE", ("TEZ", "DISTE"), "TEZSPIRE", 55, 123),
)

# Log users that are never a person.
SYSTEM_USERS = ("", "system", "SYSTEM", "dba", "DBA")


@dataclass(frozen=True)
class ReminderRouting:
    """Fixed values of the reminder rows. The trailing blank in ``done_by`` is part of the value."""

    marker: str = "BIO_INS_CHANGE_PA"
    group_id: int = 14
    multi_group: str = ",14,"
    done_by: str = "Biologics "
    heading: str = "ALERT! Check auth/referral before buy-and-bill biologic"
    show_days_before: int = 7


@dataclass(frozen=True)
class Messages:
    """Notice texts. ``system`` and ``contact`` name the local system and person to tell."""

    system: str = "the practice system"
    contact: str = "the authorization contact"
    staff_team: str = ""
    marker_prefix: str = "bio_auth"
    shown_numbers: int = 8

    @property
    def staff_action(self) -> str:
        return "Check Biologics reminders now for PA/referral status before next buy-and-bill dose."

    @property
    def user_action(self) -> str:
        return (
            f"It is essential that you notify {self.contact} that the change occurred so new prior "
            f"authorization can be obtained. Check {self.system} Biologics reminders now."
        )

    @property
    def staff_default(self) -> str:
        return f"New biologic insurance/auth alert created in {self.system}. {self.staff_action}"

    @property
    def user_default(self) -> str:
        return (
            "You changed insurance for a patient receiving a buy-and-bill biologic. "
            f"{self.user_action}"
        )


@dataclass(frozen=True)
class Params:
    as_of: date
    as_of_ts: datetime
    report_lookback_days: int = 365
    horizon_days: int = 14
    dispense_lookback_days: int = 45
    change_lookback_days: int = 3
    audit_minutes: int = 10
    rules: tuple[DrugRule, ...] = DEFAULT_RULES
    system_users: tuple[str, ...] = SYSTEM_USERS
    routing: ReminderRouting = field(default_factory=ReminderRouting)
    messages: Messages = field(default_factory=Messages)

    def __post_init__(self) -> None:
        if not 1 <= self.dispense_lookback_days <= 365:
            raise ValueError("dispense_lookback_days must be between 1 and 365")
        if not 1 <= self.change_lookback_days <= 30:
            raise ValueError("change_lookback_days must be between 1 and 30")
        if not self.rules:
            raise ValueError("at least one drug rule is needed")

    @classmethod
    def at(cls, as_of_ts: datetime, **changes) -> "Params":
        """Parameters whose date and timestamp come from one clock reading."""
        return cls(as_of=as_of_ts.date(), as_of_ts=as_of_ts, **changes)

    @property
    def procedure_drugs(self) -> dict[int, str]:
        return {rule.procedure_id: rule.drug for rule in self.rules}

    @property
    def drug_categories(self) -> dict[str, int]:
        return {rule.drug: rule.category_id for rule in self.rules}
