"""Column predicates shared by all operators. Bounds are literals, so scans can push them down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(ts: datetime) -> Column:
    """A zone-free timestamp literal; ``F.lit(datetime)`` would go through the session zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def at_midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def since(day: Column, as_of: date, days: int) -> Column:
    """``day`` is on or after the date ``days`` before ``as_of``; later dates have no bound."""
    return day >= F.lit(as_of - timedelta(days=days))


def within(day: Column, as_of: date, days: int) -> Column:
    """``day`` lies from ``as_of`` to ``days`` later, both included."""
    return day.between(F.lit(as_of), F.lit(as_of + timedelta(days=days)))


def valid_on(start: Column, end: Column, day: Column) -> Column:
    """The interval holds ``day``; both ends count and a NULL end is open."""
    return (start.isNull() | (start <= day)) & (end.isNull() | (end >= day))


def is_active(flag: Column) -> Column:
    return F.coalesce(flag, F.lit("Y")) == "Y"


def is_person(user: Column, system_users: Sequence[str]) -> Column:
    return ~F.coalesce(user, F.lit("")).isin(*system_users)


def differs(left: Column, right: Column, blank: int | str) -> Column:
    """Values differ once NULL is read as ``blank``."""
    return F.coalesce(left, F.lit(blank)) != F.coalesce(right, F.lit(blank))


def map_code(code: Column, labels: Mapping) -> Column:
    """Label of a code; NULL for a code without one."""
    result = F.lit(None)
    for key, label in labels.items():
        result = F.when(code == key, F.lit(label)).otherwise(result)
    return result
