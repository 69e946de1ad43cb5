"""Early restriction of a large table to the keys a later join keeps anyway."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.operators.work import staged


def keys_of(df: DataFrame, key: str) -> DataFrame:
    """The distinct keys, written once: read by several joins, and of a size Spark can see."""
    return staged(df.select(key).where(F.col(key).isNotNull()).distinct())


def only_keys(df: DataFrame, key: str, keys: DataFrame | None) -> DataFrame:
    """Rows of ``df`` with one of ``keys``; all rows where no restriction is asked for.

    A semi-join without a hint: the same rows are left out at every size, and Spark broadcasts
    the keys or shuffles both sides as their size asks for.
    """
    return df if keys is None else df.join(keys, key, "left_semi")
