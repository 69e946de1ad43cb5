"""Top-1 per key: the one ranking helper used everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], own_stage: bool = False
) -> DataFrame:
    """Keep the first row of every key under ``order``.

    Spark limits each map task to one row per key before the shuffle, so a key that holds a large
    share of the rows costs one row per task. That needs a shuffle between the input and the
    ranking. After a join on a subset of ``keys`` Spark would reuse the join's layout instead;
    ``own_stage`` packs the keys in one struct, which that layout does not satisfy, so the limit
    runs on the join output and AQE stays free to split a skewed join partition.
    """
    part = [F.struct(*keys)] if own_stage else [F.col(k) for k in keys]
    rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
