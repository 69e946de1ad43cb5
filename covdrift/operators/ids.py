"""Consecutive ids for new rows, without sorting them all in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covdrift.operators.work import staged

# monotonically_increasing_id puts the partition in the bits above 33 and the row below them.
ROW_BITS = 33


def max_id(table: DataFrame, id_col: str = "tran_id") -> DataFrame:
    """One row: the highest id, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("max_id"))


def positions(df: DataFrame, order: Sequence[Column], name: str, before: DataFrame | None = None) -> DataFrame:
    """Add ``name`` = 1, 2, ... in a total ``order``, after as many as ``before`` (max_id) says.

    Rows are staged first, as range partitioning reads its input twice. They are partitioned and
    sorted, and their position is staged too, so a lost executor cannot shift it. Each partition's
    first number follows from the row counts of those before it: one row per partition, small
    enough to broadcast.
    """
    placed = staged(
        staged(df)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # The highest id in use stands before the first partition, as if it were that many rows.
    first = F.lit(-1).cast("bigint").alias("_part")
    start = (
        df.sparkSession.range(1).select(first, F.lit(0).cast("bigint").alias("_rows"))
        if before is None
        else before.select(first, F.col("max_id").alias("_rows"))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.unionByName(start).select("_part", F.sum("_rows").over(earlier).alias("_start"))
    row = F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + row + 1)
        .drop("_at", "_part", "_start")
    )


def assign_ids(df: DataFrame, base: DataFrame, key: str, id_col: str) -> DataFrame:
    """Add ``id_col`` = base + 1, base + 2, ... in the order of the unique ``key``."""
    return positions(df, [F.col(key).asc()], id_col, base)
