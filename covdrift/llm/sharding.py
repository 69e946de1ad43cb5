"""Sharding by proportional stratified interleaving; DataFrame functions only.

The rows of each source are put in a seeded random order; a row's fractional rank is its place in
that order over the size of its source. Sorted by fractional rank, all sources advance side by
side, so each run of consecutive rows, and each shard cut from it, holds them in their proportion.
Shards hold as many rows as can be, give or take one.

Both orders are total sorts over range partitions: a row's rank is its place in its partition plus
the rows of the partitions before it, so a source with most rows is spread like any other and no
task sees a whole source. Only ids and sizes move; texts are read once, in the scan.

Defined cases: a null source is a source of its own; null texts have 0 bytes; ties (repeated rows)
are broken by id, size and checksum, and rows alike in all of these are interchangeable; an empty
table has no shards. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covdrift.llm.common import fixed

SHARDS = 40
SEED = 11
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: ``monotonically_increasing_id`` counts rows in the lower bits, partitions above.
_ROW_BITS = 33


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted in range partitions, with ``part`` and the row's place ``at`` in it."""
    sort = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = fixed(sort.withColumn("_at", F.monotonically_increasing_id()))
    return placed.withColumns(
        {
            "part": F.shiftright("_at", _ROW_BITS),
            "at": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    ).drop("_at")


def _starts(placed: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the same ``by`` in earlier partitions, per partition; a few rows per partition."""
    sizes = placed.groupBy(*by, "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by)
    return sizes.select(
        *by, "part", "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
        F.sum("n").over(every).alias("total"),
    )


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, text: str = "text") -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot), one row per document."""
    body = F.coalesce(F.col(text), F.lit(""))
    thin = docs.select(
        "doc_id",
        "source",
        (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(body, "utf-8")).alias("text_crc32"),
    )
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    ties = ["doc_id", "size", "text_crc32"]
    order = [F.col("source").asc_nulls_last(), F.col("mixed"), *map(F.col, ties)]
    placed = _placed(thin.withColumn("mixed", shuffled), order)
    starts = _starts(placed, ["source"]).select(
        F.col("source").alias("_source"), F.col("part").alias("_part"), "first", "start", "total"
    )
    near = F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    # A source's rows are contiguous in a partition, so their places count on from the first.
    rank = (F.col("start") + F.col("at") - F.col("first") + F.lit(0.5)) / F.col("total")
    ranked = placed.join(starts, near).select(
        "doc_id", "source", "size", "text_crc32", "mixed", rank.alias("fraction")
    )
    again = _placed(
        ranked, [F.col("fraction"), F.col("source").asc_nulls_last(), F.col("mixed"), *map(F.col, ties)]
    )
    before = _starts(again.withColumn("all", F.lit(1)), ["all"]).select(
        F.col("part").alias("_part"), "start", "total"
    )
    position = F.col("start") + F.col("at")
    cut = again.join(before, F.col("part") == F.col("_part")).withColumns(
        {"position": position, "shard": F.expr(f"(start + at) * {shards} div total").cast("int")}
    )
    # The first position of shard s is ceil(s * total / shards).
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return cut.select("doc_id", "source", "size", "text_crc32", "shard", (F.col("position") - first).alias("slot"))
