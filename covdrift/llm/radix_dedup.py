"""Exact duplicates by distributed MSD radix partitioning: texts are split by successive bytes.

A group of documents is split by its next digit, a run of bytes; groups of one document leave, and
a group whose texts have ended holds equal texts. No digest decides anything. The first digit is
where a text ends (its length in bytes) with its ``HEAD`` leading bytes, so all texts of a group
end together; digit k holds the next ``WIDTH * GROWTH**k`` bytes, so the number of rounds is the
logarithm of the longest text.

* The first digit is counted before anything else is written. Only texts that share it are cut into
  digits, once, into a table partitioned by round; a round reads the digits of that round alone.
* A round joins (row, group) with its digits on the row, which is unique. Each group is dealt into
  tiles of about ``TILE`` rows by a hash of the row, and rows of a tile with the same digit become
  one row that lists them: what is then counted and joined on (group, digit) is one row per tile.
  So a group with a third of all rows is counted, named and passed on by many tasks.

Result: every row of ``docs`` as a struct ``doc`` (``keep`` names its columns, all by default) with
``keep_id`` (id of the row that stays: the largest id of the group), ``group_size`` and ``kept``.

Defined cases: a null text is empty, so null and empty texts are equal; of rows that tie in text
and id one stays; a null id loses to any other and ``keep_id`` is null only if all ids of the group
are; an empty table gives no rows. Names of the columns of ``docs`` cannot clash, being in ``doc``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import ensure_checkpoint_dir, stored

#: Leading bytes in the first digit, bytes of the second digit, and growth from digit to digit.
HEAD = 16
WIDTH = 64
GROWTH = 4
#: Rows of a group that one tile lists.
TILE = 4096


def _starts(longest: int) -> list[int]:
    """Where each digit after the first starts in a text of at most ``longest`` bytes."""
    starts, width = [], WIDTH
    at = HEAD
    while at < longest:
        starts.append(at)
        at, width = at + width, width * GROWTH
    return starts


def _digits(body: Column, starts: list[int]) -> Column:
    """The digits of ``body`` after the first, as (round, digit)."""
    ends = [*starts[1:], None]
    cut = [
        F.when(
            F.octet_length(body) > start,
            F.struct(
                F.lit(k).alias("round"),
                F.substring(body, start + 1, (1 << 31) - 1 if end is None else end - start).alias("digit"),
            ),
        )
        for k, (start, end) in enumerate(zip(starts, ends))
    ]
    return F.filter(F.array(*cut), lambda c: c.isNotNull())


def _split(rows: DataFrame) -> DataFrame:
    """(row, id, length, group, size, digit) split by the digit: (row, id, length, group, size, best).

    Groups of one row leave; ``best`` is the (id, row) that stays if the group's texts are equal.
    """
    tile = F.pmod(F.xxhash64("row"), F.ceil(F.col("size") / TILE)).alias("tile")
    member = F.struct("id", "row")
    # Written down, as it is read for the counts and again to be listed.
    tiled = stored(
        rows.groupBy("group", "digit", tile).agg(
            F.collect_list(member).alias("members"),
            F.max(member).alias("best"),
            F.min("row").alias("name"),
            F.count("*").alias("n"),
            F.max("length").alias("length"),
        )
    )
    named = (
        tiled.groupBy("group", "digit")
        .agg(F.min("name").alias("next"), F.sum("n").alias("total"), F.max("best").alias("keep"))
        .where("total > 1")
    )
    listed = tiled.join(named, ["group", "digit"]).select(
        F.explode("members").alias("m"), "length", "next", "total", "keep"
    )
    return listed.select(
        "m.row", "m.id", "length", F.col("next").alias("group"), F.col("total").alias("size"),
        F.col("keep").alias("best"),
    )


def classes(
    docs: DataFrame, text: str = "text", id: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """(doc, keep_id, group_size, kept), one row per row of ``docs``."""
    spark = docs.sparkSession
    body = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "utf-8")
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    whole = docs.select(F.struct(*kept).alias("doc"), F.col(f"`{id}`").alias("id"), body.alias("body")).select(
        "doc", "id", "body", F.octet_length("body").alias("length"), F.substring("body", 1, HEAD).alias("head")
    )
    first = whole.groupBy("length", "head").agg(F.count("*").alias("size"))
    first = stored(first.where("size > 1").withColumn("group", -F.monotonically_increasing_id() - 1))
    alone = whole.join(first, ["length", "head"], "left_anti").select(
        "doc",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    longest = first.agg(F.max("length")).first()[0]
    if longest is None:
        return alone
    starts = _starts(longest)

    # One scan writes what later steps read: round -1 has the document and the group of its first
    # digit, round k its digit k. Row numbers are made by this scan alone.
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/digits-{uuid.uuid4().hex}"
    head = F.struct(F.lit(-1).alias("round"), F.lit(None).cast("binary").alias("digit"))
    numbered = whole.join(first, ["length", "head"]).withColumn("row", F.monotonically_increasing_id())
    pieces = numbered.select(
        "row", "id", "doc", "group", "size", "length",
        F.explode(F.concat(F.array(head), _digits(F.col("body"), starts))).alias("piece"),
    )
    only_head = {c: F.when(F.col("piece.round") == -1, F.col(c)).alias(c) for c in ("doc", "id", "group", "size", "length")}
    pieces.select("row", *only_head.values(), "piece.*").write.partitionBy("round").option(
        "compression", "zstd"
    ).parquet(path)
    table = spark.read.parquet(path)
    heads = table.where("round = -1")

    # Texts that end within a digit that their group shares are equal.
    rows = heads.select("row", "id", "length", "group", "size")
    found = stored(_split(rows.where(F.col("length") <= HEAD).withColumn("digit", F.lit(0))))
    active = rows.where(F.col("length") > HEAD)
    for k, end in enumerate([*starts[1:], longest] if starts else []):
        digits = table.where(F.col("round") == k).select("row", "digit")
        split = stored(_split(active.join(digits, "row")))
        found = found.union(split.where(F.col("length") <= end))
        active = split.drop("best").where(F.col("length") > end)
    grouped = heads.select("row", "doc", "id").join(found.select("row", "size", "best"), "row", "left")
    together = grouped.select(
        "doc",
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("best").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
    )
    return alone.union(together)


def keep_one(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    return classes(docs, text, id).where("kept").select("doc.*")
