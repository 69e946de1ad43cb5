"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word of the size contracts: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
#: Whether shuffle files are removed at the end of the query that made them.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; on one machine, where it is unset, a folder in the warehouse."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")


def fixed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder: fixed rows that survive executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder: as ``fixed``, but packed."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame) -> DataFrame:
    """``stored``; the write's own shuffle files go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, those of many steps at once.
    """
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        return stored(df)
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its place (from 0) in a total order, by a range sort: no task sees all rows.

    A row's place is its place in its range partition plus the rows of the partitions before it,
    of which there is one count per partition. ``df`` should be a written table: it is read twice.
    """
    sort = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sort.withColumn("_at", F.monotonically_increasing_id()))
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    joined = placed.withColumn("_part", part).join(starts, "_part")
    return joined.withColumn(name, F.col("_start") + at).drop("_part", "_start", "_at")


def join_split(rows: DataFrame, table: DataFrame, on: list[str], total: int, how: str = "inner", share: int = 1000) -> DataFrame:
    """``rows`` joined with ``table``, of which hot keys do not go to one task.

    ``table`` has one row per key and in ``n`` the number of rows that hold it, of ``total`` in all.
    Fewer than ``share`` keys can hold more than one in ``share`` of the rows: they are broadcast,
    and their rows stay where they are. The others are joined as usual. ``how``: inner or left.
    """
    hot = table.where(F.col("n") * share > total).drop("n")
    cold = table.where(F.col("n") * share <= total).drop("n")
    still = rows.join(F.broadcast(hot), on)
    moved = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how)
    return still.unionByName(moved)


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by their whole names, dots and backticks included."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of ``WORD`` matches; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _digest(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b): rows (node, component).

    ``component`` is the smallest node reachable. Large-star and small-star steps alternate until
    nothing moves; each step is a grouped minimum (combined before its shuffle) joined back, so a
    node with very many edges is split like any skewed join key. Every round is checkpointed.
    Nodes without an edge to another node are not returned.
    """
    pairs = fixed(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _digest(pairs)
    while before[0]:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = fixed(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        after = _digest(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
