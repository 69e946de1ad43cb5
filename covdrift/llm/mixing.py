"""Mixing sources to target weights by pivotal dependent rounding.

A source with target T and size S takes each of its documents T / S times on average: a whole
number of copies for all, and one more copy with a fractional probability. The pivotal method
rounds those: of two documents still undecided, one random transfer raises one and lowers the
other until either is integral. Mass is moved in words, so the words a source takes stay what they
were, and each document keeps its expected number of copies.

Documents are dealt to groups by hash, whatever the file layout is. Each group leaves one undecided
document, and those meet in a reduction tree of ``FAN_IN``; the last of a source is rounded at
random. A source's words therefore miss its target by less than one document. Random numbers come
from hashes of the documents, so reruns agree.

Defined cases: null texts have size 0; documents of size 0 take nothing; a null source is one of
its own and comes last; repeated rows are rounded one by one (equal rows are interchangeable).
Other columns are ignored by ``mix`` and pass through ``mixed``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covdrift.llm.common import fixed, free_name, quoted, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
GROUP_ROWS = 256
FAN_IN = 64
SEED = 17


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``sizes`` (source, source_size, ..., one row per source) with ``target``.

    Targets share the total size by weight; one that would pass ``max_copies`` times its source
    stops there, and the excess is shared again. Sources stop in the order of size per weight, so
    one running total finds all that do. One row per source meets in one task, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long"))
    lean = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = lean.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    total, weight = F.sum("source_size").over(every), F.sum("weight").over(every)
    left = total - max_copies * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    of = weight - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # Capped if its share of what is left, with all leaner sources capped, passes its own cap.
    capped = left * F.col("weight") > max_copies * F.col("source_size") * of
    marked = weighed.withColumn("capped", capped)
    free = total - F.sum(F.when(F.col("capped"), max_copies * F.col("source_size")).otherwise(0)).over(every)
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    share = (free * F.col("weight")).cast("double") / open_weight.cast("double")
    target = F.when(F.col("capped"), (max_copies * F.col("source_size")).cast("double")).otherwise(share)
    return marked.select(*sizes.columns, target.alias("target"))


def _chance(*parts) -> float:
    """A number in [0, 1) from a hash of ``parts``."""
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little") / 2.0**64


def pivotal(items: Iterable[tuple], level: int, seed: int = SEED) -> tuple[list[tuple], tuple | None]:
    """Round items (row, key, size, chance) in order: decided (row, 0 or 1), and the undecided item."""
    decided, held = [], None
    for item in items:
        if held is None:
            held = item
            continue
        row, key, size, p = item
        other, other_key, other_size, q = held
        # Words to move until this one is 1 or the held one 0, or the other way round.
        to_one, to_none = (1 - p) * size, q * other_size
        from_one, from_none = p * size, (1 - q) * other_size
        up, down = min(to_one, to_none), min(from_one, from_none)
        if _chance(seed, level, key, other_key) * (up + down) < down:
            settled, value = to_one <= to_none, 1
            q_left, p_left = (to_none - to_one) / other_size, 1 - (to_one - to_none) / size
        else:
            settled, value = from_one <= from_none, 0
            q_left, p_left = 1 - (from_none - from_one) / other_size, (from_one - from_none) / size
        if settled:
            decided.append((row, value))
            held = (other, other_key, other_size, q_left)
        else:
            decided.append((other, 1 - value))
            held = (row, key, size, p_left)
        if held[3] <= 0 or held[3] >= 1:
            decided.append((held[0], int(held[3] >= 1)))
            held = None
    return decided, held


_STATE = "source_no long, group long, place string, row long, size long, chance double, extra long"


def _round(rows: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree: rows whose ``extra`` stays null go on to the next.

    A task reads its groups one after the other, sorted; it holds one group at a time.
    """

    def rounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for batch in batches:
            if not len(batch):
                continue
            rows = pd.concat([held, batch], ignore_index=True) if len(held) else batch
            # The last group may go on in the next batch.
            last_row = rows.iloc[-1]
            same = (rows["source_no"] == last_row["source_no"]) & (rows["group"] == last_row["group"])
            held = rows[same]
            if not same.all():
                yield _settle(rows[~same], level, last, seed)
        if len(held):
            yield _settle(held, level, last, seed)

    dealt = rows.repartition("source_no", "group")
    return dealt.sortWithinPartitions("source_no", "group", "place", "row").mapInPandas(rounded, _STATE)


def _settle(rows: pd.DataFrame, level: int, last: bool, seed: int) -> pd.DataFrame:
    extra: dict[int, int] = {}
    chance: dict[int, float] = {}
    for _, group in rows.groupby(["source_no", "group"], sort=False):
        items = zip(group["row"], group["place"], group["size"], group["chance"])
        decided, held = pivotal(items, level, seed)
        extra.update(decided)
        if held is not None and last:
            extra[held[0]] = int(_chance(seed, "last", held[1]) < held[3])
        elif held is not None:
            chance[held[0]] = held[3]
    out = rows.copy()
    out["extra"] = out["row"].map(extra).astype("Int64")
    out["chance"] = out["row"].map(chance).fillna(out["chance"])
    return out


def copies(thin: DataFrame, shares: DataFrame, seed: int = SEED) -> DataFrame:
    """``thin`` (row, doc_id, source, size) with its source's target and ``copies``, one row each.

    ``shares`` has (source, source_size, live, target); ``live`` counts documents with words.
    """
    numbered = shares.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    ).withColumn("groups", F.ceil(F.col("live") / GROUP_ROWS))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = numbered.withColumnRenamed("source", "_source")
    rows = fixed(
        thin.join(named, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("whole", F.floor(ratio))
        .withColumn("chance", ratio - F.floor(ratio))
    )
    # A document's place is a seeded hash and its id: the same for any file layout.
    hashed = F.xxhash64(F.lit(seed), "doc_id", "size")
    todo = rows.where("size > 0 and chance > 0").select(
        "source_no",
        F.pmod(hashed, "groups").alias("group"),
        F.concat_ws("/", F.hex(hashed), F.col("doc_id").cast("string")).alias("place"),
        "row",
        "size",
        "chance",
        F.lit(None).cast("long").alias("extra"),
    )
    groups, level, decided = numbered.agg(F.max("groups")).first()[0] or 1, 0, []
    while True:
        done = fixed(_round(todo, level, groups <= 1, seed))
        decided.append(done.where("extra is not null").select("row", "extra"))
        if groups <= 1:
            break
        level, groups = level + 1, -(-groups // FAN_IN)
        todo = done.where("extra is null").withColumn("group", F.expr(f"group div {FAN_IN}"))
    extra = reduce(DataFrame.union, decided)
    number = F.col("whole") + F.coalesce("extra", F.lit(0))
    return rows.join(extra, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, number).otherwise(0).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, seed: int = SEED, text: str = "text") -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copies), one per document of ``docs``.

    ``row`` is the scan's row number; ``docs`` must be a stable table.
    """
    thin = fixed(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col(text)).alias("size")
        )
    )
    sizes = thin.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("live")
    )
    return copies(thin, fixed(targets(sizes)), seed)


def mixed(docs: DataFrame, seed: int = SEED, text: str = "text") -> DataFrame:
    """``docs`` with each document repeated as often as the mix takes it."""
    row, times = free_name(docs, "_row"), free_name(docs, "_times")
    chosen = mix(docs, seed, text).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(times))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))
    return numbered.join(chosen, row).select(*quoted(docs.columns), each.alias(row)).drop(row)
