"""SimHash near-duplicates: exact Hamming links found with a pivot distance table.

A document's fingerprint takes the majority bit of the hashes of its word shingles. Fingerprints
link at ``BITS`` or fewer differing bits. Documents with equal fingerprints are one class, so the
join sees each distinct fingerprint once.

* The pivot table holds each fingerprint's Hamming distance to sixteen reference fingerprints. By
  the triangle inequality a pair is at least as far apart as its largest coordinate difference.
* Candidates: a distance is put into a cell of four. A partner's distance is at most two away, so
  it lies in the own cell or in the nearer neighbour. The 64 bits are also cut into four blocks, of
  which two differing bits leave two alike. A fingerprint is indexed by two blocks and its cell of
  the first pivot, and looked for by the same blocks and both cells. Pairs with a larger coordinate
  difference than the threshold are discarded, survivors are verified bit by bit.
* A row meets the index rows of its key. The rows of a key with more than ``HOT`` index rows are
  dealt again, by the cells of the next ``FINER`` pivots as well.
* Keys that are still as large never emit pairs. Their members list themselves
  and their 64 one-bit neighbours: two of them are within two bits exactly if a listed value is
  common. A value has at most 65 members, and all are linked to its smallest.

Defined cases: null and empty texts, and texts without a word, have fingerprint zero and link as
any other; repeated rows are documents of one class; a null doc_id never becomes a component id
unless all of the class are null. Columns other than doc_id and the text are ignored. ``docs``
must be a stable table: ``near_duplicates`` scans it twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations, product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import components, fixed, free_name

BITS = 2
BLOCKS = 4
HOT = 64
PIVOTS = 16
#: Width of a pivot cell, twice ``BITS``; pivots that deal the rows of a hot key again.
CELL = 4
FINER = range(1, 5)
_COUNT_ROWS = 1 << 15


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the word shingles of a text; a text of fewer words is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if len(words) < shingle:
        grams = [b" ".join(words)] if words else []
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    return np.fromiter(map(digest, grams), np.uint64)


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text as an unsigned 64-bit number."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _COUNT_ROWS):
        part = hashes[at : at + _COUNT_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint as a bigint with the same bits."""

    @F.pandas_udf("long")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64))

    return column(text)


def _reference(i: int) -> int:
    """Reference fingerprint ``i``: a fixed pseudo-random value, as a signed long."""
    value = xxhash.xxh64_intdigest(b"reference %d" % i, seed=42)
    return value - (1 << 64) if value >> 63 else value


def pivot_table(fps: DataFrame) -> DataFrame:
    """Add ``d0`` and ``d1``: distances to the references, eight to a long."""
    for half in range(PIVOTS // 8):
        packed = F.lit(0).cast("long")
        for i in range(8):
            distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(_reference(8 * half + i))))
            packed = packed.bitwiseOR(F.shiftleft(distance.cast("long"), 8 * i))
        fps = fps.withColumn(f"d{half}", packed)
    return fps


def _distance(pivot: int, side: str = "") -> Column:
    """Distance to one reference, out of the table's columns."""
    return F.shiftrightunsigned(f"{side}d{pivot // 8}", 8 * (pivot % 8)).bitwiseAND(F.lit(255))


def _within(bits: int) -> Column:
    """No coordinate of the two rows' pivot distances differs by more than ``bits``."""
    return F.greatest(*[F.abs(_distance(i, "x.") - _distance(i, "y.")) for i in range(PIVOTS)]) <= bits


def _cells(pivot: int) -> tuple[Column, Column]:
    """The own cell of a distance, and the one neighbour that ``BITS`` differing bits can reach."""
    distance = _distance(pivot)
    own = F.floor(distance / CELL)
    return own, own + F.when(distance % CELL < BITS, -1).otherwise(1)


def _cell_keys(keyed: DataFrame, pivots: Iterable[int]) -> DataFrame:
    """``keyed`` (fp, d0, d1, key, probe) with finer keys: the own cells, and for the probes all others.

    The row with the own cells of an index row is an index row again; it is met by all.
    """
    ways = list(product(*map(_cells, pivots)))
    finer = [
        F.struct(F.xxhash64("key", *way).alias("key"), (F.col("probe") | F.lit(i > 0)).alias("probe"))
        for i, way in enumerate(ways)
    ]
    each = keyed.withColumn("k", F.explode(F.array(*finer)))
    return each.select("fp", "d0", "d1", "k.key", "k.probe")


def _block_keys() -> Column:
    """The two-block keys of ``fp``: which blocks, and their bits."""
    width = 64 // BLOCKS
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - BITS)):
        key = F.lit(number).cast("long")
        for block in chosen:
            part = F.shiftrightunsigned("fp", block * width).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def _shared(keyed: DataFrame) -> DataFrame:
    """The rows of keys under which an index row meets another fingerprint; ``n`` counts its index rows."""
    size = keyed.groupBy("key").agg(
        F.count_if(~F.col("probe")).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")
    )
    return fixed(keyed.join(size.where("n > 0 and lo < hi").select("key", "n"), "key"))


def _pairs(keyed: DataFrame, hot: int) -> DataFrame:
    """Pairs (a, b) within ``BITS`` bits that share a small key, the smaller value by an index row."""
    few = keyed.where(F.col("n") <= hot)
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
    return (
        few.where("not probe")
        .alias("x")
        .join(few.alias("y"), met)
        .where(_within(BITS))
        .where(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= BITS)
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct ``fp`` values within ``BITS`` bits.

    Every linked pair of a small key is returned; members of a hot key are linked through stars.
    """
    table = pivot_table(fps.select("fp"))
    blocks = table.withColumn("key", F.explode(_block_keys())).withColumn("probe", F.lit(False))
    coarse = _shared(_cell_keys(blocks, [0]))
    fine = _shared(_cell_keys(coarse.where(F.col("n") > hot).drop("n"), FINER))
    pairs = _pairs(coarse, hot).union(_pairs(fine, hot))
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    near = (
        fine.where(F.col("n") > hot)
        .select("fp")
        .distinct()
        .withColumn("value", F.explode(F.concat(F.array("fp"), flips)))
    )
    least = near.groupBy("value").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = near.join(least, "value").select(F.col("fp").alias("a"), "b").where("a <> b")
    return pairs.union(stars).distinct()


def classes(docs: DataFrame, text: str = "text", hot: int = HOT) -> DataFrame:
    """Rows (row, doc_id, fp, component_id), one per document, fixed in the checkpoint folder.

    ``row`` is the scan's row number; ``component_id`` the smallest doc_id reachable by links.
    """
    thin = fixed(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", fingerprint(F.col(text)).alias("fp")
        )
    )
    fps = thin.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(fps, hot))
    group = fps.join(found, fps.fp == found.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    group = fixed(group)
    first = group.groupBy("component").agg(F.min("least").alias("component_id"))
    named = group.join(first, "component").select("fp", "component_id", "component")
    return thin.join(named, "fp")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) for every document."""
    return classes(docs, text).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the smallest doc_id, nulls last."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = classes(docs, text).groupBy("component").agg(F.min(order).alias("best"))
    row = free_name(docs, "_row")
    chosen = best.select(F.col("best.row").alias(row))
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    return numbered.join(chosen, row, "left_semi").drop(row)
