"""Exact removal of long repeated byte strings by anchor hashing at growing lengths.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else. This is
not prefix doubling: positions are thinned before they are ranked, and a rank names its string
outright instead of pairing two ranks of half its length. What is kept of that method is that
strings are ranked at growing lengths and those that became unique drop out.

1. Of the ``GRAM``-byte strings in a window of ``LENGTH`` bytes, the one with the least hash is its
   anchor. Equal windows have equal anchors at equal offsets, so neighbouring windows share a
   position (one in some 130 is left), ranked by its ``GRAM`` bytes. Unique ones are dropped.
2. The windows of an anchor are cut into runs of ``RUN`` offsets, ranked by the bytes all windows
   of a run have in common (``LENGTH`` - ``RUN`` + 1): unique ones are dropped. A run whose windows
   are all there and whose whole stretch (``LENGTH`` + ``RUN`` - 1 bytes) is not unique is settled.
3. What is left is ranked by its ``LENGTH`` bytes, window by window, and settled. One settled run
   of each stretch takes part, as its windows may be the other place of what is left.

A rank is a hash of the string itself (64 bits where it may only drop, 128 where it removes), so
ranks need no sort across the cluster; a round is one grouped minimum and maximum of the places
that hold it, combined before the shuffle, and a join back, in which the few ranks that hold more
than a thousandth of all places are broadcast. No group is ever listed.

Equal texts are one text to the search; a text with a copy is removed whole if it has ``LENGTH``
bytes. Defined cases: null is empty; texts under ``LENGTH`` bytes keep all; repeated rows are
copies; null ids are carried along; other columns are ignored. Memory is some 60 bytes per byte
of the longest text. ``docs`` must be a stable table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import join_split, stored_alone

LENGTH = 400
GRAM = 64
RUN = 32
#: Windows handled at once when anchors are chosen; their positions fit the low bits of a hash.
CHUNK, _LOW = 1 << 19, 20
ID = ["h", "g"]


class Hashes:
    """Polynomial hashes, modulo 2 ** 64, of any stretch of one text."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: bytes, salt: int):
        rng = np.random.default_rng([salt, 400])
        table = rng.integers(1, 2**63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1, 2**62, dtype=np.int64)) * 4 + 3
        up, self.down = self._table(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[np.frombuffer(data, np.uint8)] * up[: len(data)], out=sums[1:])
        self.sums = sums

    def _table(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        known = self._powers.get(self.base)
        if known is None or len(known[0]) < n:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            known = tuple(self._power(b % 2**64, size) for b in (self.base, pow(self.base, -1, 2**64)))
            if size <= 1 << 20:
                self._powers[self.base] = known
        return known

    @staticmethod
    def _power(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(key, anchor, first window, last window) of each run of windows with one anchor."""
    out = []
    for start in range(0, len(data) - length + 1, CHUNK):
        part = data[start : start + CHUNK + length - 1]
        at = np.arange(len(part) - gram + 1)
        key = Hashes(part, 1).of(at, at + gram)
        ranked = (key >> np.uint64(_LOW) << np.uint64(_LOW)) | at.astype(np.uint64)
        best = (_sliding_min(ranked, length - gram + 1) & np.uint64((1 << _LOW) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
        last = np.concatenate([first[1:] - 1, [len(best) - 1]])
        out.append((key[best[first]].view(np.int64), best[first] + start, first + start, last + start))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def runs(data: bytes, places: np.ndarray, length: int = LENGTH, run: int = RUN) -> dict[str, np.ndarray]:
    """Runs of offsets of each place (anchor, first, last): their windows and their ranks."""
    anchor, first, last = places.T
    low, high = (anchor - last) // run, (anchor - first) // run
    each = np.repeat(np.arange(len(anchor)), high - low + 1)
    step = np.arange(len(each)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
    number = low[each] + step
    front, back = anchor[each] - number * run - run + 1, anchor[each] - number * run
    lo, hi = np.maximum(front, first[each]), np.minimum(back, last[each])
    one, two = Hashes(data, 1), Hashes(data, 2)
    salt = number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
    core = one.of(back, front + length) ^ salt
    return {
        "lo": lo,
        "hi": hi,
        "core": core.view(np.int64),
        "k1": one.of(lo, hi + length).view(np.int64),
        "k2": two.of(lo, hi + length).view(np.int64),
    }


def windows(data: bytes, places: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Every window of the places (first, last) and its rank."""
    first, last = places.T
    size = last - first + 1
    at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    one, two = Hashes(data, 1), Hashes(data, 2)
    return {
        "lo": at,
        "hi": at,
        "k1": one.of(at, at + length).view(np.int64),
        "k2": two.of(at, at + length).view(np.int64),
    }


def _named(docs: DataFrame, text: str) -> DataFrame:
    """(row, doc_id, h, g, data): the text's UTF-8 bytes and their 128-bit name."""
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", data.alias("data"))
    return rows.select(
        "row", "doc_id", F.xxhash64("data").alias("h"), F.xxhash64(F.lit(1), "data").alias("g"), "data"
    )


def _each_text(rows: DataFrame, make, schema: str) -> DataFrame:
    """Rows of ``make(bytes, places or None)`` for each text, with its name."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for r in batch.itertuples(index=False):
                made = make(bytes(r.data), r)
                made = pd.DataFrame(made)
                made.insert(0, "h", r.h)
                made.insert(1, "g", r.g)
                parts.append(made)
            if parts:
                yield pd.concat(parts, ignore_index=True)

    return rows.mapInPandas(run, f"h long, g long, {schema}")


def _repeated(rows: DataFrame, rank: list[str], place: Column) -> DataFrame:
    """The ranks that stand at two places or more, the ``least`` place, and the ``n`` rows of each."""
    seen = rows.groupBy(*rank).agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count("*").alias("n"))
    return seen.where("least <> most").drop("most")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, run: int = RUN, text: str = "text") -> DataFrame:
    """(h, g, start, stop): stretches to remove, per different text; they may overlap."""
    named = _named(docs, text).where(F.octet_length("data") >= length)

    def first(data: bytes, _row) -> dict:
        key, anchor, lo, hi = anchors(data, length, gram)
        return {"key": key, "anchor": anchor, "lo": lo, "hi": hi}

    found = stored_alone(_each_text(named.drop("row", "doc_id"), first, "key long, anchor long, lo long, hi long"))
    shared = _repeated(found, ["key"], F.xxhash64(*ID, "anchor"))
    places = join_split(found, shared, ["key"], found.count())
    places = places.select(*ID, F.struct("anchor", "lo", "hi").alias("p")).distinct()

    def listed(places: DataFrame) -> DataFrame:
        return places.groupBy(*ID).agg(F.collect_list("p").alias("places"))

    # One row of each text that has places: later steps look at no other text.
    reps = listed(places).join(named.groupBy(*ID).agg(F.min("row").alias("row")), ID)
    texts = stored_alone(named.select("row", "data").join(reps, "row").select(*ID, "data", "places"))

    def second(data: bytes, r) -> dict:
        return runs(data, np.array([(p["anchor"], p["lo"], p["hi"]) for p in r.places]), length, run)

    schema = "lo long, hi long, core long, k1 long, k2 long"
    cut = stored_alone(_each_text(texts, second, schema))
    place = F.xxhash64(*ID, "lo")
    total = cut.count()
    same = join_split(cut, _repeated(cut, ["k1", "k2"], place), ["k1", "k2"], total, "left")
    ranked = stored_alone(
        same.select(
            *ID, "lo", "hi", "core",
            F.col("least").isNotNull().alias("settled"),
            (F.col("least") == place).alias("leads"),
        )
    )
    rest = stored_alone(
        join_split(ranked.where("not settled"), _repeated(cut, ["core"], place), ["core"], total)
        .select(*ID, "lo", "hi", "core")
    )
    leads = ranked.where("settled and leads").select(rest.columns)
    leads = leads.join(rest.select("core").distinct(), "core", "left_semi")

    def third(data: bytes, r) -> dict:
        return windows(data, np.array([(p["lo"], p["hi"]) for p in r.places]), length)

    left = rest.unionByName(leads).select(*ID, F.struct("lo", "hi").alias("p"))
    again = texts.drop("places").join(listed(left), ID)
    single = stored_alone(_each_text(again, third, "lo long, hi long, k1 long, k2 long"))
    hit = join_split(single, _repeated(single, ["k1", "k2"], place), ["k1", "k2"], single.count())
    both = ranked.where("settled").select(*ID, "lo", "hi").union(hit.select(*ID, "lo", "hi"))
    return both.select(*ID, F.col("lo").alias("start"), (F.col("hi") + length).alias("stop"))


def merged(spans: list, size: int, whole: bool) -> list[tuple[int, int]]:
    """Maximal stretches that the spans cover."""
    if whole:
        return [(0, size)]
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, run: int = RUN, text: str = "text") -> DataFrame:
    """(doc_id, data, spans, kept): a document's bytes, what is removed of them, and the rest."""
    named = _named(docs, text)
    spans = repeats(docs, length, gram, run, text).distinct()
    listed = spans.groupBy(*ID).agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    copied = named.where(F.octet_length("data") >= length).groupBy(*ID).agg((F.count("*") > 1).alias("whole"))
    # Written, so that the files of this search are gone when the documents are shuffled.
    known = stored_alone(copied.join(listed, ID, "left").where(F.col("whole") | F.col("found").isNotNull()))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gone, kept = [], []
            for data, found, whole in zip(batch["data"], batch["found"], batch["whole"]):
                covered = merged([] if found is None else found, len(data), whole is True)
                at, parts = 0, []
                for start, stop in covered:
                    parts.append(data[at:start])
                    at = stop
                gone.append([{"start": s, "stop": e} for s, e in covered])
                kept.append(b"".join([*parts, data[at:]]))
            batch = batch[["doc_id", "data"]].copy()
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            batch["spans"], batch["kept"] = gone, kept
            yield batch

    rows = named.join(known, ID, "left").select("doc_id", "data", "found", "whole")
    return rows.mapInPandas(
        cut, "doc_id long, data binary, spans array<struct<start long, stop long>>, kept binary"
    )
