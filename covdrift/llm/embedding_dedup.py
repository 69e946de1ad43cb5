"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated at random (three rounds of sign flips and a fast Hadamard transform) and hashed
to the nearest signed axis. A table joins several such hashes. A vector is stored in its own bucket
of each table, and looks into ``PROBES`` more: the buckets reached by taking the next best axis
where that costs least. Two vectors of a bucket, one of them stored there, are a candidate pair and
verified by their cosine in double precision.

A table joins as many axes as give it a bucket per row, so buckets of unlike vectors do not fill up
as the rows grow. There are as many tables as find ``RECALL`` of random pairs that have just the
threshold's cosine; this is measured with the operator's own hashes when it starts.

Vectors that are equal after scaling are one, with as many copies, so a vector that a large share of
the rows repeat is verified once. Pairs never leave a bucket: it counts the links of each vector, each pair at the first bucket that
both share, and reports one edge per vector into its linked part of the bucket. Buckets of more
than ``BLOCK`` rows are cut into blocks, and pairs of blocks are buckets of their own. Buckets are
dealt to tasks and sorted there; a task verifies all small buckets of a batch at once.

Defined cases: vectors that are null, zero, or hold a null or a non-finite component link with
nothing, nor does a null label; lengths may differ and vectors of different lengths never link;
repeated rows are vectors of their own, with equal ids; an empty table gives no rows. Other
columns are ignored. All steps start from one fixed scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import components, stored

COSINE = 0.98
PROBES = 2
BLOCK = 2048
SEED = 23
#: Share of pairs at the threshold that the hashes must find, the pairs it is measured on, and the
#: most tables that are tried.
RECALL = 0.995
MEASURED = 4000
MOST_TABLES = 64
#: Larger buckets are verified one by one, by matrix products.
SMALL = 32

_HASHED = "row long, vec_id long, label long, vector binary, own array<long>, probes array<long>"
_FOUND = "row long, n long, other long"
#: Rows that agree in these are verified against each other.
BUCKET = ["label", "table", "code", "left", "right"]


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(n, d) / np.sqrt(d)


def _width(dims: int) -> int:
    return 1 << max(1, (dims - 1).bit_length())


def hash_rows(unit: np.ndarray, tables: int, axes: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Own buckets (n, tables) and probed buckets (n, tables, PROBES) of unit vectors."""
    n, d = unit.shape
    width = _width(d)
    padded = np.zeros((n, width))
    padded[:, :d] = unit
    rng = np.random.default_rng([seed, width])
    own = np.zeros((n, tables), np.int64)
    probes = np.zeros((n, tables, PROBES), np.int64)
    every = np.arange(n)
    for t in range(tables):
        best, second, loss = [], [], []
        for _ in range(axes):
            x = padded
            for _ in range(3):
                x = _hadamard(x * rng.choice([-1.0, 1.0], width))
            size = np.abs(x)
            top = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = size[every, top[:, 0]] < size[every, top[:, 1]]
            top[swap] = top[swap][:, ::-1]
            code = 2 * top + (x[every[:, None], top] < 0)
            best.append(code[:, 0])
            second.append(code[:, 1])
            loss.append(size[every, top[:, 0]] - size[every, top[:, 1]])
        base = np.zeros(n, np.int64)
        for code in best:
            base = base * 2 * width + code
        own[:, t] = base
        order = np.argsort(np.array(loss), axis=0)
        for p in range(PROBES):
            which = order[p % axes]
            value = np.zeros(n, np.int64)
            for a in range(axes):
                value = value * 2 * width + np.where(which == a, second[a], best[a])
            probes[:, t, p] = value
    return own, probes


def axes_for(rows: int, dims: int) -> int:
    """Axes per table: two, or as many as it takes to have a bucket per row; their code fits a long."""
    bits = (2 * _width(dims)).bit_length() - 1
    return min(max(2, -(-max(1, rows - 1).bit_length() // bits)), 62 // bits or 1)


def _found_by(own: np.ndarray, probes: np.ndarray, n: int) -> np.ndarray:
    """Whether rows i and n + i share a bucket, per table (n, tables)."""
    one, two = own[:n], own[n:]
    return (one == two) | (probes[:n] == two[:, :, None]).any(2) | (probes[n:] == one[:, :, None]).any(2)


def tables_for(dims: int, axes: int, cosine: float, recall: float = RECALL, seed: int = SEED) -> int:
    """Tables needed to find ``recall`` of random pairs whose cosine is just the threshold."""
    rng = np.random.default_rng([seed, dims, axes])
    one, other = rng.normal(size=(2, MEASURED, dims))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    if dims > 1:
        other -= (other * one).sum(1, keepdims=True) * one
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        other = cosine * one + np.sqrt(max(0.0, 1 - cosine**2)) * other
    else:
        other = one
    found = np.zeros(MEASURED, bool)
    for tables in (4, 8, 16, 32, MOST_TABLES):
        shared = _found_by(*hash_rows(np.concatenate([one, other]), tables, axes, seed), MEASURED)
        met = np.logical_or.accumulate(shared, axis=1).mean(axis=0)
        if (met >= recall).any():
            return int(np.argmax(met >= recall)) + 1
    return MOST_TABLES


def _hashed(vectors: DataFrame, tables: int, axes: int, seed: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups: dict[int, list[int]] = {}
            parsed: dict[int, np.ndarray] = {}
            for i, (label, vector) in enumerate(zip(batch["label"], batch["embedding"])):
                if pd.isna(label) or vector is None or not len(vector):
                    continue
                values = np.array([np.nan if v is None else v for v in vector], np.float64)
                length = np.linalg.norm(values) if np.isfinite(values).all() else 0.0
                if length > 0:
                    # Divide by the largest first: squares of very long vectors overflow.
                    values = values / np.abs(values).max()
                    parsed[i] = values / np.linalg.norm(values)
                    groups.setdefault(len(values), []).append(i)
            own: list = [None] * len(batch)
            probes: list = [None] * len(batch)
            for members in groups.values():
                mine, more = hash_rows(np.array([parsed[i] for i in members]), tables, axes, seed)
                for i, a, b in zip(members, mine, more):
                    own[i], probes[i] = a, b.ravel()
            yield pd.DataFrame(
                {
                    "row": batch["row"],
                    "vec_id": batch["vec_id"].astype("Int64"),
                    "label": batch["label"].astype("Int64"),
                    "vector": [parsed[i].tobytes() if i in parsed else None for i in range(len(batch))],
                    "own": own,
                    "probes": probes,
                }
            )

    rows = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding")
    return rows.mapInPandas(run, _HASHED)


def _first_shared(table: np.ndarray, own: np.ndarray, probes: np.ndarray, i, j, code: np.ndarray) -> np.ndarray:
    """Whether no bucket before (table, code) makes rows i and j a candidate pair."""
    fresh = np.ones(len(i), bool)
    for t in range(int(table.max(initial=-1)) + 1):
        a, b = own[i, t], own[j, t]
        a_met = (a == b) | (probes[j, t] == a[:, None]).any(axis=1)
        b_met = (a == b) | (probes[i, t] == b[:, None]).any(axis=1)
        least = np.minimum(np.where(a_met, a, code), np.where(b_met, b, code))
        fresh &= np.where(t < table, ~(a_met | b_met), (t != table) | (least == code))
    return fresh


def _near_pairs(unit: np.ndarray, starts: np.ndarray, sizes: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one bucket with the cosine; buckets lie one after the other."""
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    first, second = [], []
    # All small buckets at once: each row against the next, the next but one, ...
    for step in range(1, min(SMALL, int(sizes[sizes <= SMALL].max(initial=0)))):
        i, j = small[:-step], small[step:]
        same = bucket[i] == bucket[j]
        i, j = i[same], j[same]
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
        first.append(i[near])
        second.append(j[near])
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        rows = unit[start : start + size]
        i, j = np.nonzero(np.triu(rows @ rows.T >= cosine, 1))
        first.append(i + start)
        second.append(j + start)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def links_in(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of the rows of whole buckets, sorted by bucket: their number, and an edge per row."""
    keys = rows[BUCKET].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(rows)])
    lengths = rows["vector"].map(len).to_numpy()
    unit = np.zeros((len(rows), lengths.max() // 8))
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        unit[of, : length // 8] = np.frombuffer(b"".join(rows["vector"].iloc[of]), np.float64).reshape(len(of), -1)
    own = np.stack(rows["own"].to_numpy())
    probes = np.stack(rows["probes"].to_numpy()).reshape(len(rows), own.shape[1], -1)
    table, code, row = (rows[c].to_numpy() for c in ("table", "code", "row"))
    side, split = rows["block"].to_numpy(), (rows["left"] != rows["right"]).to_numpy()
    i, j = _near_pairs(unit, starts, sizes, cosine)
    able = (lengths[i] == lengths[j]) & (~split[i] | (side[i] != side[j]))
    able &= (own[i, table[i]] == code[i]) | (own[j, table[j]] == code[j])
    i, j = i[able], j[able]
    count = np.zeros(len(rows), np.int64)
    fresh = _first_shared(table[i], own, probes, i, j, code[i])
    copies = rows["copies"].to_numpy()
    np.add.at(count, i[fresh], copies[j[fresh]])
    np.add.at(count, j[fresh], copies[i[fresh]])
    # Smallest linked row, passed on until nothing changes: parts of the buckets.
    part = row.copy()
    while True:
        before = part.copy()
        np.minimum.at(part, i, before[j])
        np.minimum.at(part, j, before[i])
        if (part == before).all():
            break
    touched = (count > 0) | (part != row)
    return pd.DataFrame({"row": row[touched], "n": count[touched], "other": part[touched]})


def _verified(dealt: DataFrame, cosine: float) -> DataFrame:
    """``links_in`` of all buckets, a batch of whole buckets at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            # The last bucket of a batch may go on in the next; a bucket has at most two blocks.
            keys = batch[BUCKET].to_numpy()
            cut = int(np.argmax((keys == keys[-1]).all(axis=1)))
            if cut or (rest and (rest[-1][BUCKET].iloc[-1].to_numpy() != keys[-1]).any()):
                whole = pd.concat([*rest, batch.iloc[:cut]], ignore_index=True)
                rest = []
                yield links_in(whole, cosine)
            rest.append(batch.iloc[cut:])
        if rest:
            yield links_in(pd.concat(rest, ignore_index=True), cosine)

    return dealt.repartition(*BUCKET).sortWithinPartitions(*BUCKET).mapInPandas(run, _FOUND)


def link_classes(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int | None = None,
    axes: int | None = None,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    rows, dims = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    axes = axes or axes_for(rows, max(1, dims))
    tables = tables or tables_for(max(1, dims), axes, cosine, seed=seed)
    hashed = stored(_hashed(vectors, tables, axes, seed))
    same = ["label", "vector"]
    twins = (
        hashed.where("own is not null")
        .groupBy(*same)
        .agg(F.min("row").alias("one"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    member = stored(
        hashed.select("row", "vec_id", *same)
        .join(twins, same, "left")
        .select("row", "vec_id", F.coalesce("one", "row").alias("one"), F.coalesce("copies", F.lit(1)).alias("copies"))
    )
    ones = member.where("row = one").select("row", "copies")
    single = hashed.where("own is not null").join(ones, "row")
    per = F.lit(PROBES)
    codes = F.transform(
        F.sequence(F.lit(0), F.size("own") - 1),
        lambda t: F.struct(
            t.alias("table"),
            F.array_distinct(
                F.concat(F.array(F.get("own", t)), F.slice("probes", t * per + 1, per))
            ).alias("codes"),
        ),
    )
    places = (
        single.select("row", "label", F.explode(codes).alias("at"))
        .select("row", "label", "at.table", F.explode("at.codes").alias("code"))
    )
    bucket = ["label", "table", "code"]
    sizes = places.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block).cast("int")
    dealt = places.join(sizes, bucket).withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.hash("row"), F.col("blocks")))
    # A row of block b meets its own block and each other: pairs (b, x) and (x, b).
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = dealt.select("row", *bucket, "block", other).select(
        "row", *bucket, "block",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
    )
    full = tasks.join(single.select("row", "vector", "own", "probes", "copies"), "row")
    found = stored(_verified(full, cosine))
    degree = found.groupBy(F.col("row").alias("one")).agg(F.sum("n").alias("others"))
    parts = components(found.select(F.col("row").alias("a"), F.col("other").alias("b")))
    parts = parts.select(F.col("node").alias("one"), "component")
    least = member.groupBy("one").agg(F.min("vec_id").alias("least"))
    named = (
        least.join(degree, "one", "left")
        .join(parts, "one", "left")
        .select("one", "least", "others", F.coalesce("component", "one").alias("component"))
    )
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    out = member.join(named.join(first, "component").select("one", "others", "component_id"), "one")
    return out.select(
        "vec_id",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
