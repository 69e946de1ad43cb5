"""Hard-negative mining with rotated one-bit codes and deterministic residual intervals.

Vectors become integers. Each is rotated (sign flips and Hadamard transforms) and coded by
``LEVELS`` one-bit codes: the signs of what is left, stored with the code vector's alignment, which
is how much of the vector lies along it and is then taken off. Anchors have more levels. The inner
product of two vectors is estimated from the pop counts of their codes' differing bits, weighed by
the alignments. By the Cauchy-Schwarz inequality it differs from the true one by no more than the
lengths of the two residuals allow, so each pair has an interval that holds its score for certain.
Pairs whose interval cannot reach the best found so far, or a positive's window, are dropped; the
scores of all others are computed in integers. The result is therefore exact.

Anchors are a stated share of all rows, and are taken in waves of about ``WAVE``, whose bounded
arrays go to the tasks. A wave runs over all rows in blocks, without a shuffle: each task keeps the
best of its rows per anchor, and only those are ranked. The first turn finds the positives, the
second, knowing their scores, the negatives. No step groups by label, so a hot label is no matter.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no
part; a row is never a partner of a row with its own id, and repeated rows otherwise count on their
own, also as anchors; a shorter vector counts as filled up with zeros; a zero or empty vector has
score 0; an anchor without positives or negatives has no rows; an empty table gives no rows.
Components so large that scores could pass 64 bits raise ValueError. Other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covdrift.llm.common import ensure_checkpoint_dir, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score lies between these hundredths of the positive's score.
WINDOW = (80, 100)
LEVELS = 4
ANCHOR_LEVELS = 8
WAVE = 4096
SEED = 29
_ROWS, _ANCHORS = 4096, 64
_NONE = -(1 << 62)

_CODED = "vec_id long, label long, vector binary, codes binary, alignments binary, length float, residual float, near float"


def _rotation(width: int, seed: int) -> np.ndarray:
    """An orthonormal matrix: two rounds of random sign flips and a Hadamard transform."""
    hadamard = np.ones((1, 1))
    while len(hadamard) < width:
        hadamard = np.block([[hadamard, hadamard], [hadamard, -hadamard]])
    flips = np.random.default_rng([seed, width]).choice([-1.0, 1.0], (2, width))
    return (flips[0][:, None] * hadamard) @ (flips[1][:, None] * hadamard) / width


def code_rows(vectors: np.ndarray, rotation: np.ndarray, levels: int) -> tuple[np.ndarray, ...]:
    """Codes (n, levels, words), alignments (n, levels), and three lengths per row.

    They are those of the vector, of its residual, and of the residual's part in the space of the
    vectors, which is all of it unless the rotation has more dimensions than they have.
    """
    n, d = vectors.shape
    width = len(rotation)
    turned = vectors.astype(np.float64) @ rotation[:d]
    left = turned.copy()
    codes = np.zeros((n, levels, width // 64), np.uint64)
    signs = np.zeros((n, levels, width))
    for level in range(levels):
        signs[:, level] = np.where(left >= 0, 1.0, -1.0) / math.sqrt(width)
        codes[:, level] = np.packbits(left >= 0, axis=1).view(np.uint64)
        # Alignments of all codes so far at once, as codes of one vector are not orthogonal.
        mine = signs[:, : level + 1]
        gram = mine @ mine.transpose(0, 2, 1) + 1e-9 * np.eye(level + 1)
        alignments = np.linalg.solve(gram, mine @ turned[:, :, None]).astype(np.float32)
        left = turned - (alignments.transpose(0, 2, 1) @ mine)[:, 0]
    alignments = alignments[:, :, 0]
    lengths = (np.linalg.norm(x, axis=1) for x in (turned, left, left @ rotation[:d].T))
    return codes, alignments, *lengths


def _coded(vectors: DataFrame, dims: int, seed: int, levels: int) -> DataFrame:
    """The rows that take part, with integer vector and codes as bytes."""
    limit = math.isqrt((1 << 55) // max(dims, 1))
    width = _width(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation = _rotation(width, seed)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("embedding"))
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.zeros((len(sizes), dims))
            values[np.arange(dims) < sizes[:, None]] = flat  # nulls have become nan
            whole = np.isfinite(values).all(axis=1)
            values = np.floor(SCALE * values[whole])
            if len(values) and np.abs(values).max() > limit:
                raise ValueError(f"components must not exceed {limit / SCALE} in size")
            ints = values.astype("<i8")
            codes, alignments, *lengths = code_rows(ints, rotation, levels)
            rows = [np.ascontiguousarray(a.reshape(len(ints), -1)) for a in (ints, codes, alignments.astype("<f4"))]
            mine = batch.filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays(
                [
                    mine.column(0).cast(pa.int64()),
                    mine.column(1).cast(pa.int64()),
                    *(pa.array([r.tobytes() for r in a], pa.binary()) for a in rows),
                    *(pa.array(x.astype(np.float32)) for x in lengths),
                ],
                names=["vec_id", "label", "vector", "codes", "alignments", "length", "residual", "near"],
            )

    return vectors.select("vec_id", "label", "embedding").mapInArrow(run, _CODED)


def _width(dims: int) -> int:
    return max(64, 1 << max(0, dims - 1).bit_length())


class Coded:
    """Arrays of a batch of coded rows, or of a wave of anchors."""

    def __init__(self, batch: pd.DataFrame, dims: int, levels: int | None = None, seed: int = SEED):
        n, width = len(batch), _width(dims)
        self.ids, self.labels = batch["vec_id"].to_numpy(np.int64), batch["label"].to_numpy(np.int64)
        self.vectors = np.frombuffer(b"".join(batch["vector"]), "<i8").reshape(n, dims)
        if levels is None:
            self.codes = np.frombuffer(b"".join(batch["codes"]), np.uint64).reshape(n, -1, width // 64)
            self.alignments = np.frombuffer(b"".join(batch["alignments"]), "<f4").reshape(n, self.codes.shape[1])
            lengths = (batch[c].to_numpy(np.float32) for c in ("length", "residual", "near"))
        else:
            found = code_rows(self.vectors, _rotation(width, seed), levels)
            self.codes, *rest = found
            self.alignments, *lengths = (a.astype(np.float32) for a in rest)
        self.length, self.residual, self.near = lengths


def bounds(anchors: Coded, a: np.ndarray, rows: Coded, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each pair of the chosen anchors and rows."""
    bits = 64 * anchors.codes.shape[2]
    total = np.outer(anchors.alignments[a].sum(axis=1), rows.alignments[r].sum(axis=1))
    for i in range(rows.codes.shape[1]):
        differing = np.zeros(total.shape, np.float32)
        code = rows.codes[r, i]
        for j in range(anchors.codes.shape[1]):
            mine = anchors.codes[a, j]
            count = np.bitwise_count(mine[:, None, 0] ^ code[None, :, 0])
            for word in range(1, mine.shape[1]):
                count = count + np.bitwise_count(mine[:, None, word] ^ code[None, :, word]).astype(np.uint16)
            differing += count * anchors.alignments[a, j][:, None]
        total -= differing * (rows.alignments[r, i] * np.float32(2 / bits))
    length_a, residual_a, near_a = (x[a][:, None] for x in (anchors.length, anchors.residual, anchors.near))
    length_r, residual_r, near_r = (x[r] for x in (rows.length, rows.residual, rows.near))
    # What the codes leave out, and a margin for single-precision sums. With o = c + r and q = d + s,
    # <o, q> - <c, d> = <r, q> + <o, s> - <r, s>.
    gap = near_r * length_a + near_a * length_r + residual_a * residual_r
    summed = np.outer(np.abs(anchors.alignments[a]).sum(axis=1), np.abs(rows.alignments[r]).sum(axis=1))
    gap = gap * 1.0001 + 1e-5 * (length_a * length_r + summed) + 0.01
    return total - gap, total + gap


def scores(anchors: Coded, a: np.ndarray, rows: Coded, r: np.ndarray) -> np.ndarray:
    """Integer inner products of pairs."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = np.einsum("ij,ij->i", anchors.vectors[a[part]], rows.vectors[r[part]])
    return out


class Best:
    """The highest scores of each key with their ids: higher first, ties by the smaller id."""

    def __init__(self, keys: int, places: int):
        self.score = np.full((keys, places), _NONE, np.int64)
        self.id = np.zeros((keys, places), np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(key):
            return
        touched = np.unique(key)
        places = self.score.shape[1]
        keys = np.concatenate([np.repeat(touched, places), key])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((ids, -score, keys))
        keys, score, ids = keys[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        place = np.arange(len(keys)) - np.repeat(first, np.diff(np.r_[first, len(keys)]))
        stay = place < places
        self.score[keys[stay], place[stay]] = score[stay]
        self.id[keys[stay], place[stay]] = ids[stay]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, place = np.nonzero(self.score > _NONE)
        return key, self.score[key, place], self.id[key, place]


def _tiles(n: int, size: int) -> Iterator[np.ndarray]:
    return (np.arange(at, min(n, at + size)) for at in range(0, n, size))


def find_positives(anchors: Coded, batches: Iterator[Coded], places: int) -> Best:
    """Best rows of each anchor's own label."""
    best = Best(len(anchors.ids), places)
    by_label = {label: np.flatnonzero(anchors.labels == label) for label in np.unique(anchors.labels).tolist()}
    for rows in batches:
        for label, mine in by_label.items():
            same = np.flatnonzero(rows.labels == label)
            for a in (mine[t] for t in _tiles(len(mine), _ANCHORS)):
                for r in (same[t] for t in _tiles(len(same), _ROWS)):
                    low, high = bounds(anchors, a, rows, r)
                    other = anchors.ids[a][:, None] != rows.ids[r]
                    floor = best.score[a, -1].astype(np.float64)
                    if len(r) > 4 * places:
                        known = np.where(other, low, -np.inf)
                        floor = np.maximum(floor, np.partition(known, -places, axis=1)[:, -places])
                    i, j = np.nonzero(other & (high >= floor[:, None]))
                    best.add(a[i], scores(anchors, a[i], rows, r[j]), rows.ids[r[j]])
    return best


def find_negatives(
    anchors: Coded, positive: np.ndarray, batches: Iterator[Coded], places: int, window: tuple[int, int]
) -> Best:
    """Best rows of other labels in the window of each positive's score (n, positives); keys are both."""
    n, k = positive.shape
    best = Best(n * k, places)
    exists = positive > _NONE
    least = np.where(exists, window[0] * np.maximum(positive, 0) / 100, np.inf)
    most = np.where(exists, window[1] * positive / 100, -np.inf).max(axis=1, initial=-np.inf)
    for rows in batches:
        for a in _tiles(n, _ANCHORS):
            for r in _tiles(len(rows.ids), _ROWS):
                low, high = bounds(anchors, a, rows, r)
                ready = best.score.reshape(n, k, places)[a, :, -1]
                floor = np.maximum(least[a], ready).min(axis=1, initial=np.inf)
                able = (high >= floor[:, None]) & (low <= most[a][:, None])
                able &= anchors.labels[a][:, None] != rows.labels[r]
                i, j = np.nonzero(able & (anchors.ids[a][:, None] != rows.ids[r]))
                found = scores(anchors, a[i], rows, r[j])
                for p in range(k):
                    mine = positive[a[i], p]
                    inside = (mine > _NONE) & (window[0] * mine <= 100 * found) & (100 * found <= window[1] * mine)
                    best.add(a[i][inside] * k + p, found[inside], rows.ids[r[j]][inside])
    return best


def _over_rows(coded: DataFrame, dims: int, search: Callable[[Iterator[Coded]], Best]) -> DataFrame:
    """What each task finds in its own rows: (key, score, id)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, score, ids = search(Coded(b, dims) for b in batches if len(b)).rows()
        yield pd.DataFrame({"key": key, "score": score, "id": ids})

    return coded.mapInPandas(run, "key long, score long, id long")


def _ranked(found: DataFrame, places: int) -> DataFrame:
    best_first = Window.partitionBy("key").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= places)


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    wave: int = WAVE,
    seed: int = SEED,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; anchors are the ids divisible by
    ``every``.
    """
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    there = vectors.where("vec_id is not null and label is not null and embedding is not null")
    dims = there.agg(F.max(F.size("embedding"))).first()[0] or 0
    coded = stored(_coded(there, dims, seed, LEVELS))
    anchors = stored(coded.where(F.col("vec_id") % every == 0).select("vec_id", "label", "vector").withColumn(
        "anchor", F.monotonically_increasing_id()))
    waves = max(1, math.ceil(anchors.count() / wave))
    folder = f"{spark.sparkContext.getCheckpointDir()}/negatives-{uuid.uuid4().hex}"
    for number in range(waves):
        # Bounded: about ``wave`` anchors, dealt by a hash of their number.
        taken = anchors.where(F.pmod(F.xxhash64("anchor"), F.lit(waves)) == number).toPandas()
        mined = Coded(taken, dims, ANCHOR_LEVELS, seed)
        found = _over_rows(coded, dims, lambda b, mined=mined: find_positives(mined, b, positives))
        score = np.full((len(taken), positives), _NONE, np.int64)
        partner = np.zeros((len(taken), positives), np.int64)
        for row in _ranked(found, positives).collect():  # ``positives`` rows per anchor of the wave
            score[row["key"], row["rank"] - 1], partner[row["key"], row["rank"] - 1] = row["score"], row["id"]
        against = _over_rows(
            coded, dims, lambda b, mined=mined, score=score: find_negatives(mined, score, b, negatives, window)
        )
        key = np.arange(score.size)
        names = pd.DataFrame(
            {
                "key": key,
                "anchor_id": np.repeat(mined.ids, positives),
                "positive_id": partner.ravel(),
                "positive_score": score.ravel(),
            }
        )
        named = spark.createDataFrame(names, "key long, anchor_id long, positive_id long, positive_score long")
        out = _ranked(against, negatives).join(named, "key")
        out.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ).write.parquet(f"{folder}/wave={number}")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.read.schema(schema).parquet(*(f"{folder}/wave={number}" for number in range(waves)))
