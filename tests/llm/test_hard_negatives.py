from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest

from covdrift.llm import queries
from covdrift.llm.hard_negatives import Best, Coded, _rotation, bounds, code_rows, mine

SCHEMA = "vec_id long, label int, embedding array<float>, rank int, `key` string, anchor_id long"


def brute(rows, every=100, positives=5, negatives=5, low=80, high=100):
    """rows: (vec_id, label, vector). Scored pair by pair in Python integers."""
    taking = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        taking.append((i, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for a, label, v in (r for r in taking if r[0] % every == 0):
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in taking if i != a]
        best = sorted((s, i) for s, i, other in scored if other == label)[:positives]
        for s, p in best:
            fit = sorted((t, n) for t, n, other in scored if other != label and low * -s <= 100 * -t <= high * -s)
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(fit[:negatives])]
    return sorted(out)


def vectors(rng, n, dims, labels=4):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        v = [x + rng.gauss(0, 0.6) for x in c]
        size = math.sqrt(sum(x * x for x in v))
        rows.append((i, rng.randrange(labels) if rng.random() > 0.4 else 0, [x / size for x in v]))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "k", -5) for r in rows], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dims,wave", [(64, 4096), (20, 2), (130, 3)])
def test_matches_brute_force(spark, dims, wave):
    rows = vectors(random.Random(dims), 700, dims)
    got = mine(frame(spark, rows).repartition(5), wave=wave)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows)
    assert found(got) == want and len(want) > 50


def test_odd_rows_take_no_part_or_count_as_defined(spark):
    rng = random.Random(8)
    rows = vectors(rng, 260, 16, labels=3)
    rows += [(300, 0, None), (None, 0, [0.5] * 16), (301, None, [0.5] * 16), (302, 0, [float("nan")] * 16)]
    rows += [(303, 1, [0.1] * 15 + [float("inf")]), (304, 1, [0.1] * 15 + [None]), (305, 0, []), (400, 0, [0.0] * 16)]
    rows += [(306, 1, [0.3] * 4), (-200, 2, [-0.25] * 16)]
    rows += [rows[5], rows[6]]  # repeated rows, and ties
    assert found(mine(frame(spark, rows).repartition(3))) == brute(rows)
    rows.append(rows[0])  # an anchor twice gives its rows twice
    twice = brute(rows)
    assert found(mine(frame(spark, rows))) == twice and len(twice) > len(set(twice))


def test_one_label_no_anchor_and_empty_table(spark):
    rows = [(i, 1, [1.0, float(i)]) for i in range(150)]
    assert found(mine(frame(spark, rows))) == []
    assert found(mine(frame(spark, rows[1:90]))) == []
    assert found(mine(frame(spark, []))) == []
    with pytest.raises(Exception, match="must not exceed"):
        mine(frame(spark, [(0, 1, [1e30, 0.0])])).collect()


@pytest.mark.parametrize("dims", [1, 20, 64, 200])
def test_intervals_hold_the_score(dims):
    rng = np.random.default_rng(dims)
    given = np.floor(256 * rng.normal(size=(300, dims)) * rng.exponential(size=(300, 1))).astype(np.int64)
    given[0] = 0
    rows = pd.DataFrame({"vec_id": range(300), "label": 0, "vector": [v.astype("<i8").tobytes() for v in given]})
    few, more = Coded(rows, dims, 4), Coded(rows, dims, 8)
    every = np.arange(300)
    low, high = bounds(more, every, few, every)
    exact = given @ given.T
    assert (low <= exact).all() and (exact <= high).all()
    size = np.linalg.norm(given, axis=1)
    if dims >= 20:
        assert np.median((high - low) / (np.outer(size, size) + 1)) < 0.5


def test_codes_have_the_stored_alignment():
    rng = np.random.default_rng(2)
    given = rng.normal(size=(50, 64))
    rotation = _rotation(64, 3)
    assert np.allclose(rotation @ rotation.T, np.eye(64))
    codes, alignments, _, residual, near = code_rows(given, rotation, 1)
    signs = np.where(np.unpackbits(codes[:, 0].view(np.uint8), axis=1) > 0, 1, -1) / 8
    turned = given @ rotation
    assert np.allclose((signs * turned).sum(1), alignments[:, 0])
    assert np.allclose((turned**2).sum(1), alignments[:, 0] ** 2 + residual**2)
    assert np.allclose(near, residual)


def test_best_keeps_ties_by_the_smaller_id():
    best = Best(2, 3)
    best.add(np.array([1, 1, 1]), np.array([5, 5, 4]), np.array([9, 2, 1]))
    best.add(np.array([1, 0, 1]), np.array([5, -7, 3]), np.array([4, 8, 0]))
    assert list(zip(*(a.tolist() for a in best.rows()))) == [(0, -7, 8), (1, 5, 2), (1, 5, 4), (1, 5, 9)]


def test_query_moves_the_labels_of_every_seventh_row(spark, folder):
    rows = vectors(random.Random(1), 450, 64, labels=10)
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(
        f"{folder}/embeddings.parquet"
    )
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    assert found(queries.op12_hard_negatives(spark, folder)) == brute(moved)
