from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from covdrift.llm import queries
from covdrift.llm.importance_resampling import drawn, resample
from tests.llm.helpers import docs, odd_texts, words


def grams(text, max_n):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    out = [" ".join(found[i : i + n]) for n in range(1, max_n + 1) for i in range(len(found) - n + 1)]
    return len(found), out


def brute(texts, ids, target, percent=10, max_n=1, buckets=10_000, least=20, seed=2024):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    have = [grams(t, max_n) for t in texts]
    s = Counter(bucket(g) for _, gs in have for g in gs)
    t = Counter(bucket(g) for x in target for g in grams(x, max_n)[1])
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    rows = []
    for at, (i, (n_words, gs)) in enumerate(zip(ids, have)):
        weight = sum(gain[bucket(g)] for g in gs) // len(gs) if gs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(gs), weight, score, None, n_words, at])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * percent // 100]):
        r[4] = rank + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def given():
    rng = random.Random(5)
    texts = [words(rng, rng.randrange(1, 60), 300) for _ in range(300)]
    texts += ["A-b_c;D! é9É x\x7fy " * 10, "ONE two.THREE " * 30, "İstanbul Kelvin " * 15]
    return texts + odd_texts() + ["tied words here " * 9] * 30


TARGET = ["w1 w2 w3 w4 w5 tied", None, "", "W7 w8, w9", "é9é two"]


def rows_of(df):
    columns = ("n_features", "weight", "score", "rank")
    return sorted(((r.doc.doc_id, *(r[c] for c in columns)) for r in df.collect()), key=repr)


def target(spark):
    return spark.createDataFrame([(t,) for t in TARGET], "text string")


@pytest.mark.parametrize("max_n,buckets,percent", [(1, 10_000, 10), (2, 97, 60), (3, 65_536, 100)])
def test_matches_brute_force(spark, max_n, buckets, percent):
    texts = given()
    frame = docs(spark, texts).repartition(6)
    got = rows_of(resample(frame, target(spark), percent, max_n, buckets))
    want = brute(texts, range(len(texts)), TARGET, percent, max_n, buckets)
    assert got == want and sum(r[4] is not None for r in want) > 20


def test_repeated_and_missing_ids(spark):
    texts = [words(random.Random(i % 7), 25) for i in range(60)]
    ids = [None if i % 9 == 0 else i % 20 for i in range(60)]
    got = rows_of(resample(docs(spark, texts, ids=ids).repartition(4), target(spark), 50))
    assert got == brute(texts, ids, TARGET, 50)


def test_drawn_documents_lean_to_the_target(spark):
    rng = random.Random(2)
    near = [f"goal score ball team match win play {words(rng, 2)} " * 3 for _ in range(40)]
    far = [words(rng, 90) for _ in range(360)]
    frame = docs(spark, near + far)
    wanted = spark.createDataFrame([("goal score ball team match win play " * 5000,)], "text string")
    out = drawn(frame, wanted, 20)
    assert out.columns == frame.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) == 80 and sum(i < 40 for i in ids) > 30


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], "text string")
    assert resample(docs(spark, []), target(spark)).count() == 0
    texts = given()
    frame = docs(spark, texts).selectExpr("*", "1 as score", "2 as buckets", "3 as rank", "4 as `x.y`", "5 as n_words")
    assert rows_of(resample(frame, none)) == brute(texts, range(len(texts)), [])
    with pytest.raises(ValueError):
        resample(frame, none, buckets=100_000)


def test_query_reads_the_whole_tables(spark, folder):
    texts = given()
    docs(spark, texts).write.parquet(f"{folder}/documents.parquet")
    target(spark).write.parquet(f"{folder}/benchmark.parquet")
    rows = queries.op13_importance_resampling(spark, folder).collect()
    got = sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows), key=repr)
    assert got == brute(texts, range(len(texts)), TARGET)
