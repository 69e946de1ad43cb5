from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from covdrift.llm.simhash import keep_one, links, near_duplicates, simhash
from tests.llm.helpers import docs, odd_texts, union_find, words


def brute(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    grams = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def given():
    rng = random.Random(6)
    base = words(rng, 400)
    near = [base.replace(f" w{rng.randrange(3000)} ", " x ", 1) + f" t{i}" for i in range(40)]
    return odd_texts() + [base, base.upper(), base] + near + [words(rng, 30) for _ in range(40)]


@pytest.mark.parametrize("hot", [2, 64])
def test_classes_match_all_pairs(spark, hot):
    texts = given()
    prints = [brute(t) for t in texts]
    assert prints == [simhash(t) for t in texts]
    roots = union_find(
        len(texts), [(i, j) for i, a in enumerate(prints) for j in range(i) if (a ^ prints[j]).bit_count() <= 2]
    )
    rows = near_duplicates(docs(spark, texts)).orderBy("doc_id").collect()
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == roots


@pytest.mark.parametrize("hot", [2, 1000])
def test_links_connect_what_all_pairs_connect(spark, hot):
    rng = random.Random(hot)
    values = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(v - (v >> 63 << 64) for v in values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    at = {v: i for i, v in enumerate(values)}
    got = union_find(len(values), [(at[r.a], at[r.b]) for r in links(frame, hot).collect()])
    near = [
        (i, j)
        for i, a in enumerate(values)
        for j in range(i)
        if ((a ^ values[j]) & (2**64 - 1)).bit_count() <= 2
    ]
    assert got == union_find(len(values), near)
    if hot > 2:
        assert {(at[r.a], at[r.b]) for r in links(frame, hot).collect()} == {(j, i) for i, j in near}


def test_one_of_each_class_stays(spark):
    frame = docs(spark, given() + ["same words here"] * 3, ids=[*range(len(given())), 500, None, 500]).coalesce(2)
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    assert sum(r.text == "same words here" for r in rows) == 1
    assert len(rows) == near_duplicates(frame).select("component_id").distinct().count()
    assert {r.doc_id for r in rows} == {r.component_id for r in near_duplicates(frame).collect()}


def test_crowded_blocks_fall_apart_by_pivot_cells(spark):
    # All values share two blocks, so only the pivots tell them apart; some are two bits from another.
    rng = random.Random(4)
    values = {rng.getrandbits(32) for _ in range(600)}
    values |= {v ^ 1 << rng.randrange(32) ^ 1 << rng.randrange(32) for v in sorted(values)[:60]}
    frame = spark.createDataFrame([(v,) for v in sorted(values)], "fp long")
    got = {(r.a, r.b) for r in links(frame, 60).collect()}
    assert got == {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}


def test_clashing_columns_pass_through(spark):
    frame = docs(spark, given()).withColumns({"_row": F.lit("a"), "_ROW ": F.lit("b"), "x.y": F.lit("c")})
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    assert {(r["_row"], r["_ROW "], r["x.y"]) for r in kept.collect()} == {("a", "b", "c")}


def test_empty_table(spark):
    assert near_duplicates(docs(spark, [])).count() == 0 and keep_one(docs(spark, [])).count() == 0
