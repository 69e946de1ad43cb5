from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from covdrift.llm.sharding import shard
from tests.llm.helpers import docs, odd_texts, words


def brute(rows, shards, seed=11):
    """rows: (doc_id, text, source). Every row as (doc_id, size, crc, shard, slot)."""
    parts = {}
    for doc, text, source in rows:
        data = (text or "").encode()
        mixed = hashlib.md5(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
        parts.setdefault(source, []).append((mixed, doc, len(data) + 16, zlib.crc32(data)))
    order = []
    for source, members in parts.items():
        for i, m in enumerate(sorted(members)):
            order.append(((i + 0.5) / len(members), source is None, source or "", *m))
    out = []
    n = len(order)
    for at, (_, _, _, _, doc, size, crc) in enumerate(sorted(order)):
        s = at * shards // n
        out.append((doc, size, crc, s, at - -(-s * n // shards)))
    return sorted(out)


@pytest.mark.parametrize("parts,shards", [(1, 40), (7, 9)])
def test_matches_brute_force(spark, parts, shards):
    rng = random.Random(parts)
    texts = [words(rng, rng.randrange(1, 9)) for _ in range(400)] + odd_texts()
    sources = [rng.choice(["hot", "hot", "hot", "a", "é", None]) for _ in texts]
    rows = shard(docs(spark, texts, sources).repartition(parts), shards).collect()
    got = sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows)
    assert got == brute(list(zip(range(len(texts)), texts, sources)), shards)
    counts = Counter(r.shard for r in rows)
    assert len(counts) == shards and max(counts.values()) - min(counts.values()) <= 1
    mixture = Counter((r.shard, r.source) for r in rows)
    for source, n in Counter(sources).items():
        for s in range(shards):
            assert abs(mixture[s, source] - n / shards) <= 6


def test_fewer_rows_than_shards_ties_and_empty(spark):
    assert shard(docs(spark, [])).count() == 0
    rows = shard(docs(spark, ["a", "a", "b"], ids=[5, 5, 6]), 40).collect()
    assert len({r.shard for r in rows}) == 3 and {r.slot for r in rows} == {0}
