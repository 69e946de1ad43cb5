from __future__ import annotations

import random
import time
from collections import Counter

import pytest

from covdrift.llm.common import SHUFFLES_GO
from covdrift.llm.suffix_dedup import Hashes, anchors, remove_repeats
from tests.llm.helpers import docs, odd_texts, words


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans, at = [], None
        for i, x in enumerate([*gone, 0]):
            if x and at is None:
                at = i
            elif not x and at is not None:
                spans.append((at, i))
                at = None
        out.append((d, spans, bytes(b for b, x in zip(d, gone) if not x)))
    return out


@pytest.mark.parametrize("length,gram,run", [(40, 8, 8), (60, 20, 7)])
def test_matches_brute_force(spark, length, gram, run):
    rng = random.Random(length)
    passages = [words(rng, 25) for _ in range(4)]
    texts = [
        words(rng, rng.randrange(0, 30)) + rng.choice(passages) + words(rng, rng.randrange(0, 30)) for _ in range(40)
    ]
    texts += ["ab" * 200, "ab" * 60 + "c", "x" * 300, "éß" * 40, *[t for t in odd_texts() if t is None or len(t) < 999]]
    # One place of a settled stretch is needed by a shorter repeat elsewhere.
    texts += [passages[0] + " " + passages[1], passages[0][5:60], texts[0], texts[0]]
    rows = remove_repeats(docs(spark, texts), length, gram, run).orderBy("doc_id").collect()
    for r, (data, spans, kept) in zip(rows, brute(texts, length), strict=True):
        assert bytes(r.data) == data
        assert [(s.start, s.stop) for s in r.spans] == spans
        assert bytes(r.kept) == kept


def test_every_window_has_one_anchor_and_equal_windows_agree():
    rng = random.Random(1)
    data = words(rng, 300).encode()
    data += data[100:700]
    key, anchor, first, last = anchors(data, 90, 16)
    assert first[0] == 0 and last[-1] == len(data) - 90 and (first[1:] == last[:-1] + 1).all()
    offset = {p: a - p for a, f, e in zip(anchor, first, last) for p in range(f, e + 1)}
    assert all(0 <= o <= 90 - 16 for o in offset.values())
    places: dict[bytes, set] = {}
    for p, o in offset.items():
        places.setdefault(data[p : p + 90], set()).add(o)
    assert all(len(o) == 1 for o in places.values())


def test_equal_stretches_hash_alike():
    import numpy as np

    hashes = Hashes(b"abcabcabd" * 20, 1)
    at = np.arange(0, 100)
    got = hashes.of(at, at + 12)
    text = b"abcabcabd" * 20
    assert len(set(got.tolist())) == len({text[i : i + 12] for i in at})


def test_empty_table_and_null_ids(spark):
    assert remove_repeats(docs(spark, []), 40, 8, 8).count() == 0
    rows = remove_repeats(docs(spark, ["y" * 50, "y" * 50], ids=[None, None]), 40, 8, 8).collect()
    assert [bytes(r.kept) for r in rows] == [b"", b""]


def test_steps_leave_no_shuffle_files_behind(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {name for name in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}

    rng = random.Random(3)
    passage = words(rng, 25)
    table = docs(spark, [words(rng, 5 + n) + passage + words(rng, 9) for n in range(12)])
    before, setting = shuffled(), spark.conf.get(SHUFFLES_GO)
    cut = remove_repeats(table, 40, 8, 8)  # all steps but the last run here
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)  # files are removed in the background
    assert not shuffled() - before
    assert spark.conf.get(SHUFFLES_GO) == setting
    assert cut.where("size(spans) > 0").count() == 12
