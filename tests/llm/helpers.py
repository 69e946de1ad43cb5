"""Fixtures for the operators of the training-data subpackage."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size long"


def docs(spark, texts, sources=None, ids=None):
    """A documents table, with extra columns whose names clash with the operators' own."""
    rows = [
        (
            i if ids is None else ids[i],
            t,
            "en",
            None if sources is None else sources[i],
            None if t is None else len(t),
            f"extra{i}",
            -1,
        )
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts() -> list[str | None]:
    """Null, empty, blank, tied, repeated and very long texts."""
    rng = random.Random(3)
    long = words(rng, 30_000)
    return [None, "", " \n\t ", "one", "one", "a b", "x\n" * 500, long, long + " end", "É ßİ Σας \x1c z"]


def union_find(n: int, pairs) -> list[int]:
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
