"""Importance resampling towards a target: hashed word n-grams found by overlapped regex scanning.

A text is lower-cased (A-Z) and its separators are collapsed to single spaces. For each n, a regex
of n words, bounded by lookarounds, is run with overlapped matches, so its matches are exactly the
n-gram spans; the CRC of a span's bytes gives its bucket. One pass over the texts writes the bucket
numbers of each document, two bytes a feature; counts, weights and the draw read only those.

A bucket's gain is the log ratio of its smoothed shares in the target and in the documents; a
document's weight is the mean gain of its features. Adding seeded Gumbel noise and taking the
highest scores draws without replacement, in proportion to the exponential of the weights. The
highest scores are numbered by a range sort.

Broadcast or collected: counts and gains of the ``buckets`` buckets, whatever the data's size.

Defined cases: null texts, and texts without a word, have no features and weight 0; a text of fewer
than n words has no n-gram; repeated rows are drawn on their own, and rows that tie in score and id
are told apart by their row number; a null id is hashed as an empty one and comes last of its
score; an empty target gives gains from the documents alone; an empty table gives no rows. Columns
of ``docs`` are in ``doc`` and cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import numbered, stored

MAX_N = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

#: Bytes that are no part of a word: ASCII without digits and (after lower-casing) a-z.
_SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _ngrams(n: int) -> regex.Pattern:
    """Runs of ``n`` words that begin and end at a boundary."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def scan(text: str | None, separators: regex.Pattern, ngrams: list[regex.Pattern], buckets: int) -> list[np.ndarray]:
    """Buckets of a text's n-grams, one array per n."""
    spaced = separators.sub(b" ", text.encode("utf-8").lower()) if text else b""
    crc = zlib.crc32
    found = ([crc(m[0]) for m in grams.finditer(spaced, overlapped=True)] for grams in ngrams)
    return [(np.array(crcs, np.int64) % buckets).astype(np.uint16) for crcs in found]


def features(text: Column, max_n: int = MAX_N, buckets: int = BUCKETS) -> Column:
    """(n_words, n_features, buckets) of a text; the buckets are little-endian 16-bit numbers."""
    if not 1 <= buckets <= 1 << 16:
        raise ValueError("buckets must lie between 1 and 65536")

    @F.pandas_udf("n_words long, n_features long, buckets binary")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        separators, ngrams = regex.compile(_SEPARATORS), [_ngrams(n) for n in range(1, max_n + 1)]
        for texts in batches:
            found = [scan(t, separators, ngrams, buckets) for t in texts]
            yield pd.DataFrame(
                {
                    "n_words": np.array([len(f[0]) for f in found], np.int64),
                    "n_features": np.array([sum(map(len, f)) for f in found], np.int64),
                    "buckets": [b"".join(a.astype("<u2").tobytes() for a in f) for f in found],
                }
            )

    return column(text)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: counted per task, then summed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["buckets"]), "<u2"), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    summed = found.select("buckets").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in summed.collect():  # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the target's to the source's smoothed share, per bucket, in thousandths."""
    k = len(source)
    all_source, all_target = int(source.sum()) + k, int(target.sum()) + k
    return np.array(
        [math.floor(1000 * math.log((t + 1) * all_source / ((s + 1) * all_target))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def _mean_gain(buckets: Column, gain: np.ndarray) -> Column:
    @F.pandas_udf("long")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [gain[np.frombuffer(b, "<u2")] for b in batch]
            yield pd.Series(np.array([int(g.sum()) // len(g) if len(g) else 0 for g in found], np.int64))

    return column(buckets)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    text: str = "text",
    id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """(doc, n_features, weight, score, rank), one row per document; ``rank`` is null if not drawn.

    ``doc`` holds the columns ``keep`` of the document, by default all. ``target`` has a column
    ``text``. Of the documents with ``min_words`` words or more, ``percent`` in a hundred are drawn.
    """
    kept = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    thin = docs.select(
        F.struct(*kept).alias("doc"),
        F.col(f"`{id}`").alias("id"),
        features(F.col(f"`{text}`"), max_n, buckets).alias("f"),
        F.monotonically_increasing_id().alias("row"),
    )
    found = stored(thin.select("doc", "id", "row", "f.*"))
    wanted = target.select(features(F.col("text"), max_n, buckets).alias("f")).select("f.buckets")
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    weighed = found.select(
        "doc", "id", "row", "n_words", "n_features", _mean_gain(F.col("buckets"), gain).alias("weight")
    )
    scored = stored(weighed.withColumn("score", F.col("weight") + noise))
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()]
    placed = numbered(able, order, "place").withColumn("rank", F.when(F.col("place") < drawn, F.col("place") + 1))
    columns = ["doc", "n_features", "weight", "score", "rank"]
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.select(*columns).union(rest.select(*columns))


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **options) -> DataFrame:
    """The drawn documents, with all their columns."""
    return resample(docs, target, percent, **options).where("rank is not null").select("doc.*")
