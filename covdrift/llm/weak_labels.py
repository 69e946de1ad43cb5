"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on every document. They overlap and err; expectation
maximisation finds how often each is right without any true label: given accuracies, each vote
pattern has a posterior of being good; given posteriors, each labeller has its accuracies. It needs the
count of each pattern only, at most 3 ** labellers rows, over all documents.

The posteriors then label a sample of about ``TRAIN_ROWS`` different texts (the one bounded step), and
a logistic scorer on hashed word shapes is fitted to them. A text is drawn by its hash, at a chance
that grows with its copies, and weighs as many documents as it stands for: a large group of copies is
one row of the sample, and the sample does not depend on the order of tasks. The scorer judges all
documents, so texts on which labellers are silent or split are judged as well.

Features of a text: the shapes of its words ("Aa," for "Then,"), and how often a word repeats one
of the three before it, as shares of its words, hashed to ``WIDTH`` cells.

Defined cases: a text without words (null, empty, blank) has score 0 and is not kept; one of fewer
than ``MIN_WORDS`` words has score 0.5 and is kept, and takes no part in training; repeated rows
score alike; null ids are carried along; texts are read whole; other columns pass through. An
empty table, or one on which all documents look alike, gives a scorer without weights (score 0.5,
kept). Texts are read in one pass, which writes votes and features; all else reads those.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import stored
from covdrift.llm.quality_rules import Document

WIDTH = 1024
TRAIN_ROWS = 8000
EM_ROUNDS = 100
FIT_ROUNDS = 300
CACHE = 200_000
#: Fewer words are too few to judge.
MIN_WORDS = 5
GOOD, BAD, SILENT = 1, 0, 2


def _bad(share: float, least: float) -> int:
    """Bad from ``least`` on, else silent: being free of one fault says little."""
    return BAD if share >= least else SILENT


def _upper(d: Document) -> float:
    upper = len(re.findall("[A-Z]", d.text))
    return upper / max(1, upper + len(re.findall("[a-z]", d.text)))


def _letters(d: Document) -> int:
    share = len(re.findall(r"[^\W_]", d.text)) / d.word_chars
    return GOOD if share >= 0.93 else BAD if share < 0.85 else SILENT


def _sentences(d: Document) -> int:
    share = len(re.findall(r"[.?](?:\s|$)", d.text)) / len(d.words)
    return GOOD if 0.02 <= share <= 0.3 else BAD if share < 0.004 else SILENT


LABELLERS: dict[str, Callable[[Document], int]] = {
    "repetition": lambda d: _bad(d.repeated_words / len(d.words), 0.5),
    "one_word": lambda d: _bad(d.top_count / len(d.words) if len(d.words) > 20 else 0.0, 0.2),
    "symbols": lambda d: _bad(d.symbols / len(d.words), 0.1),
    "shouting": lambda d: _bad(_upper(d), 0.5),
    "exclaiming": lambda d: _bad(d.text.count("!") / len(d.words), 0.3),
    "letters": _letters,
    "sentences": _sentences,
}


class Studied(Document):
    """A document whose words are numbered once, for all measures that compare words."""

    @property
    def numbered(self) -> tuple[list[bytes], np.ndarray]:
        """The different words, and for each word the place of its own among them."""
        return self._once("numbered", self._numbered)

    def _numbered(self) -> tuple[list[bytes], np.ndarray]:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, len(self.words))
        return list(number), ids

    @property
    def top_count(self) -> int:
        return int(np.bincount(self.numbered[1], minlength=1).max())

    def _repeated(self) -> int:
        different, ids = self.numbered
        if len(ids) < 4 or len(different) == len(ids):
            return 0
        # A window found twice begins with a pair of words found twice: the others need no names.
        pairs = ids[:-1] * len(different) + ids[1:]
        _, pair, count = np.unique(pairs, return_inverse=True, return_counts=True)
        starts = np.flatnonzero(count[pair[:-1]] > 1)
        _, name, count = np.unique(pair[starts] * len(different) + ids[starts + 2], return_inverse=True, return_counts=True)
        twice = starts[count[name] > 1]
        inside = np.zeros(len(ids), bool)
        for step in range(3):
            inside[twice + step] = True
        return int(inside.sum())


def pattern_of(d: Document, votes: Sequence[Callable[[Document], int]]) -> str | None:
    """The votes of all labellers in a row; a shorter text has none."""
    return "".join(str(vote(d)) for vote in votes) if len(d.words) >= MIN_WORDS else None


def study(
    docs: DataFrame,
    labellers: Mapping[str, Callable[[Document], int]] = LABELLERS,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """(doc, h, g, n_words, pattern, cells, shares), written once: all that later steps read of a text.

    ``h`` and ``g`` name the text, ``cells`` and ``shares`` are its features that are not zero, as
    16-bit and 32-bit numbers. ``doc`` has the columns ``keep``, by default all but score and kept.
    """
    votes = tuple(labellers.values())

    @F.pandas_udf("n_words long, pattern string, cells binary, shares binary")
    def studied(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shapes = Shapes()
        for texts in batches:
            found = []
            for d in map(Studied, texts):
                cells, shares = shapes.sparse(d)
                found.append((len(d.words), pattern_of(d, votes), cells.tobytes(), shares.tobytes()))
            yield pd.DataFrame(found, columns=["n_words", "pattern", "cells", "shares"])

    columns = [c for c in docs.columns if c not in ("score", "kept")] if keep is None else keep
    body = F.col(f"`{text}`")
    thin = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        F.xxhash64(body).alias("h"),
        F.xxhash64(F.lit(1), body).alias("g"),
        studied(body).alias("s"),
    )
    return stored(thin.select("doc", "h", "g", "s.*"))


def vote_patterns(found: DataFrame) -> DataFrame:
    """(pattern, count): how many documents have each pattern of votes; shorter texts have none."""
    return found.where("pattern is not null").groupBy("pattern").count()


def estimate(counts: Mapping[str, int], rounds: int = EM_ROUNDS) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of good per pattern, and P(vote | class) as (labeller, bad or good, vote).

    Silence is an outcome like a vote: a labeller that finds one fault is silent on nearly all good
    documents, which is what makes its votes tell.
    """
    if not counts:
        return {}, np.zeros((0, 2, 3))
    patterns = sorted(counts)
    votes = np.array([[int(v) for v in p] for p in patterns])
    weight = np.array([counts[p] for p in patterns], float)
    # Start from the share of good votes: labellers are taken to be better than chance.
    good = ((votes == GOOD).sum(1) + 0.5) / ((votes != SILENT).sum(1) + 1)
    every = np.arange(votes.shape[1])
    for _ in range(rounds):
        chance = np.empty((votes.shape[1], 2, 3))
        for c, p in ((1, good), (0, 1 - good)):
            for v in (BAD, GOOD, SILENT):
                chance[:, c, v] = ((weight * p)[:, None] * (votes == v)).sum(0) + 0.5
        chance /= chance.sum(2, keepdims=True)
        prior = ((weight * good).sum() + 1) / (weight.sum() + 2)
        odds = np.log(prior / (1 - prior))
        odds = odds + (np.log(chance[every, 1, votes]) - np.log(chance[every, 0, votes])).sum(1)
        good = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(patterns, good)), chance


class Shapes:
    """Hashed features of texts; shapes of recent words are remembered, within a bound."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, {}
        self.lags = {lag: self._cell(f"lag {lag}") for lag in (1, 2, 3)}

    def _cell(self, name: str) -> int:
        return zlib.crc32(name.encode()) % self.width

    def _shape(self, word: bytes) -> int:
        if word not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            shape = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word.decode("utf-8", "replace"))
            self.known[word] = self._cell(re.sub(r"(.)\1+", r"\1", shape)[:12])
        return self.known[word]

    def sparse(self, d: Studied) -> tuple[np.ndarray, np.ndarray]:
        """The cells that are not zero, and the square roots of their shares of the words."""
        different, ids = d.numbered
        if not len(ids):
            return np.zeros(0, "<u2"), np.zeros(0, "<f4")
        cells = np.fromiter(map(self._shape, different), np.int64, len(different))
        out = np.bincount(cells, np.bincount(ids, minlength=len(different)), self.width)
        for lag in (1, 2, 3):
            out[self.lags[lag]] += np.count_nonzero(ids[lag:] == ids[:-lag])
        held = np.flatnonzero(out)
        return held.astype("<u2"), np.sqrt(out[held] / len(ids)).astype("<f4")


def fit(
    features: np.ndarray, labels: np.ndarray, rounds: int = FIT_ROUNDS, counts: np.ndarray | None = None
) -> np.ndarray:
    """Weights, bias last, of a logistic scorer on soft labels; classes count alike.

    Within its class a row counts as ``counts`` says, else as one.
    """
    weights = np.zeros(features.shape[1] + 1)
    if not len(features) or labels.max() - labels.min() < 0.5:
        return weights
    x = np.hstack([features, np.ones((len(features), 1))]).astype(np.float32)
    share = np.ones(len(labels)) if counts is None else np.array(counts, float)
    for side in (labels >= 0.5, labels < 0.5):
        if side.any():
            share[side] *= 0.5 / share[side].sum()
    speed = np.zeros_like(weights)
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-(x @ weights.astype(np.float32)).astype(float)))
        slope = (x.T @ (share * (guess - labels)).astype(np.float32)).astype(float) + 1e-5 * weights
        speed = 0.9 * speed - 4.0 * slope
        weights = weights + speed
    return weights


def drawn(found: DataFrame, rate: float) -> DataFrame:
    """(h, g, weight): the texts drawn, and how many documents each stands for.

    A text of n copies is drawn at the chance n * ``rate``, at most 1, so the expected number of texts
    is at most ``rate`` of the documents.
    """
    chance = F.least(F.lit(1.0), F.col("n") * F.lit(float(rate)))
    place = F.pmod(F.xxhash64(F.lit(2), "h", "g"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    each = found.where("pattern is not null").groupBy("h", "g").agg(F.count("*").alias("n"))
    return each.where(place < chance).select("h", "g", (F.col("n") / chance).alias("weight"))


def train(found: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights of the scorer from what ``study`` found: patterns of all, a fit on about ``rows`` texts."""
    counts = {r["pattern"]: r["count"] for r in vote_patterns(found).collect()}
    posterior, _ = estimate(counts)
    # About ``rows`` rows of numbers; a text's copies are one row before they are shuffled.
    chosen = F.broadcast(drawn(found, min(1.0, rows / max(1, sum(counts.values())))))
    one = [F.first(c).alias(c) for c in ("pattern", "cells", "shares", "weight")]
    sample = found.join(chosen, ["h", "g"]).groupBy("h", "g").agg(*one).toPandas()
    # Sums of one order: runs give equal weights.
    sample = sample.sort_values(["h", "g"])
    x = np.zeros((len(sample), WIDTH), np.float32)
    for i, (cells, shares) in enumerate(zip(sample["cells"], sample["shares"])):
        x[i, np.frombuffer(cells, "<u2")] = np.frombuffer(shares, "<f4")
    return fit(x, sample["pattern"].map(posterior).to_numpy(float), counts=sample["weight"].to_numpy(float))


def score(found: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """``doc``, ``score`` (0 to 1) and ``kept`` (score at least ``least``) of what ``study`` found."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for n_words, cells, shares in batches:
            sums = [
                weights[np.frombuffer(c, "<u2")] @ np.frombuffer(s, "<f4").astype(float) for c, s in zip(cells, shares)
            ]
            out = 1 / (1 + np.exp(-np.clip(np.array(sums, float) + weights[-1], -700, 700)))
            n = n_words.to_numpy()
            yield pd.Series(np.where(n == 0, 0.0, np.where(n < MIN_WORDS, 0.5, out)))

    result = found.select("doc", scored("n_words", "cells", "shares").alias("score"))
    return result.withColumn("kept", F.col("score") >= least)


def classify(
    docs: DataFrame,
    labellers: Mapping[str, Callable[[Document], int]] = LABELLERS,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Train on ``docs`` and score them: the columns ``keep``, by default all, with score and kept."""
    found = study(docs, labellers, text, keep)
    return score(found, train(found)).select("doc.*", "score", "kept")


def accuracy(votes: Sequence[bool], truth: Sequence[bool]) -> float:
    """Mean of the shares of good and of bad documents that are judged right."""
    v, t = np.asarray(votes, bool), np.asarray(truth, bool)
    return float((v[t].mean() + (~v[~t]).mean()) / 2)
