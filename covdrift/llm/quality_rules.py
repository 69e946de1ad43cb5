"""Short-circuit cascade of quality rules, ordered by what they reject per unit of cost.

Each rule looks at one document and says whether to reject it. On a sample every rule runs on
every document and is timed; the cascade then tries the rules by falling rejections per second and
stops at the first rejection. Measures that rules share (words, lines) are computed when first
asked for, and a rule is timed with those known that the cascade has before its first rule: it is
charged what it adds. What only rules share among each other is charged to each of them. The order
changes the work only: a document is kept exactly if no rule rejects it.

Words are runs of anything but ASCII white space. Defined cases: null and empty texts have no
words and fail the base; repeated rows and null ids are judged as any other; texts are read whole;
an empty table keeps the order in which the rules were given. Other columns pass through; one that
has the name of a column which ``judge`` adds is replaced by it.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covdrift.llm.common import free_name, quoted

MIN_WORDS = 50
SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Rows of the sample that times the rules, and the share of the table it is drawn from. Smaller
#: tables are drawn from at a higher share, so that all that have the rows give about as many.
SAMPLE_ROWS, SAMPLE_SHARE = 2000, 0.05
_SPACES = re.compile(r"[\x20\x09-\x0D]+")


class Document:
    """One text and the measures rules share, each computed once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._known: dict = {}

    def _once(self, name: str, make: Callable):
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    @property
    def words(self) -> list[bytes]:
        # bytes.split() splits at ASCII white space only, unlike str.split().
        return self._once("words", lambda: self.text.encode("utf-8", "surrogatepass").split())

    @property
    def word_chars(self) -> int:
        return self._once("word_chars", lambda: len(_SPACES.sub("", self.text)))

    @property
    def symbols(self) -> int:
        return self._once("symbols", lambda: len(SYMBOLS.findall(self.text)))

    @property
    def lines(self) -> list[str]:
        """Lines that hold a word."""
        return self._once("lines", lambda: [x for x in self.text.split("\n") if _SPACES.sub("", x)])

    @property
    def duplicate_lines(self) -> int:
        return self._once("duplicates", lambda: len(self.lines) - len(set(self.lines)))

    @property
    def repeated_words(self) -> int:
        """Words inside three-word windows that occur twice or more."""
        return self._once("repeated", self._repeated)

    def _repeated(self) -> int:
        n = len(self.words)
        if n < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, n)
        # Two steps of naming: a pair of words, then that pair and a third word.
        _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        _, name, count = np.unique(
            pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
        )
        twice = np.flatnonzero(count[name] > 1)
        inside = np.zeros(n, bool)
        for step in range(3):
            inside[twice + step] = True
        return int(inside.sum())

    @property
    def top_count(self) -> int:
        """Occurrences of the most frequent word."""
        return max(Counter(self.words).values(), default=0)

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < MIN_WORDS or 100 * self.repeated_words > 50 * n

    @property
    def base(self) -> tuple[int, ...]:
        """The five measures of the base."""
        return len(self.words), self.word_chars, self.symbols, self.duplicate_lines, self.repeated_words

    def again(self) -> Document:
        """The same text with the same measures known."""
        other = Document(self.text)
        other._known = dict(self._known)
        return other


@dataclass(frozen=True)
class Rule:
    """``rejects(document)`` is true for a document to drop."""

    name: str
    rejects: Callable[[Document], bool]


def _shouting(d: Document) -> bool:
    upper = len(re.findall("[A-Z]", d.text))
    return 2 * upper > upper + len(re.findall("[a-z]", d.text))


RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda d: 10 * d.symbols > len(d.words)),
    Rule("shouting", _shouting),
    Rule("exclaiming", lambda d: 3 * d.text.count("!") > len(d.words)),
    Rule("line_copies", lambda d: len(d.lines) >= 4 and 2 * d.duplicate_lines > len(d.lines)),
    Rule("one_word", lambda d: 5 * d.top_count > len(d.words)),
    Rule("long_words", lambda d: d.word_chars > 20 * len(d.words)),
)


def rule_costs(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", measured: bool = True
) -> DataFrame:
    """(rule, seconds, seen, rejected) on a bounded sample of the documents that pass the base.

    Seconds are those beyond the measures that the cascade has at its start: with ``measured`` all
    of the base, else those that the base's verdict needs.
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for words in batch["text"]:
                start = Document(words)
                if start.base_failed:
                    continue
                seen += 1
                if measured:
                    _ = start.base
                for i, rule in enumerate(rules):
                    fresh = start.again()
                    began = time.perf_counter()
                    rejected[i] += rule.rejects(fresh)
                    spent[i] += time.perf_counter() - began
        yield pd.DataFrame(
            {"rule": [r.name for r in rules], "seconds": spent, "seen": seen, "rejected": rejected}
        )

    share = min(1.0, max(SAMPLE_SHARE, SAMPLE_ROWS / max(1, docs.count())))
    sample = docs.select(F.col(text).alias("text")).sample(share, seed=7).limit(SAMPLE_ROWS)
    counted = sample.mapInPandas(measure, "rule string, seconds double, seen long, rejected long")
    return counted.groupBy("rule").agg(
        F.sum("seconds").alias("seconds"), F.sum("seen").alias("seen"), F.sum("rejected").alias("rejected")
    )


def cascade_order(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", measured: bool = True
) -> list[Rule]:
    """The rules by falling rejections per second on the sample (one row per rule is collected)."""
    cost = {row["rule"]: row for row in rule_costs(docs, rules, text, measured).collect()}

    def gain(rule: Rule) -> float:
        row = cost.get(rule.name)
        return row["rejected"] / max(row["seconds"], 1e-9) if row and row["seen"] else 0.0

    return sorted(rules, key=gain, reverse=True)


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", order: Sequence[Rule] | None = None
) -> DataFrame:
    """``docs`` with ``measures`` (the base), ``base_failed``, ``kept`` and ``failed_rule``.

    ``failed_rule`` names the rule that stopped the cascade; it depends on the order, ``kept``
    does not.
    """
    ordered = tuple(order or cascade_order(docs, rules, text))

    @F.pandas_udf(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, failed_rule string"
    )
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for words in texts:
                d = Document(words)
                base = d.base
                failed = d.base_failed
                stopped = None if failed else next((r.name for r in ordered if r.rejects(d)), None)
                rows.append((*base, failed, not failed and stopped is None, stopped))
            yield pd.DataFrame(rows, columns=_VERDICT)

    added = ["measures", *_VERDICT[5:]]
    own = [c for c in docs.columns if c.lower() not in added]
    found = free_name(docs, "_verdict")
    return docs.withColumn(found, verdict(F.col(text))).select(
        *quoted(own),
        F.struct(*[F.col(found)[c].alias(c) for c in _VERDICT[:5]]).alias("measures"),
        *[F.col(found)[c].alias(c) for c in _VERDICT[5:]],
    )


_VERDICT = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "kept", "failed_rule",
]


def passing(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that the cascade keeps, with their own columns only.

    The cascade stops at the first rejection, the base counting as its first rule.
    """
    ordered = tuple(cascade_order(docs, rules, text, measured=False))

    @F.pandas_udf("boolean")
    def keeps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            documents = map(Document, texts)
            yield pd.Series(
                [not (d.base_failed or any(r.rejects(d) for r in ordered)) for d in documents], dtype=bool
            )

    return docs.where(keeps(F.col(text)))
