from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from covdrift.llm.quality_rules import RULES, Document, Rule, cascade_order, judge, passing, rule_costs
from tests.llm.helpers import docs, odd_texts, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    grams = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    copies = sum(x in lines[:i] for i, x in enumerate(lines))
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(inside),
        len(found) < 50 or 100 * len(inside) > 50 * len(found),
    )


def texts():
    rng = random.Random(11)
    odd = [t for t in odd_texts() if t is None or len(t) < 5000]
    return odd + [
        words(rng, 200), words(rng, 200, 4), "a b c " * 40, words(rng, 60).upper(), "## " + words(rng, 49) + " #" * 9,
        "\n".join(["same line of text"] * 3 + [words(rng, 90)]), "a\x1cb c\x85d " * 30, words(rng, 50), words(rng, 49),
        "\n".join([words(rng, 9)] * 2 + [words(rng, 9) for _ in range(9)]),
    ]


def test_measures_match_brute_force(spark):
    given = texts()
    rows = judge(docs(spark, given)).orderBy("doc_id").collect()
    for r, t in zip(rows, given, strict=True):
        assert (*r.measures, r.base_failed) == brute(t)
        assert r.kept == (not r.base_failed and not any(rule.rejects(Document(t)) for rule in RULES))


def test_order_changes_only_the_named_rule(spark):
    frame = docs(spark, texts())
    one = {(r.doc_id, r.kept) for r in judge(frame, order=RULES).collect()}
    two = {(r.doc_id, r.kept) for r in judge(frame, order=RULES[::-1]).collect()}
    assert one == two
    kept = passing(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in one if k}


def test_cheap_rejecting_rules_come_first(spark):
    def slow(d):
        return sum(range(20_000)) < 0

    rules = [Rule("slow", slow), Rule("never", lambda d: False), Rule("all", lambda d: True)]
    rng = random.Random(2)
    order = cascade_order(docs(spark, [words(rng, 80) for _ in range(400)]), rules)
    assert order[0].name == "all"


def test_a_rule_is_charged_what_it_adds(spark):
    # The first reads a measure that the base has made; alone it would cost far more than the second.
    def shared(d):
        return d.repeated_words >= 0

    def added(d):
        return sum(range(3_000)) > 0

    rng = random.Random(5)
    frame = docs(spark, [words(rng, 2_000) for _ in range(60)])
    for measured in (True, False):
        cost = {r["rule"]: r for r in rule_costs(frame, [Rule("added", added), Rule("shared", shared)], "text", measured).collect()}
        assert cost["shared"]["seen"] == 60
        assert cost["shared"]["seconds"] < cost["added"]["seconds"]


def test_clashing_columns(spark):
    more = {c: F.lit("theirs") for c in ("kept", "Measures", "base_failed", "failed_rule", "_verdict", "_v", "x.y")}
    frame = docs(spark, texts()).withColumns(more)
    judged, plain = judge(frame), judge(docs(spark, texts()))
    assert judged.columns == [*docs(spark, []).columns, "_verdict", "_v", "x.y", *plain.columns[-4:]]
    assert {(r.doc_id, r.kept) for r in judged.collect()} == {(r.doc_id, r.kept) for r in plain.collect()}
    assert {r["_verdict"] + r["x.y"] for r in judged.collect()} == {"theirstheirs"}
    assert passing(frame).columns == frame.columns


def test_clean_prose_stays_and_junk_goes(spark):
    rng = random.Random(1)
    clean = [words(rng, 120) for _ in range(5)]
    junk = [t.upper().replace(" ", "!! ") for t in clean] + [t.replace(" ", " | ") for t in clean]
    rows = judge(docs(spark, clean + junk)).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True] * 5 + [False] * 10


def test_empty_table(spark):
    assert judge(docs(spark, [])).count() == 0 and passing(docs(spark, [])).count() == 0
