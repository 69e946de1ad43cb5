from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from covdrift.llm.license_scan import PHRASES, TEMPLATES, labelled, longest_run, scan, template_words
from tests.llm.helpers import docs, odd_texts, words


def brute_base(text):
    found = template_words(text or "")
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(found))
        if found[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    return (len(found), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def brute_labels(text, k=3, drift=4, least=0.8):
    """Labels of templates of which some run of near diagonals holds enough k-grams."""
    found, labels = template_words(text or ""), set()
    for label, template in TEMPLATES.values():
        want = template_words(template)
        votes = sorted(
            {
                (p - q, q)
                for q in range(len(want) - k + 1)
                for p in range(len(found) - k + 1)
                if found[p : p + k] == want[q : q + k]
            }
        )
        runs = []
        for d, q in votes:
            if runs and d - runs[-1][0] <= drift:
                runs[-1][0] = d
                runs[-1][1].add(q)
            else:
                runs.append([d, {q}])
        if any(len(r[1]) >= least * (len(want) - k + 1) for r in runs):
            labels.add(label)
    return labels


def given():
    rng = random.Random(2)
    grant = TEMPLATES["mit-grant"][1].split()
    edited = grant[:8] + ["really"] + grant[8:]
    return [t for t in odd_texts() if t is None or len(t) < 5000] + [
        "Licensed under CC BY-NC 4.0.", "CC-BY cc by CC_BY", "All rights reserved. ALL RIGHTS RESERVED",
        "x\nReleased under the MIT License.\ny", words(rng, 40) + " " + " ".join(edited).title() + words(rng, 40),
        " ".join(grant[:9]), "GNU General Public License", "ccby cc bye", "Ä cc by", words(rng, 200),
    ]


def test_counts_and_labels_match_brute_force(spark):
    texts = given()
    rows = labelled(scan(docs(spark, texts))).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        base = brute_base(t)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base
        every = brute_labels(t) | set(filter(None, base[4].split(",")))
        assert r.labels == ",".join(sorted(every)) and 0 <= r.score <= 1


def test_span_of_an_edited_copy(spark):
    grant = TEMPLATES["mit-grant"][1]
    row = scan(docs(spark, ["a b " + grant.replace("charge", "charge really") + " z"])).first()
    (span,) = row.spans
    n = len(grant.split())
    assert (span.template, span.first, span.last) == ("mit-grant", 2, 2 + n)
    assert 0.8 <= span.share < 1


def chain(matches):
    """Length of the longest run of (p, q) that grows in both."""
    best = {}
    for p, q in sorted(matches):
        best[p, q] = 1 + max((n for (a, b), n in best.items() if a < p and b < q), default=0)
    return max(best.values(), default=0)


def test_longest_run_matches_brute_force(spark):
    rng = random.Random(8)
    given = [
        [(d, sorted(rng.sample(range(12), rng.randrange(1, 9)))) for d in sorted(rng.sample(range(9), rng.randrange(1, 6)))]
        for _ in range(40)
    ]
    frame = spark.createDataFrame(
        [(i, near) for i, near in enumerate(given)], "i int, near array<struct<diagonal:int,held:array<int>>>"
    )
    rows = frame.select("i", "near", longest_run(F.col("near")).alias("run")).orderBy("i").collect()
    for row, near in zip(rows, given, strict=True):
        matches = {(d + q, q) for d, held in near for q in held}
        grams = row.run.grams
        assert len(grams) == chain(matches) and grams == sorted(set(grams))
        assert (row.run.first, grams[0]) in matches and (row.run.last, grams[-1]) in matches


def test_shuffled_pieces_get_no_label_and_two_copies_give_two_spans(spark):
    grant = TEMPLATES["mit-grant"][1].split()
    pieces = [grant[i : i + 4] for i in range(0, len(grant), 4)]
    mixed = " ".join(w for piece in reversed(pieces) for w in piece)
    twice = " ".join(grant) + " and " + " ".join(grant)
    rows = scan(docs(spark, [mixed, twice])).orderBy("doc_id").collect()
    assert rows[0].spans == []
    n = len(grant)
    assert [(s.first, s.last) for s in rows[1].spans] == [(0, n - 1), (n + 1, 2 * n)]


def test_empty_table_and_repeated_rows(spark):
    assert scan(docs(spark, [])).count() == 0
    rows = labelled(scan(docs(spark, ["cc by"] * 3, ids=[None, 4, 4]))).collect()
    assert [r.labels for r in rows] == ["cc-by"] * 3 and re.match("1", str(rows[0].score))


def test_edited_notices_keep_their_label_and_other_licenses_do_not(spark):
    warranty = TEMPLATES["bsd-warranty"][1].replace("contributors as is", "authors as they are")
    lgpl = (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation"
    )
    want = {
        "Licensed under the MIT License": "mit",
        "Released under the permissive MIT License.": "mit",
        "Licensed under the Apache License v2.0": "apache-2.0",
        "Apache Software License, Version 2.0": "apache-2.0",
        "Distributed under the Apache License, Version 2.0": "apache-2.0",
        "licensed under the GNU GPL, version 3": "gpl-3.0",
        "provided under the GNU GPL, version 3": "gpl-3.0",
        "This tool is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "Licensed under the Mozilla Public License, v. 2.0": "mpl-2.0",
        "Published under CC BY-SA 4.0": "cc-by,cc-by-sa-4.0",
        warranty: "bsd",
        "This library is free software: " + lgpl: "gpl,lgpl",
        "Licensed under the GNU GPL, version 2": "",
        "Released under the house license": "",
        "Licensed under CC BY 4.0": "cc-by",
        # The same words in another order; of the second one, the end is a notice with one word put in.
        "mit license the mit under the licensed under": "",
        "alpha the mit beta licensed under the gamma mit license": "mit",
        " ".join(reversed(TEMPLATES["mit-grant"][1].split())): "",
    }
    rows = labelled(scan(docs(spark, list(want)))).orderBy("doc_id").collect()
    assert {t: r.labels for t, r in zip(want, rows, strict=True)} == want
