"""License scan by diagonal voting; DataFrame functions only.

Texts and templates are sequences of lower-case words. Every k consecutive words of a text are
hashed and joined with the template positions of the same hash. A match of text position p and
template position q votes for the diagonal p - q: a copy of the template, even an edited one, has
its votes on one diagonal or a few neighbouring ones. Votes are added per diagonal, and a diagonal is
merged with those of the next ``DRIFT`` (for long templates as many as the words that may be missing):
no span drifts farther, however many matches lie side by side. A span is verified by its longest run
of matches that goes forward in text and template at once, by the share of the template's k-grams or
words in it: the same words in another order hold little of the template. Of spans of one template
within the reach of each other the best stays. Templates of ``SHORT`` words or fewer are matched by pairs
of words instead, and may miss the two words that one edit costs. What names the license must be
unbroken in any case (``NAMED``): an edit there makes it another license.

The template table is a parameter of a few hundred rows (``MAX_GRAMS`` at most, checked), so it is
broadcast; a document's grams only leave their task where they match. One marker per document goes
along, so texts are read once and documents without a match stay in the result.

Defined cases: null and empty texts have no words; repeated rows are documents of their own; null
ids are carried along; words are never cut off; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covdrift.llm.common import lower_ascii

K = 3
SHORT = 12
DRIFT = 4
MIN_SHARE = 0.8
MAX_GRAMS = 100_000
_ABOUT = "struct<size:int,count:int,must:array<int>>"
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases of the base, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: The notices that the licenses themselves give for use, and their labels.
TEMPLATES = {
    "mit-line": ("mit", "released under the mit license"),
    "mit-grant": (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files",
    ),
    "apache-line": ("apache-2.0", "licensed under the apache license version 2 0"),
    "gpl-line": ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    "gpl-notice": (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of "
        "the gnu general public license as published by the free software foundation",
    ),
    "bsd-grant": (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    "cc-by-nc-line": ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    "cc-by-sa-line": ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    "cc-by-sa-notice": (
        "cc-by-sa-4.0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ),
    "mit-license": ("mit", "licensed under the mit license"),
    "mit-condition": (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
    ),
    "mit-warranty": (
        "mit",
        "the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall the authors or copyright holders be liable for any claim "
        "damages or other liability whether in an action of contract tort or otherwise arising from out "
        "of or in connection with the software or the use or other dealings in the software",
    ),
    "bsd-warranty": (
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any express or "
        "implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed in no event shall the copyright holder or "
        "contributors be liable for any direct indirect incidental special exemplary or consequential "
        "damages",
    ),
    "apache-v2": ("apache-2.0", "licensed under the apache license v2 0"),
    "apache-2": ("apache-2.0", "licensed under the apache license 2 0"),
    "apache-software": ("apache-2.0", "apache software license version 2 0"),
    "apache-notice": (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
    ),
    "apache-warranty": (
        "apache-2.0",
        "unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied see the license for the specific language governing permissions and "
        "limitations under the license",
    ),
    "gpl-short": ("gpl-3.0", "licensed under the gnu gpl version 3"),
    "lgpl-notice": (
        "lgpl",
        "you can redistribute it and or modify it under the terms of the gnu lesser general public "
        "license as published by the free software foundation",
    ),
    "lgpl-line": ("lgpl", "licensed under the gnu lesser general public license"),
    "mpl-notice": (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of "
        "the mpl was not distributed with this file you can obtain one at",
    ),
    "mpl-line": ("mpl-2.0", "licensed under the mozilla public license version 2 0"),
}
#: Phrases of a template that a copy must hold word for word.
NAMED = {
    "mit-line": ["mit license"],
    "mit-license": ["mit license"],
    "apache-line": ["apache license", "2 0"],
    "apache-v2": ["apache license", "v2 0"],
    "apache-2": ["apache license", "2 0"],
    "apache-software": ["apache software license", "2 0"],
    "apache-notice": ["the apache license"],
    "gpl-line": ["gnu general public license", "version 3"],
    "gpl-short": ["gnu gpl", "version 3"],
    "gpl-notice": ["gnu general public license"],
    "lgpl-line": ["gnu lesser general public license"],
    "lgpl-notice": ["gnu lesser general public license"],
    "mpl-line": ["mozilla public license", "2 0"],
    "mpl-notice": ["mozilla public license"],
    "cc-by-nc-line": ["cc by nc 4 0"],
    "cc-by-sa-line": ["cc by sa 4 0"],
    "cc-by-sa-notice": ["attribution sharealike 4 0"],
}


def words_of(text: Column) -> Column:
    """Lower-case words: runs of digits, letters and characters beyond ASCII."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), _SPLIT)
    return F.filter(parts, lambda w: w != "")


def template_words(text: str) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(_SPLIT, lowered) if w]


def template_grams(
    spark: SparkSession,
    templates: Mapping[str, tuple[str, str]],
    k: int,
    named: Mapping[str, list[str]] = NAMED,
) -> DataFrame:
    """(gram, template, q, label, grams, about): the hashed grams of each template.

    ``about`` has the words of a gram and of the template, and the grams that must be there.
    """
    rows = []
    for name, (label, text) in templates.items():
        words = template_words(text)
        if len(words) < k:
            raise ValueError(f"template {name} has fewer than {k} words")
        size = min(k, 2) if len(words) <= SHORT else k
        grams = len(words) - size + 1
        must = set()
        for phrase in named.get(name, []):
            part = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(part)] == part]
            if not at or len(part) < size:
                raise ValueError(f"template {name} cannot be tested for {phrase}")
            must |= set(range(at[0], at[0] + len(part) - size + 1))
        about = {"size": size, "count": len(words), "must": sorted(must)}
        rows += [
            {"words": words[q : q + size], "template": name, "q": q, "label": label, "grams": grams, "about": about}
            for q in range(grams)
        ]
    if len(rows) > MAX_GRAMS:
        raise ValueError(f"{len(rows)} template grams are more than {MAX_GRAMS}")
    kind = f"array<struct<words:array<string>,template:string,q:int,label:string,grams:int,about:{_ABOUT}>>"
    frame = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))
    gram = reduce(
        lambda other, size: F.when(F.size("words") == size, _hashed("words", F.lit(0), size)).otherwise(other),
        {min(k, 2), k},
        F.lit(None).cast("long"),
    )
    return frame.select(gram.alias("gram"), "template", "q", "label", "grams", "about")


def _hashed(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + n) for n in range(size)])


def phrase_places(words: Column, phrases: Mapping[str, str]) -> Column:
    """Array of (place, label): where each phrase's words stand one after the other."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    none = F.array().cast("array<struct<place:bigint,label:string>>")

    def starting(phrase: str):
        def at(i: Column) -> Column:
            same = [F.get(words, i + k) == word for k, word in enumerate(phrase.split())]
            return F.coalesce(reduce(Column.__and__, same), F.lit(False))

        return at

    def named(label: str):
        return lambda i: F.struct(i.cast("long").alias("place"), F.lit(label).alias("label"))

    found = []
    for phrase, label in phrases.items():
        places = F.filter(F.sequence(F.lit(0), F.size(words)), starting(phrase))
        # Most texts hold no phrase: one search for it saves the walk over their words.
        seen = F.instr(joined, f" {phrase} ") > 0
        found.append(F.when(seen, F.transform(places, named(label))).otherwise(none))
    return F.concat(*found)


def longest_run(near: Column) -> Column:
    """(first, last, grams): the longest run of matches forward in text and template.

    ``near`` holds (diagonal, held) of one span. Its matches are walked by template position; of the
    runs of each length the one that ends earliest in the text is known. Later text positions of one
    template position come first, so a run holds each once. There are at most as many matches as
    diagonals in reach times grams, and as many runs as grams.
    """
    matches = F.flatten(
        F.transform(
            near,
            lambda x: F.transform(x["held"], lambda q: F.struct(q.alias("q"), (-x["diagonal"] - q).alias("back"))),
        )
    )

    def step(runs: Column, match: Column) -> Column:
        p = -match["back"]
        shorter = F.filter(runs, lambda run: run["last"] < p)
        before = F.get(shorter, F.size(shorter) - 1)
        grams = F.concat(F.coalesce(before["grams"], F.array().cast("array<int>")), F.array(match["q"]))
        run = F.struct(F.coalesce(before["first"], p).alias("first"), p.alias("last"), grams.alias("grams"))
        return F.concat(shorter, F.array(run), F.slice(runs, F.size(shorter) + 2, F.size(runs)))

    none = F.array().cast("array<struct<first:int,last:int,grams:array<int>>>")
    return F.aggregate(F.array_sort(matches), none, step, lambda runs: F.get(runs, F.size(runs) - 1))


def scan(
    docs: DataFrame,
    templates: Mapping[str, tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    k: int = K,
    drift: int = DRIFT,
    min_share: float = MIN_SHARE,
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, base, spans): phrase places, and the verified spans of each document.

    A span is (template, label, first, last, share): its first and last word in the text.
    """
    grams = template_grams(docs.sparkSession, templates, k)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col(text)).alias("words")
    )
    def rolled(size: int) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size("words") - size),
            lambda i: F.struct(i.alias("p"), _hashed("words", i, size).alias("gram")),
        )
        return F.when(F.size("words") >= size, grams).otherwise(F.array().cast("array<struct<p:int,gram:bigint>>"))

    marker = F.struct(F.lit(-1).alias("p"), F.lit(0).cast("long").alias("gram"))
    rows = rows.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        phrase_places(F.col("words"), phrases).alias("base"),
        F.concat(F.array(marker), *[rolled(size) for size in sorted({min(k, 2), k})]).alias("at"),
    )
    each = rows.select("row", "doc_id", "n_words", "base", F.explode("at").alias("at"))
    each = each.select("row", "doc_id", "n_words", F.when(F.col("at.p") < 0, F.col("base")).alias("base"), "at.p", "at.gram")
    kept = grams.sparkSession.range(1).selectExpr(
        "cast(0 as bigint) as gram", "cast(null as string) as template", "-1 as q",
        "cast(null as string) as label", "0 as grams", f"cast(null as {_ABOUT}) as about",
    )
    votes = each.join(F.broadcast(grams.union(kept)), "gram").where((F.col("p") < 0) == F.col("template").isNull())
    diagonal = F.when(F.col("p") >= 0, F.col("p") - F.col("q"))
    voted = votes.groupBy("row", "doc_id", "n_words", "template", "label", "grams", diagonal.alias("diagonal")).agg(
        F.first("base", ignorenulls=True).alias("base"),
        F.first("about").alias("about"),
        F.sort_array(F.collect_set("q")).alias("held"),
    )
    reach = F.greatest(F.lit(drift), F.ceil(F.col("about.count") * F.lit(1 - min_share)).cast("int"))
    farthest = max([drift, *(math.ceil(len(template_words(t)) * (1 - min_share)) for _, t in templates.values())])
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    line = F.struct("diagonal", "held")
    merged = voted.withColumn("near", F.collect_list(line).over(near.rangeBetween(0, farthest)))
    own = F.filter("near", lambda x: x["diagonal"] <= F.col("diagonal") + reach)
    merged = merged.withColumn("near", F.when(F.col("template").isNotNull(), own))
    # One edit costs a short notice two words at most: its own, and a neighbour that it cuts off.
    least = F.col("about.count") * F.lit(min_share)
    least = F.when(F.col("about.count") <= SHORT, F.least(least, F.col("about.count") - 2)).otherwise(least)

    def enough(grams: Column) -> Column:
        covered = F.flatten(F.transform(grams, lambda q: F.sequence(q, q + F.col("about.size") - 1)))
        return (F.size(grams) / F.col("grams") >= min_share) | (F.size(F.array_distinct(covered)) >= least)

    any_order = F.array_distinct(F.flatten(F.transform("near", lambda x: x["held"])))
    merged = merged.withColumn("any", any_order)
    whole = F.size(F.array_except("about.must", "any")) == 0
    merged = merged.withColumn("run", F.when(whole & enough(F.col("any")), longest_run(F.col("near"))))
    share = F.size("run.grams") / F.col("grams")
    span = F.struct(
        "template", "label", F.col("run.first").alias("first"),
        (F.col("run.last") + F.col("about.size") - 1).alias("last"), share.alias("share"),
    )
    rated = merged.withColumn("span", F.when(enough(F.col("run.grams")), span))
    # The best span around: the largest share, then the first.
    rank = F.when(F.col("span").isNotNull(), F.struct(F.col("span.share"), -F.col("diagonal")))
    rated = rated.withColumn("rank", rank)
    best = F.max("rank").over(near.rangeBetween(-farthest, farthest))
    spans = rated.withColumn("span", F.when(F.col("rank") == best, F.col("span")))
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.first("base", ignorenulls=True).alias("base"),
        F.array_sort(F.collect_list("span")).alias("spans"),
    ).drop("row")


def labelled(scanned: DataFrame) -> DataFrame:
    """Counts, places, labels and score of each scanned document."""
    places = F.transform("base", lambda x: x["place"])
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    more = F.transform("spans", lambda x: x["label"])
    every = F.array_sort(F.array_distinct(F.concat(base, more)))
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["share"])), F.lit(0.0))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best)
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        score.alias("score"),
    )
