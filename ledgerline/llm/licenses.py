"""License scan with a positional index of rare words.

For every word of the license templates the inverse document frequency is counted over all texts.
The index holds, of each template by itself, the half of its words, at most ``ANCHORS``, that are rarest
by it, with their places. A file's words are looked up in it; a template is met where they stand at the
same distances as in the template, that is, where place in file minus place in template is one
number. A meeting counts if half of the template's index words, by weight, and all its mandatory
phrases stand there at the same shift. Weights are whole numbers, so a share is the same in every
run.

Null and empty texts have no words, no labels and score 0. Repeated rows and null ids each give a
row of their own. An empty table gives an empty result. Only the
named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import written
from .words import alnum_words, whole

# Phrases that are labels by themselves.
BASE = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Opening words of public licenses and usual notices: label, words, mandatory phrases.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    ("mit", "released under the mit license", ("released under the mit license",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
        ("gnu general public license",),
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of"
        " the gnu general public license as published by the free software foundation",
        ("redistribute it and or modify it", "gnu general public license"),
    ),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("mpl", "mozilla public license version 2 0", ("mozilla public license",)),
    ("mpl", "mozilla public license", ("mozilla public license",)),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    (
        "cc-by",
        "creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    (
        "cc-by-sa",
        "creative commons attribution sharealike 4 0 international license",
        ("creative commons attribution sharealike",),
    ),
    (
        "cc-by-nc",
        "creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of"
        " conditions and the following disclaimer",
        ("redistributions of source code must retain",),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ("permission to use copy modify",),
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    ("mit", "mit licence", ("mit licence",)),
    (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the software",
        ("permission notice shall be included in all copies",),
    ),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of"
        " the license at http www apache org licenses license 2 0",
        ("compliance with the license", "apache org licenses license 2 0"),
    ),
    ("apache", "apache software license", ("apache software license",)),
    (
        "gpl",
        "gnu general public license version 2 june 1991",
        ("gnu general public license version 2",),
    ),
    (
        "gpl",
        "gnu general public license version 3 29 june 2007",
        ("gnu general public license version 3",),
    ),
    ("epl", "eclipse public license", ("eclipse public license",)),
    ("cddl", "common development and distribution license", ("development and distribution license",)),
    ("eupl", "european union public licence", ("european union public licence",)),
    ("artistic", "the artistic license 2 0", ("artistic license 2 0",)),
    ("ofl", "licensed under the sil open font license", ("sil open font license",)),
    ("boost", "boost software license version 1 0", ("boost software license",)),
    (
        "boost",
        "permission is hereby granted free of charge to any person or organization obtaining a copy"
        " of the software and accompanying documentation covered by this license",
        ("person or organization obtaining", "accompanying documentation covered by this license"),
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will"
        " the authors be held liable for any damages arising from the use of this software",
        ("event will the authors be held liable",),
    ),
    *(
        (label, f"spdx license identifier {name}", (f"spdx license identifier {name}",))
        for label, name in (
            ("mit", "mit"),
            ("apache", "apache 2 0"),
            ("gpl", "gpl 2 0"),
            ("gpl", "gpl 3 0"),
            ("lgpl", "lgpl 2 1"),
            ("lgpl", "lgpl 3 0"),
            ("agpl", "agpl 3 0"),
            ("mpl", "mpl 2 0"),
            ("bsd", "bsd 2 clause"),
            ("bsd", "bsd 3 clause"),
            ("isc", "isc"),
            ("unlicense", "unlicense"),
            ("epl", "epl 2 0"),
            ("boost", "bsl 1 0"),
            ("zlib", "zlib"),
            ("cc0", "cc0 1 0"),
        )
    ),
)

ANCHORS = 8
WEIGHT = 1_000_000


class Index:
    """The template table: bounded by its text, not by the data."""

    def __init__(self, templates=TEMPLATES, base=BASE):
        self.labels = [label for label, *_ in templates]
        self.words = [text.split() for _, text, _ in templates]
        self.base = [(phrase.split(), label) for phrase, label in base]
        self.phrases = [words for words, _ in self.base]
        self.mandatory = []
        for words, (_, _, phrases) in zip(self.words, templates):
            keys = []
            for phrase in map(str.split, phrases):
                place = next(
                    i for i in range(len(words)) if words[i : i + len(phrase)] == phrase
                )
                if phrase not in self.phrases:
                    self.phrases.append(phrase)
                keys.append((self.phrases.index(phrase), place))
            self.mandatory.append(keys)
        self.vocabulary = sorted({w for words in self.words for w in words})
        self.firsts = sorted({phrase[0] for phrase in self.phrases})

    def postings(self, idf: dict[str, int]) -> list[tuple[str, int, int, int]]:
        """``(word, template, place, weight)`` of each template's words of highest ``idf``."""
        found = []
        for t, words in enumerate(self.words):
            most = min(ANCHORS, (len(set(words)) + 1) // 2)
            rare = set(sorted(set(words), key=lambda w: (-idf[w], w))[:most])
            found += [(w, t, i, idf[w]) for i, w in enumerate(words) if w in rare]
        return found


def _strings(words) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _standing(number: int, phrase: list[str]) -> Column:
    """Places, among those of first words, where the words of a phrase stand."""
    words = _strings(phrase)
    at = F.filter(
        "places",
        lambda i: (F.get("words", i) == phrase[0]) & (F.slice("words", i + 1, len(phrase)) == words),
    )
    return F.transform(at, lambda i: F.struct(F.lit(number).alias("phrase"), i.alias("start")))


def rarities(docs: DataFrame, index: Index, text: str) -> dict[str, int]:
    """Inverse document frequency of every template word over all texts, in millionths, at least 1."""
    words = alnum_words(whole(text))
    known = F.filter(words, lambda w: w.isin(index.vocabulary))
    # An empty string counts the texts themselves in the same pass.
    each = F.array_union(F.array(F.lit("")), known)
    counts = docs.select(F.explode(each).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    n = {r["word"]: r["n"] for r in counts.collect()}  # at most one row per word of the templates
    total = n.get("", 0)
    return {w: 1 + round(WEIGHT * math.log((1 + total) / (1 + n.get(w, 0)))) for w in index.vocabulary}


def located(docs: DataFrame, index: Index, rare: list[str], doc_id: str, text: str) -> DataFrame:
    """Per row: number of words, the index words with places, and where phrases stand."""
    body = whole(text)
    rows = docs.select(
        F.col(doc_id).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        alnum_words(body).alias("words"),
    )
    either = sorted({*rare, *index.firsts})
    places = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(either)
    )
    places = F.when(F.size("words") > 0, places).otherwise(F.array().cast("array<int>"))
    rows = rows.select("*", places.alias("known"))
    firsts = F.filter("known", lambda i: F.get("words", i).isin(index.firsts))
    rows = rows.select("*", firsts.alias("places"))
    phrases = [_standing(k, phrase) for k, phrase in enumerate(index.phrases)]
    seen = F.transform("known", lambda i: F.struct(i.alias("place"), F.get("words", i).alias("word")))
    none = F.array().cast("array<struct<phrase:int,start:int>>")
    return rows.select(
        "doc",
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.filter(seen, lambda x: x["word"].isin(rare)).alias("seen"),
        F.when(F.size("places") > 0, F.flatten(F.array(*phrases))).otherwise(none).alias("phrases"),
    )


def meetings(rows: DataFrame, postings: list[tuple[str, int, int, int]]) -> DataFrame:
    """``(row, template, shift, share)``: share of a template's index words, by weight, that
    stand at one shift; only meetings of at least a half."""
    spark = rows.sparkSession
    total = Counter()
    for _, template, _, weight in postings:
        total[template] += weight
    known = spark.createDataFrame(
        [(w, t, i, weight, total[t]) for w, t, i, weight in postings],
        "word string, template int, place int, weight long, total long",
    )
    anchors = rows.select("row", F.explode("seen").alias("at")).select(
        "row", F.col("at.word").alias("word"), F.col("at.place").alias("found")
    )
    met = (
        anchors.join(F.broadcast(known), "word")
        .groupBy("row", "template", "total", (F.col("found") - F.col("place")).alias("shift"))
        .agg(F.sum("weight").alias("weight"))
    )
    share = (F.col("weight") / F.col("total")).alias("share")
    return met.where(2 * F.col("weight") >= F.col("total")).select("row", "template", "shift", share)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", index: Index | None = None):
    """One row per row of ``docs``: places of the base phrases, labels and score.

    The score is the largest share among the verified meetings, at least 0.5 with a base phrase.
    """
    index = index or Index()
    postings = index.postings(rarities(docs, index, text))
    rare = sorted({word for word, *_ in postings})
    rows = written(located(docs, index, rare, doc_id, text), "licenses")
    spark = docs.sparkSession
    keys = spark.createDataFrame(
        [
            (t, label, [{"phrase": p, "offset": o} for p, o in index.mandatory[t]])
            for t, label in enumerate(index.labels)
        ],
        "template int, label string, keys array<struct<phrase:int,offset:int>>",
    )
    met = meetings(rows, postings).join(F.broadcast(keys), "template")
    met = met.groupBy("row").agg(
        F.collect_set(F.struct("label", "share", "shift", "keys")).alias("met")
    )
    rows = rows.join(met, "row", "left")
    stands = F.filter(
        "met",
        lambda m: F.forall(
            m["keys"],
            lambda k: F.exists(
                "phrases",
                lambda p: (p["phrase"] == k["phrase"])
                & (p["start"] == m["shift"] + k["offset"]),
            ),
        ),
    )
    empty = F.array().cast("array<string>")
    base = F.filter("phrases", lambda p: p["phrase"] < len(index.base))
    rows = rows.select("doc", "n_words", base.alias("base"), stands.alias("met"))
    names = _strings(label for _, label in index.base)
    base_labels = F.array_distinct(F.transform("base", lambda p: F.get(names, p["phrase"])))
    rows = rows.select("*", base_labels.alias("base_labels"))
    best = F.coalesce(F.array_max("met.share"), F.lit(0.0))
    labels = F.array_union("base_labels", F.coalesce(F.col("met.label"), empty))
    least = F.when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return rows.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.least(F.greatest(best, least), F.lit(1.0)).alias("score"),
    )


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
