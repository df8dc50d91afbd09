"""Decontamination, license scan and quality rules against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from ledgerline.llm import decontaminate, licenses, quality_rules

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


ITEM = "Zero one TWO three four five six seven eight nine ten eleven twelve thirteen fourteen É"
ITEMS = [(7, ITEM), (10, ITEM.lower()), (8, "tiny item here"), (9, None), (None, "no id item of words"), (11, "--")]
TEXTS = [
    (1, "x " * 5 + "zero one two three four five six seven eight nine ten eleven twelve end"),
    (2, "zero one two three four five six seven eight nine ten eleven"),
    (3, "a tiny, item; HERE and tiny item"),
    (4, None),
    (5, ""),
    (None, "so no id item of words is met"),
    (None, None),
    (6, ITEM + " filler " * 400),
    (6, ITEM + " filler " * 400),
    (6, "other text of the same id"),
    (12, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen É"),
    (13, "a a a a a a a a a a a a a a a a a a a a a"),
]


def hit_words(text, items):
    words, hit, met = alnum(text), set(), set()
    for item, body in items:
        own = alnum(body)
        n = min(13, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for p in range(len(words) - n + 1 if n else 0):
            if tuple(words[p : p + n]) in grams:
                hit.update(range(p, p + n))
                met.add(item)
    return len(words), len(hit), sorted(str(i) for i in met if i is not None)


@pytest.mark.parametrize("most", [500_000, 0])
def test_contamination(spark, frame, most):
    items = spark.createDataFrame(ITEMS + [(20, "a " * 14)], "item_id bigint, text string")
    found = decontaminate.contamination(frame(TEXTS), items, max_rows=most).collect()
    expected = []
    for ident, text in TEXTS:
        n, hit, met = hit_words(text, ITEMS + [(20, "a " * 14)])
        expected.append((ident, n, hit, met, hit > 0 and 20 * hit >= n))
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_clean_keeps_columns(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(TEXTS)
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    bad = {t for _, t in TEXTS if (x := hit_words(t, ITEMS))[1] and 20 * x[1] >= x[0]}
    assert sorted((r["doc_id"], r["text"]) for r in left.collect() if r["doc_id"]) == sorted(
        (i, t) for i, t in TEXTS if i and t not in bad
    ) or {r["text"] for r in left.collect()} == {t for _, t in TEXTS} - bad


def test_empty_tables(spark, frame):
    none = frame([])
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(frame(TEXTS), items).where("n_hit > 0").count() == 0
    assert licenses.scan(none).count() == 0
    assert quality_rules.assess(none).count() == 0
    assert quality_rules.keep(none).count() == 0


LICENSED = [
    (1, "Released under the MIT License. Later: mit-license, and the Apache\nLicense"),
    (2, "This work is licensed under the GNU General Public License, version 3."),
    (3, "permission was hereby granted free of charge to any person"),
    (4, None),
    (5, "mit licenses"),
    (None, "Licensed under CC BY-NC 4.0."),
    (6, "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met"),
    (6, ""),
]


def test_licenses(frame):
    found = licenses.scan(frame(LICENSED)).collect()
    assert len(found) == len(LICENSED)
    for ident, text in LICENSED:
        words = alnum(text)
        places, labels = [], set()
        for phrase, label in licenses.BASE:
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        row = next(r for r in found if r["doc_id"] == ident and r["n_words"] == len(words))
        assert (row["n_base"], row["base_labels"]) == (len(places), ",".join(sorted(labels)))
        assert row["first_word"] == (min(places) if places else None)
        assert row["last_word"] == (max(places) if places else None)
        assert labels <= set(row["labels"].split(",")) | {""} and 0 <= row["score"] <= 1
    by_text = {r["doc_id"]: r["labels"] for r in found if r["n_words"]}
    assert by_text[None] == "cc-by-nc" and by_text[6] == "bsd" and by_text[3] == ""


def test_licenses_of_a_long_notices_file(frame):
    rows = [(i, f"{text} and other words") for i, (_, text, _) in enumerate(licenses.TEMPLATES) for _ in range(i + 1)]
    prose = " a long document that has other words " * 200
    rows.append((-1, prose.join(text for _, text, _ in licenses.TEMPLATES)))
    (found,) = (r for r in licenses.scan(frame(rows)).collect() if r["doc_id"] == -1)
    assert found["labels"].split(",") == sorted({label for label, *_ in licenses.TEMPLATES})
    assert found["score"] == 1.0


def by_hand(texts):
    """Labels and score of each text from the definitions: rarest words of each template by document
    frequency, their weight at one shift, phrases at the same shift."""
    split = [alnum(text) for text in texts]
    index = licenses.Index()
    number = Counter(w for words in split for w in set(words))
    idf = {w: 1 + round(licenses.WEIGHT * math.log((1 + len(texts)) / (1 + number[w]))) for w in index.vocabulary}
    for words in split:
        labels, best = set(), 0.0
        for phrase, label in licenses.BASE:
            p = phrase.split()
            if any(words[i : i + len(p)] == p for i in range(len(words))):
                labels.add(label)
                best = 0.5
        for label, template, phrases in licenses.TEMPLATES:
            own = template.split()
            rare = sorted(set(own), key=lambda w: (-idf[w], w))[: min(licenses.ANCHORS, (len(set(own)) + 1) // 2)]
            total = sum(idf[w] for w in own if w in rare)
            for shift in range(-len(own), len(words)):
                at = [(w, shift + i) for i, w in enumerate(own) if w in rare and 0 <= shift + i < len(words)]
                weight = sum(idf[w] for w, i in at if words[i] == w)
                if 2 * weight < total:
                    continue
                starts = [(p.split(), shift + place(own, p.split())) for p in phrases]
                if all(i >= 0 and words[i : i + len(p)] == p for p, i in starts):
                    labels.add(label)
                    best = max(best, weight / total)
        yield ",".join(sorted(labels)), min(best, 1.0)


def place(words, phrase):
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def test_license_labels_against_plain_python(frame):
    chance = random.Random(5)
    full = [text for _, text, _ in licenses.TEMPLATES]
    texts = [text for _, text in LICENSED] + full + [
        "The Eclipse Public License", "SPDX-License-Identifier: Apache-2.0", "the MIT Licence", "mit",
        "Mozilla Public License, v. 2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "-" * 50, "rights reserved",
    ]
    for _ in range(300):  # words left out, put in and changed, parts of templates side by side
        words = " ".join(chance.sample(full, 2)).split()
        for _ in range(chance.randrange(8)):
            i = chance.randrange(len(words))
            words[i : i + chance.randrange(2)] = chance.choice([[], ["software"], ["license"], ["of", "the"]])
        begin = chance.randrange(6)
        texts.append(" ".join(words[begin : begin + chance.randrange(60)]).title())
    rows = list(enumerate(texts))
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(frame(rows)).collect()}
    assert [found[i] for i, _ in rows] == list(by_hand(texts))
    twice = licenses.scan(frame([(1, text) for text in texts * 2])).collect()
    assert Counter((r["labels"], r["score"] > 0) for r in twice) == Counter((a, b > 0) for a, b in by_hand(texts * 2))
    named = {text: found[i][0] for i, text in rows}
    assert named["The Eclipse Public License"] == "epl" and named["the MIT Licence"] == "mit"
    assert named["SPDX-License-Identifier: Apache-2.0"] == "apache" and named["rights reserved"] == ""


PROSE = "several ordinary words make this line long enough to be kept by all the rules"
GRADED = [
    (1, PROSE),
    (2, "too short"),
    (3, "one two three four five " * 4),
    (4, "same line with some words\n" * 3 + PROSE + "\n\n \n"),
    (5, None),
    (6, " ".join(w + "%%%" for w in PROSE.split())),
    (7, PROSE + "\n" + PROSE.upper()),
    (8, PROSE + "\x0b\x1c\x85" + "ÄÖ 😀 é"),
    (None, PROSE),
    (1, PROSE),
    (9, "a b c d e f a b c d e f g h a b c d"),
    (10, "\n".join(f"line {w} ends so{'...' if k < 4 else '…' if k < 6 else '.'} " for k, w in enumerate(PROSE.split()))),
    (11, "\n".join(f" - line of {w}" for w in PROSE.split())),
    (12, "- one line\n* " + PROSE + " ...\n\n•no bullet"),
    (13, "\n".join(f"{'-' if k else ''} line of {w}" for k, w in enumerate(PROSE.split()[:9]))),
]


def test_quality_rules(frame):
    found = quality_rules.assess(frame(GRADED)).collect()
    expected = []
    for ident, text in GRADED:
        text = text or ""
        words = spaced(text)
        grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        repeat = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if spaced(x)]
        expected.append((
            ident, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines), len(lines) - len(set(lines)), len(repeat),
        ))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    assert sorted((tuple(r[c] for c in names) for r in found), key=str) == sorted(expected, key=str)
    kept = sorted((r["doc_id"] for r in found if r["kept"]), key=str)
    docs = frame(GRADED)
    left = quality_rules.keep(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == kept == [1, 1, 12, 13, 7, 8, None]


def test_order_of_rules(frame):
    """A rule that rejects all that another one rejects leaves nothing to that one."""
    rules = quality_rules.RULES
    by_name = {r.name: r for r in rules}
    rows = quality_rules.prepared(frame([(i, "too short") for i in range(60)] + [(99, PROSE)]))
    order = quality_rules.ranked(rows, (by_name["repeated_words"], by_name["few_words"], by_name["symbols"]))
    assert order[0].name == "few_words" and len(order) == 3
    assert set(quality_rules.order_rules(frame([(1, "x" * 100_000), (2, None)]))) == set(rules)


def test_order_does_not_decide(frame):
    rules = quality_rules.RULES
    some = [quality_rules.assess(frame(GRADED), rules=r) for r in (rules, rules[::-1])]
    assert len({str(sorted(map(str, df.collect()))) for df in some}) == 1


def test_items_digest():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
