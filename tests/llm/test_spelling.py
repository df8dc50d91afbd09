"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import spelling as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_variants(counts):
    near = defaultdict(list)
    words = sorted(counts)
    shorter = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add(w)
        shorter[w].add(w)
    for group in shorter.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b)]
    out, form = {}, {}
    for w in words:
        found = set(near[w])
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
        out[w] = len(found)
    rows = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, counts[w], out[w], counts[form[w]] if w in form else None))
    return rows


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def found(df):
    return sorted(map(tuple, df.collect()))


def of(frame, counts):
    return frame(list(counts.items()), "word string, n bigint", extra=False)


def test_machines():
    words = sorted({"abc", "abd", "abcd", "xbc", "bc", "b", "aabc", "abbc"})
    accepted = S.Acceptor(words)
    # Equal right languages are one state.
    assert len(accepted.arcs) == len({(f, *sorted(a.items())) for f, a in zip(accepted.final, accepted.arcs)})
    pairs = set(S.near_pairs(accepted, accepted))
    assert pairs == {(a, b) for a in words for b in words if one_edit(a, b) and len(b) >= len(a)}


@pytest.mark.parametrize("most", [2, 7, 1024])
def test_random_words(frame, most):
    rng = random.Random(most)
    counts = {}
    for letters, length in (("ab", 9), ("abc", 8), ("aé", 11), ("xyzuvw", 7)):
        for _ in range(150):
            w = "".join(rng.choices(letters, k=rng.randrange(7, length + 1)))
            counts[w] = rng.choice((2, 3, 20, 25, 200, 250, 3000))
    assert found(S.variants(of(frame, counts), most)) == brute_variants(counts)


def test_common_halves(frame):
    """Half of the words begin alike, others end alike: their partitions are halved again."""
    rng = random.Random(3)
    counts = {}
    for k in range(400):
        middle = "".join(rng.choices("abcdefgh", k=4))
        counts["prefix" + middle] = counts[middle + "suffix"] = rng.randrange(2, 400)
    assert found(S.variants(of(frame, counts), 16)) == brute_variants(counts)


def test_long_words_and_ties(frame):
    long = "".join(random.Random(1).choices("abc", k=20_000))
    counts = {long: 5, long[:9000] + long[9001:]: 50, long + "x": 50, "aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 20}
    counts |= {"abcdefg": 30, "abcdefh": 2, "abcdefi": 30, "abcdefgé": 300, "abcdefgéé": 3000}
    assert found(S.variants(of(frame, counts))) == brute_variants(counts)


def test_whole_way(frame, spark):
    rows = [(k, " ".join(["Wordlike", "wordlikes", "andother", "ÀÉÎÕÜß÷"] * 4) + "," + "short") for k in range(60)]
    rows += [(None, "wordlike wordlike"), (5, None), (6, ""), (7, "nocommon" * 4000 + " " + "nocommon" * 4000), (7, "x")]
    runs = S.letter_runs(frame(rows))
    got = S.variants(S.vocabulary(runs.select(S.with_typos().alias("word"))))
    assert found(got) == brute_variants(brute_words(rows))


def test_empty_table(frame):
    runs = S.letter_runs(frame([]))
    assert S.variants(S.vocabulary(runs.select(S.with_typos().alias("word")))).collect() == []


def test_op12_against_brute_force(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found(S.op12_spelling(spark, small_dir)) == brute_variants(brute_words(rows))
