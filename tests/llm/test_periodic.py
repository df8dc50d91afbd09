"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ledgerline.llm import periodic as P


def brute(ids):
    """All runs by comparing the words at every distance, smallest periods first."""
    n, out = len(ids), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ids[j] == ids[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(6, 4 * q) and not any(
                a <= s and e <= a + k and q % p == 0 and p < q for a, k, p in out
            ):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def searched(texts):
    def numbered(t):
        number = {}
        return np.array([number.setdefault(x, len(number)) for x in t], np.int64)

    return P.runs_of([numbered(t) for t in texts])


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_grammar_gives_the_text_back():
    rng = random.Random(2)
    for letters in ("ab", "abcdef"):
        ids = np.array([letters.index(c) for c in rng.choices(letters, k=400)])
        grammar = P.Grammar(ids)

        def expanded(s, grammar=grammar):
            if s < grammar.first:
                return [s]
            left, right = grammar.rules[s - grammar.first]
            return expanded(left) + expanded(right)

        assert [x for _, s in grammar.start for x in expanded(s)] == ids.tolist()
        symbols = [s for _, s in grammar.start]
        pairs = list(zip(symbols, symbols[1:]))
        assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)
        for k, places in grammar.derived(set(range(len(grammar.rules)))).items():
            want = expanded(grammar.first + k)
            assert all(ids[i : i + len(want)].tolist() == want for i in places)
            assert grammar.places[k] in places and grammar.lengths[k] == len(want)


def test_random_texts():
    rng = random.Random(4)
    texts = [""]
    for letters, most in (("ab", 60), ("abc", 80), ("aaab", 60), ("abcdefgh", 120)):
        for _ in range(250):
            text = ""
            while len(text) < rng.randrange(1, most):
                part = "".join(rng.choices(letters, k=rng.randrange(1, 9)))
                text += part * rng.choice((1, 1, 2, 4, 5, 7))
            texts.append(text)
    assert searched(texts) == [brute(t) for t in texts]


def test_regular_texts():
    texts = ["a" * k for k in range(30)] + ["ab" * 40, "aab" * 17 + "aa", fibonacci(700), "abcabcabcabd" * 12]
    texts += ["x" + ("a" * 9 + "b") * 6 + "y" + ("a" * 9 + "b") * 6 + "z", "ab" * 8 + "c" + "ab" * 8 + "c" + "ab" * 8]
    texts += [("abc" * 5 + "d") * 5, "abcd" * 4 + "abcda", "abababab" + "aababab" * 5]
    assert searched(texts) == [brute(t) for t in texts]
    assert searched(["abcdefgh" * 4])[0] == [(0, 32, 8)]
    assert searched(["abcdefgh" * 4][0][:31])[0] == []


def query_rows(rows):
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        text = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        row = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        yield (doc_id, len(runs), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op11_against_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, P.op11_periodic_runs(spark, small_dir).collect()))
    want = sorted(query_rows([r for r in docs if len(r.text or "") < 20_000]))
    ids = {r[0] for r in want}
    assert [r for r in got if r[0] in ids] == want and len(got) == len(docs)
    assert any(r[1] for r in want)


def test_odd_rows(frame):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a b a b a b a b"), (None, "a b a b a b a b"), (5, "é é é é é é"), (6, "x a a a a a")]
    got = sorted(map(tuple, P.find(frame(rows)).collect()), key=repr)
    run = lambda *r: [dict(zip(("start", "length", "period"), r))]
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (5, 6, run(0, 6, 1), "é"), (6, 6, [], "x a a a a a")]
    want += [(None, 8, run(0, 8, 2), "a b")] * 2
    assert [(a, b, [r.asDict() for r in c], d) for a, b, c, d in got] == want
    assert P.find(frame([])).collect() == []


@pytest.mark.parametrize("text, runs", [
    ("a " * 300_000, [(0, 300_000, 1)]),
    ("a b c " * 100_000, [(0, 300_000, 3)]),
    (" ".join(map(str, range(200_000))), []),
])
def test_very_long_texts(frame, text, runs):
    (row,) = P.find(frame([(1, text)])).collect()
    assert [tuple(r) for r in row.runs] == runs


def test_long_text_of_few_words():
    rng = random.Random(7)
    ids = np.array(rng.choices(range(3), k=150_000))
    ids[1000:9000] = np.tile(ids[1000:1100], 80)
    runs = P.runs_of([ids])[0]
    assert any(s <= 1000 and s + k >= 9000 and q == 100 for s, k, q in runs)
    for s, k, q in runs:
        assert np.array_equal(ids[s : s + k - q], ids[s + q : s + k])
        assert (s == 0 or ids[s - 1] != ids[s + q - 1]) and (s + k == len(ids) or ids[s + k] != ids[s + k - q])
