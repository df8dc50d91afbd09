"""Fingerprints, tiled comparison and components against plain Python."""

import random

import numpy as np
import xxhash

from ledgerline.llm import simhash
from ledgerline.llm.graph import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for c, i in zip(label, ids):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return [least.get(c) for c in label]


def texts():
    rng = random.Random(5)
    vocabulary = ["W%d" % i for i in range(50)] + ["é", "ß", "\x1cx"]
    rows = [(None, None), (90, ""), (91, " \n\x0b"), (92, "one"), (93, "one two"), (94, "One\ttwo")]
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 300))]
        rows.append((i, " ".join(words)))
        for k in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
            rows.append((200 + 3 * i + k, "\n".join(words)))
    return rows + [(7, "same id, other text"), (3, rows[9][1]), (3, rows[9][1]), (None, "no id")]


def test_near_duplicates(frame):
    rows = texts()
    found = simhash.near_duplicates(frame(rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    expected = zip((i for i, _ in rows), prints, plain_components([i for i, _ in rows], prints))
    got = [(r["doc_id"], r["print"] & (2**64 - 1), r["component_id"]) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_keep_first(frame):
    rows = texts()
    docs = frame(rows)
    left = simhash.keep_first(docs)
    assert left.columns == docs.columns
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(list(range(len(rows))), prints)
    kept = left.collect()
    assert len(kept) == len(set(groups))
    least = plain_components([i for i, _ in rows], prints)
    assert {r["doc_id"] for r in kept} == set(least)


def test_links_of_tiles_and_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63, 60, dtype=np.int64)
    near = [b ^ (np.int64(1) << np.int64(k)) for b in base[:20] for k in rng.integers(0, 63, 3)]
    prints = np.unique(np.concatenate((base, np.array(near, np.int64))))
    df = spark.createDataFrame([(int(p),) for p in prints], "print bigint")
    found = components(simhash.links(df, block=2), "src", "dst")
    label = {r["node"]: r["component"] for r in found.collect()}
    expected = plain_components(prints.tolist(), [int(p) & (2**64 - 1) for p in prints])
    assert [label.get(int(p), int(p)) for p in prints] == expected


def test_spanning_links_of_a_dense_group():
    prints = np.array([1 << i for i in range(60)] + [0], np.int64)
    assert len(simhash.spanning_links(prints, prints, 2)) == len(prints) - 1


def test_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(99, 98)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(51)}, 98: 98, 99: 98}
    assert components(edges.limit(0), "a", "b").count() == 0


def test_empty(frame):
    assert simhash.near_duplicates(frame([])).count() == 0
    assert simhash.keep_first(frame([])).count() == 0
