"""Line dedup against brute force, batch by batch, and after runs that broke off."""

import random

import pytest

from ledgerline.llm import line_dedup as L

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """``rows``: (doc_id, text); ids of None are one document behind all others."""
    order = lambda i: (i is None, i or 0)
    held = {}
    cut = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for i, lines in cut:
        for line in lines:
            held.setdefault(key(line), set()).add(order(i))
    out = []
    for i, lines in cut:
        kept = [
            x for x in lines
            if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == order(i)
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


ODD = [
    (4, "the first shared line\nown line of four\nthe first shared line"),
    (2, "  THE FIRST SHARED LINE\t\nshort\nshort\n"),
    (9, "The First Shared Line\n\n\nshort\nÜBER die lange Zeile\n"),
    (7, None),
    (8, ""),
    (3, "\n\n"),
    (None, "the first shared line\nonly without an id"),
    (None, "only without an id\nanother line of it"),
    (5, "only without an id"),
    (9, "The First Shared Line\n\n\nshort\nÜBER die lange Zeile\n"),
    (11, "über die lange Zeile\nÜber die lange Zeile\n\x0cÜBER DIE LANGE ZEILE "),
    (12, "ten chars!\nnine char\nten chars!"),
    (13, "nine char\nTEN CHARS!"),
]


@pytest.mark.parametrize("batches", [1, 3, 9])
def test_odd_rows(frame, batches):
    assert found(L.dedupe(frame(ODD), batches=batches)) == brute(ODD)


def test_empty_table(frame):
    assert L.dedupe(frame([])).collect() == []


def test_random_lines_against_brute_force(frame):
    rng = random.Random(5)
    pool = [f"line number {k} of the pool" for k in range(60)] + ["tiny", "", " padded line of text "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(8)))) for i in rng.sample(range(10**6), 300)]
    assert found(L.dedupe(frame(rows), batches=7)) == brute(rows)


def test_long_text_and_common_line(frame, monkeypatch):
    monkeypatch.setattr(L, "HOT_LINES", 10)
    long = "\n".join(f"line {k % 900} of a very long text" for k in range(60_000))
    rows = [(i, "one line that all hold\nown line number %d" % i) for i in range(200)]
    rows += [(1000, long), (1001, "line 5 of a very long text\n" + "x" * 300_000)]
    assert found(L.dedupe(frame(rows), batches=4)) == brute(rows)


def test_batches_runs_and_restart(spark, frame, tmp_path):
    rng = random.Random(8)
    pool = [f"line number {k} of the pool" for k in range(90)]
    rows = [(i, "\n".join(rng.choices(pool, k=5))) for i in range(120)]
    parts = [rows[k : k + 12] for k in range(0, 120, 12)]
    runs = L.LineRuns(spark, str(tmp_path / "runs"), buckets=3, fan=3)
    results = [L.dedupe_batch(frame(p), runs, k).collect() for k, p in enumerate(parts)]
    assert sorted((tuple(r) for p in results for r in p), key=repr) == brute(rows)
    # Ten batches: 0-8 is one run of the third level, 9 stands alone.
    assert runs.before(10) == [(0, 8), (9, 9)]
    (tmp_path / "runs/run-0-8/_SUCCESS").unlink()
    (tmp_path / "runs/run-9-9/_SUCCESS").unlink()
    again = L.LineRuns(spark, str(tmp_path / "runs"), buckets=3, fan=3)
    assert again.before(9) == [(0, 2), (3, 5), (6, 8)]
    for k in (9, 4):
        assert L.dedupe_batch(frame(parts[k]), again, k).collect() == results[k] or sorted(
            map(tuple, L.dedupe_batch(frame(parts[k]), again, k).collect())
        ) == sorted(map(tuple, results[k]))
    with pytest.raises(ValueError):
        again.before(12)
    runs.close(), again.close()
