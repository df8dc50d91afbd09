"""The pipeline's rows, stage by stage, against plain Python over the same documents."""

from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline
from ledgerline.llm import secrets, sentencepieces
from test_native import hit_words, spaced
from test_simhash import plain_components, plain_fingerprint


def rejected(text):
    words = spaced(text)
    n = len(words)
    grams = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    repeated = {i + j for i in range(n - 4) for j in range(5) if grams[tuple(words[i : i + 5])] > 1}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    chars = sum(map(len, words))
    blank = " \t\x0b\x0c\r"
    dots = sum(x.rstrip(blank).endswith(("...", "…")) for x in lines)
    bullets = sum(x.lstrip(blank)[:1] in "-*•" and x.lstrip(blank)[1:2] in (" ", "\t") for x in lines)
    return (
        n < 10 or 100 * len(repeated) > 20 * n
        or 10 * sum((text or "").count(c) for c in "#*$%&|<>") > 3 * n
        or 10 * (len(lines) - len(set(lines))) > 3 * len(lines) or not 2 * n <= chars <= 20 * n
        or len(lines) >= 5 and (10 * dots > 3 * len(lines) or 10 * bullets > 9 * len(lines))
    )


def brute(docs, items):
    """``docs``: (doc_id, text, ...); yields the rows that each stage leaves."""
    docs = [d for d in docs if not rejected(d[1])]
    yield docs
    texts = {t: plain_fingerprint(t) for t in {d[1] for d in docs}}
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0))
    first = plain_components(list(range(len(order))), [texts[d[1]] for d in order])
    docs = [d for k, d in enumerate(order) if first[k] == k]
    yield docs
    found = ((d, *hit_words(d[1], items)) for d in docs)
    docs = [d for d, n, hit, _ in found if not (hit and 20 * hit >= n)]
    yield docs
    clean = [secrets.redact(d[1], secrets.scan(d[1])[1]) for d in docs]
    docs = [(d[0], t, *d[2:-1], len(t)) for d, t in zip(docs, clean)]
    yield docs
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepieces.MODEL))
    yield [(d[0], *d[2:-1], model.encode(d[1])) for d in docs]


def check(spark, docs, folder, items):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    before = docs
    for k, ((name, stage), want) in enumerate(zip(corpus_pipeline.STAGES, brute(rows, items))):
        after = stage(spark, before, folder)
        names = ["doc_id", "text", "lang", "source", "n_chars"] if k < 4 else ["doc_id", "lang", "source", "ids"]
        got = [tuple(r) for r in after.select(*names).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want)), name
        if k < 4:
            assert after.columns == docs.columns
            before = corpus_pipeline.written(after, "test-stage")
    return got


def test_whole_run(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = check(spark, docs, small_dir, items)
    run = [tuple(r) for r in corpus_pipeline.run(spark, small_dir).collect()]
    assert sorted(map(repr, run)) == sorted(map(repr, got)) and 0 < len(run) < docs.count()
    assert {r[0] for r in run} <= {r[0] for r in docs.select("doc_id").collect()}


def test_odd_rows(spark, tmp_path):
    """Nulls in all columns, empty and long texts, ties, repeated rows and clashing names."""
    text = "this is a text of more than ten words that goes through all of the five stages"
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (4, text, "en", "a", 3), (2, text, None, None, None), (2, text, None, None, None), (None, text, "en", "a", 1),
        (5, None, "en", "a", 0), (6, "", "en", "a", 0), (7, " \n" * 500, "en", "a", 0), (None, None, None, None, None),
        (8, "my password = hunter2hunter2hunter2 stands in a text of some ten words or more", "en", "b", 80),
        (9, "before it " + item + " behind it", "en", "b", 80), (10, "x" * 3000 + " " + " ".join(f"w{i}" for i in range(4000)), "de", "c", 9),
        (11, "only " * 40, "en", "c", 200),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    for name in ("words", "key", "digest", "ids", "in_0", "a.b", "print", "body"):
        docs = docs.withColumn(name, docs["doc_id"] + 1)
    items = [(1, item)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = check(spark, docs, str(tmp_path), items)
    assert sorted(r[0] for r in got) == [2, 8, 10]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
