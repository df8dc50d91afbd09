"""Column names of any kind, and texts of a million equal characters."""

import pytest

from ledgerline.llm import decontaminate, quality_rules, secrets, sentencepieces, simhash
from ledgerline.llm.token_counts import Counter, token_counts

TEXT = "some words that make up a text of more than ten words, and no secret in it at all"


@pytest.fixture
def odd(frame):
    rows = frame([(1, TEXT), (2, TEXT + " and then one more"), (3, None)], extra=False)
    for name in ("a.b", "a b", "back`tick", "ids", "digest"):
        rows = rows.withColumn(name, rows["doc_id"] * 2)
    return rows


def test_names(spark, odd):
    benchmark = spark.createDataFrame([(1, "none of these")], "item_id bigint, text string")
    for kept in (
        quality_rules.keep(odd), simhash.keep_first(odd), decontaminate.clean(odd, benchmark), secrets.redacted(odd)
    ):
        assert kept.columns == odd.columns
        row = [r for r in kept.collect() if r.doc_id == 1][0]
        assert row["a.b"] == row["a b"] == row["back`tick"] == 2 and row["text"] == TEXT


def test_ids_column_is_replaced(odd):
    rows = sentencepieces.encode(odd).select("doc_id", "ids").collect()
    assert all((len(r.ids) > 0) == (r.doc_id != 3) for r in rows)


@pytest.mark.parametrize("part, tokens", [(" ", 10**6), ("\n", None), ("a", None), ("7", None), ("!", None), ("é", None), ("ab 1!\t", None)])
def test_counts_of_long_texts(part, tokens):
    counter = Counter()
    from tokenizers import Tokenizer
    import public_tokenizers

    text = part * (10**6 // len(part))
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = len(exact.encode(text, add_special_tokens=False).ids)
    assert counter.count(text) == want and tokens in (None, want)


def test_common_text(frame, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerline.llm.token_counts.HOT_ROWS", 5)
    rows = [(k, "the same text") for k in range(40)] + [(None, "the same text"), (50, " " * 10**6), (51, None), (52, "x")]
    got = {r.doc_id: r.n_tokens for r in token_counts(frame(rows), str(tmp_path / "cache")).collect()}
    assert len(got) == 44 and got[None] == got[3] == 3 and got[50] == 10**6 and got[51] == 0
