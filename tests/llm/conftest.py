import pytest


@pytest.fixture
def frame(spark):
    """A table of documents with columns whose names clash with those of the operators."""

    def make(rows, columns="doc_id bigint, text string", extra=True):
        df = spark.createDataFrame(rows, columns)
        if extra:
            for name in ("words", "key", "shard", "print", "body", "n", "digest", "in_0"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make
