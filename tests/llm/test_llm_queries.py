"""Registered queries against their SQL forms."""

import pytest

from compare import compare, connect
from ledgerline.llm.queries import ORACLE, QUERIES

NATIVE = ("op2_decontaminate", "op4_licenses", "op7_quality_rules", "op13_line_dedup")


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_sql(spark, small_dir, key):
    assert compare(QUERIES[key](spark, small_dir), connect(small_dir), ORACLE[key]) == []


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_rows(spark, small_dir, key):
    df = QUERIES[key](spark, small_dir)
    if key == "op12_spelling":  # a row for each word
        return
    table = "pages" if key == "op10_warc" else "documents"
    assert df.count() == spark.read.parquet(f"{small_dir}/{table}.parquet").count()
    if key in NATIVE:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
