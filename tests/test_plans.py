"""What the plans do at scale: pruned scans, no wide window, no hot key in one task."""

import re

import pytest

from ledgerline.queries import QUERIES
from ledgerline.queries.inputs import dictionaries, stage
from ledgerline.operators import dedup
from ledgerline.plans import clean


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_used_columns_only(spark, small_dir):
    plan = plan_of(QUERIES["validity_flags"](spark, small_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any(s.startswith("o_orderkey:bigint,o_custkey:bigint") and "o_orderdate" not in s
               for s in schemas)


def test_single_partition_exchange_holds_range_counts_only(spark, small_dir):
    plan = plan_of(stage(spark, small_dir))
    lines = plan.split("\n")
    for i, text in enumerate(lines):
        if "Exchange SinglePartition" in text:
            below = " ".join(lines[i + 1 : i + 3])
            assert "HashAggregate" in below and "_range" in below


def test_standardize_does_not_shuffle(spark, small_dir):
    from ledgerline.plans.standardize import standardize
    from ledgerline.queries.inputs import PARAMS, unnumbered
    from pyspark.sql import functions as F

    rows = unnumbered(spark, small_dir).withColumn("_row_num", F.lit(1).cast("bigint"))
    plan = plan_of(standardize(rows, dictionaries(spark), PARAMS))
    assert not re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan)


def test_country_join_is_hashed_and_broadcast(spark, small_dir):
    plan = plan_of(clean.fix_region(stage(spark, small_dir), dictionaries(spark)))
    assert "BroadcastHashJoin [collationkey(_country_key" in plan
    assert "SortMergeJoin [coll" not in plan


@pytest.mark.parametrize("small,kind", [(True, "BroadcastHashJoin"), (False, "SortMergeJoin")])
def test_duplicates_join(spark, small_dir, small, kind):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(dedup.flag_duplicates(stage(spark, small_dir), small=small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert f"{kind} [batch_id" in plan and "collationkey(_key" in plan
    if not small:
        assert re.search(r"SortMergeJoin \[batch_id#\d+, collationkey\(_key#\d+\), _place", plan)
    else:
        assert "SortMergeJoin [batch_id" not in plan


@pytest.mark.parametrize("key", ["standardize_full", "clean_full", "split_valid", "final_valid"])
def test_generated_methods_are_compiled(spark, small_dir, key):
    """The JVM runs methods of more than 8,000 bytes of code interpreted."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[key](spark, small_dir)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        code = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall("maxMethodCodeSize:([0-9]+)", code)]
    assert sizes and max(sizes) <= 8000


def test_file_log_comes_from_stored_rows(spark, small_dir, tmp_path, monkeypatch):
    """The raw view is made once for a batch, not a second time to count the rows of its files."""
    from ledgerline.queries import registry
    from ledgerline.queries.inputs import PARAMS
    from ledgerline.sources.tables import Tables

    plans = []
    monkeypatch.setattr(Tables, "upsert", lambda self, df, *rest: plans.append(plan_of(df)))
    registry._ods(spark, small_dir, Tables(spark, str(tmp_path)), PARAMS, "batch_1")
    assert len(plans) == 1 and "orders.parquet" not in plans[0] and "Window" not in plans[0]
