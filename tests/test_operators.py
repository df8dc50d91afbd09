import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import audit, dedup, ids, joins, upsert, worklist


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def hot(spark):
    """One key with half of all rows, many rare keys, NULL keys."""
    k = F.when(F.col("id") % 2 == 0, F.lit("hot")).when(
        F.col("id") % 7 == 0, None
    ).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    return spark.range(1, 2001).select("id", k.alias("k"))


def test_lookup_join_large_equals_small(spark, hot):
    lookup = spark.createDataFrame(
        [("hot", "a"), ("hot", "b"), ("k1", "c"), (None, "n")], "code string, name string"
    )
    on = (F.col("k"), F.col("code"))
    small = joins.lookup_join(hot, lookup, *on, small=True)
    large = joins.lookup_join(hot, lookup, *on, small=False, salts=8)
    assert values(small, "id", "k", "name") == values(large, "id", "k", "name")
    assert small.count() == 2000 + 1000


def test_matching_large_equals_small(spark, hot):
    keys = spark.createDataFrame([("hot",), ("k3",)], "k string")
    for how in ("left_semi", "left_anti"):
        small = joins.matching(hot, keys, small=True, how=how)
        large = joins.matching(hot, keys, small=False, how=how)
        assert values(small, "id") == values(large, "id")


def test_hot_split_join_equals_plain_join(spark, hot):
    lookup = hot.where("k is not null").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low")
    )
    split = joins.hot_split_join(hot, lookup, ["k"], "n", ["id"], hot_keys=2, hot_rows=10, salts=8)
    plain = hot.join(lookup.drop("n"), "k", "left")
    assert values(split, "id", "k", "low") == values(plain, "id", "k", "low")


def test_hot_split_join_spreads_hot_rows_and_rows_without_key(spark, hot):
    lookup = hot.where("k is not null").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = joins.hot_split_join(hot, lookup, ["k"], "n", ["id"], hot_rows=10)
        plan = split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [k" in plan and "_place" in plan.split("SortMergeJoin")[1].split("]")[0]


def test_fits_broadcast(spark):
    assert joins.fits_broadcast(spark.range(100))
    assert joins.fits_broadcast(spark.range(0))
    assert not joins.fits_broadcast(spark.range(100), max_rows=99)
    assert not joins.fits_broadcast(spark.range(100), max_bytes=100)


@pytest.mark.parametrize("block", [1, 7, 1 << 18])
def test_number_rows(spark, block):
    rows = spark.range(0, 400, 3).select(
        F.when(F.col("id") % 5 < 4, "big").otherwise("small").alias("g"), F.col("id").alias("s")
    )
    found = ids.number_rows(rows, ["g"], "s", "n", total="t", start=10, block=block)
    by_group = {}
    for g, s, n, t in values(found, "g", "s", "n", "t"):
        by_group[g] = by_group.get(g, 0) + 1
        assert n == by_group[g]
    assert [t for _, t in values(found, "g", "t")] == list(range(11, 11 + rows.count()))


def test_number_rows_with_ties(spark):
    rows = spark.createDataFrame(
        [("f", 1, "b"), ("f", 1, "a"), ("f", 2, None), ("g", 1, "c")], "g string, s int, v string"
    )
    found = ids.number_rows(rows, ["g"], "s", "n", ties=["v"], total="t")
    assert values(found, "t", "g", "s", "v") == [
        (1, "f", 1, "a"), (2, "f", 1, "b"), (3, "f", 2, None), (4, "g", 1, "c")
    ]


def test_assign_ids_small_and_large_log(spark, monkeypatch):
    rows = spark.range(1, 101).select(
        F.when(F.col("id") <= 60, "a.csv").otherwise("b.csv").alias("f"),
        F.when(F.col("id") <= 60, F.col("id")).otherwise(F.col("id") - 60).alias("_row_num"),
    )
    log = rows.groupBy("f").agg(F.count(F.lit(1)).alias("rows_loaded"))
    small = values(ids.assign_ids(rows, log, ["f"], start=5), "stage_id", "f", "_row_num")
    assert [s for s, _, _ in small] == list(range(6, 106))
    monkeypatch.setattr(ids, "fits_broadcast", lambda df: False)
    assert values(ids.assign_ids(rows, log, ["f"], start=5), "stage_id", "f", "_row_num") == small


def test_shift(spark):
    def table(*keys):
        return spark.createDataFrame([(k,) for k in keys], "stage_id long")

    previous = table(100, 50)
    now = table(1, 2, 3)
    for _ in range(2):
        now = ids.shift_ids(now, "stage_id", *ids.shift_bounds(previous, now))
        assert values(now, "stage_id") == [(101,), (102,), (103,)]
    same_size = table(1, 100)
    moved = ids.shift_ids(same_size, "stage_id", *ids.shift_bounds(previous, same_size))
    assert values(moved, "stage_id") == [(101,), (200,)]
    with pytest.raises(ValueError, match="empty"):
        ids.shift_bounds(table(), table(1))
    with pytest.raises(ValueError, match="overlap"):
        ids.shift_bounds(previous, table(1, 150))


STAGE = "stage_id long, batch_id string, patent_id string, is_valid int, invalid_reason string"


def test_flag_duplicates(spark):
    rows = [
        (1, "b1", "P1", 1, ""), (2, "b1", "p1 ", 1, "x"), (3, "b1", "P1", 0, "y"),
        (4, "b2", "P1", 1, None), (5, "b1", "  ", 1, ""), (6, "b1", "", 1, ""),
        (7, "b1", None, 1, ""), (8, "b1", "É", 1, ""), (9, "b1", "e", 1, "重复patent_id"),
    ]
    stage = spark.createDataFrame(rows, STAGE)
    expected = [
        (1, 1, ""), (2, 0, "x;重复patent_id"), (3, 0, "y"), (4, 1, None), (5, 1, ""), (6, 1, ""),
        (7, 1, ""), (8, 1, ""), (9, 0, "重复patent_id"),
    ]
    for split in ({}, {"small": False}, {"small": False, "hot_rows": 1},
                  {"small": False, "hot_rows": 1, "hot_keys": 1}):
        found = dedup.flag_duplicates(stage, **split)
        assert found.columns == stage.columns
        assert values(found, "stage_id", "is_valid", "invalid_reason") == expected
        again = dedup.flag_duplicates(found, **split)
        assert values(again, "stage_id", "is_valid", "invalid_reason") == expected
    earlier = dedup.flag_duplicates(stage, include_blank=True)
    assert [r for r in values(earlier, "stage_id", "is_valid") if r[0] in (5, 6)] == [
        (5, 1), (6, 0)
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("start", [-3000, 1 << 62])
def test_flag_duplicates_of_many_keys(spark, monkeypatch, start):
    """Keys that are too many to broadcast: a bit for each id goes to the wide rows, which stay in place."""
    k = F.col("id")
    stage = spark.range(9000).select(
        (k + start).alias("stage_id"), F.when(k % 50 == 7, None).otherwise("b1").alias("batch_id"),
        F.when(k % 9 == 0, F.lit(" ")).when(k % 9 < 4, F.concat(F.lit("P"), (k / 7).cast("int").cast("string")))
        .when(k % 9 == 5, F.concat(F.lit("p"), (k / 7).cast("int").cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.lit("Q"), k.cast("string"))).alias("patent_id"),
        F.when(k % 11 == 0, 0).otherwise(1).alias("is_valid"), F.lit("").alias("invalid_reason"),
    )
    odd = stage.withColumn("patent_id", F.replace("patent_id", F.lit("P"), F.lit("Ｐ")))
    columns = ("stage_id", "is_valid", "invalid_reason")
    for rows in (stage, odd):
        expected = values(dedup.flag_duplicates(rows, small=True), *columns)
        assert 1000 < sum(r[1] == 0 for r in expected) < 8000
        assert values(dedup.flag_duplicates(rows), *columns) == expected
        with monkeypatch.context() as patch:
            patch.setattr(dedup, "fits_broadcast", lambda keys: False)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            try:
                found = dedup.flag_duplicates(rows)
                assert "Exchange hashpartitioning" not in plan_of(found)
                assert values(found, *columns) == expected
                patch.setattr(dedup, "MAX_BROADCAST_BYTES", 0)
                found = dedup.flag_duplicates(rows)
                assert "Exchange hashpartitioning" in plan_of(found)
                assert values(found, *columns) == expected
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_plain_keys_are_compared_as_text(spark):
    """Any two plain texts are the same key by ``fold_plain`` as by the collation; no other text is plain."""
    rng = random.Random(7)
    signs = [chr(c) for c in range(32, 127)]
    texts = [x + y for x in signs for y in signs] + [f"a{x}b" for x in signs]
    texts += ["".join(rng.choice("aAbB19 -._/") for _ in range(rng.randint(0, 6))) for _ in range(5000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~dedup.is_plain(F.col("t"))).isEmpty()
    plain = dedup.fold_plain(F.col("t"))
    pairs = df.groupBy(dedup.fold_key(F.col("t")).alias("k")).agg(F.collect_set(plain).alias("folds"))
    assert pairs.where(F.size("folds") != 1).isEmpty()
    assert pairs.count() == df.select(plain).distinct().count()
    others = spark.createDataFrame([(t,) for t in ("é", "a\n", "\n", "a\tb", "\x7f", "Ｐ1", "a\x00")], "t string")
    assert others.where(dedup.is_plain(F.col("t"))).isEmpty()
    rows = [(1, "b1", "P1", 1, ""), (2, "b1", "p1 ", 1, "")]
    assert "collationkey" not in plan_of(dedup.flag_duplicates(spark.createDataFrame(rows, STAGE)))
    rows.append((3, "b1", "Ｐ1", 1, ""))
    found = dedup.flag_duplicates(spark.createDataFrame(rows, STAGE))
    assert values(found, "stage_id", "is_valid") == [(1, 1), (2, 0), (3, 0)]


def test_keep_first(spark):
    rows = spark.createDataFrame(
        [(1, "f", 2, "late"), (1, "f", 1, "early"), (2, "f", 3, "only"), (None, "f", 4, "a"),
         (None, "f", 5, "b")],
        "id long, file string, row int, v string",
    )
    for split in ({}, {"small": False}, {"small": False, "hot_rows": 1}):
        found = dedup.keep_first(rows, "id", ["file", "row"], **split)
        assert sorted(r.v for r in found.collect()) == ["a", "b", "early", "only"]
    assert sorted(r.v for r in dedup.keep_first(rows, "id", ["row"]).collect()) == [
        "a", "b", "early", "only"
    ]


def test_insert_ignore_and_upsert_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    new = spark.createDataFrame([(2, "x"), (3, "c"), (3, "d")], "id long, v string")
    added = upsert.insert_ignore(new, old, "id", ["v"])
    assert values(added, "id", "v") == [(3, "c")]
    after = old.unionByName(added)
    assert upsert.insert_ignore(new, after, "id", ["v"]).isEmpty()
    assert upsert.insert_ignore(new, upsert.key_window(old, new, "id"), "id").count() == 2
    patch = spark.createDataFrame([(1, None), (9, "z")], "id long, v string")
    assert [tuple(r) for r in upsert.upsert_columns(old, patch, "id", ["v"]).orderBy("id")
            .collect()] == [(1, None), (2, "b")]


def test_insert_ignore_joins_keys_only(spark):
    """Wide rows are not shuffled where few or no keys are there already, whatever the size of the tables."""
    old = spark.range(0, 1000, 2).select("id", F.lit("old").alias("v"))
    none, some = spark.range(5000, 6000), spark.range(900, 1100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for new, left in ((none, 1000), (some, 150)):
            added = upsert.insert_ignore(new.select("id", F.lit("new").alias("v")), old, "id")
            assert "Exchange hashpartitioning" not in added._jdf.queryExecution().executedPlan().toString()
            assert added.count() == left
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insert_ignore_with_many_known_keys(spark, monkeypatch):
    monkeypatch.setattr(upsert, "fits_broadcast", lambda df: False)
    old = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id long, v string")
    assert sorted(r.v for r in upsert.insert_ignore(new, old, "id").collect()) == ["c", "d"]


def test_upsert_rows(spark):
    t = datetime.datetime
    kind = "k string, v string, created_at timestamp, updated_at timestamp"
    old = spark.createDataFrame([("a", "1", t(2024, 1, 1), t(2024, 1, 1))], kind)
    new = spark.createDataFrame(
        [("a", None, t(2024, 1, 2), t(2024, 1, 2)), ("b", "2", t(2024, 1, 2), t(2024, 1, 2))], kind
    )
    found = sorted(map(tuple, upsert.upsert_rows(old, new, ["k"]).collect()))
    assert found == [
        ("a", None, t(2024, 1, 1), t(2024, 1, 2)), ("b", "2", t(2024, 1, 2), t(2024, 1, 2))
    ]


def test_audit(spark):
    files = spark.createDataFrame(
        [("b", "f1", 3), ("b", "f2", 2), ("b", "f3", None)],
        "batch_id string, file_name string, rows_loaded long",
    )
    stage = spark.createDataFrame(
        [("b", "f1"), ("b", "f1"), ("b", "f3")], "batch_id string, _source_file string"
    )
    assert values(audit.file_audit(files, stage), "file_name", "rows_inserted", "diff") == [
        ("f1", 2, 1), ("f2", 0, 2), ("f3", 1, None)
    ]
    totals = audit.conservation(stage, stage.limit(1), stage.limit(1)).first()
    assert totals.asDict() == {
        "batch_id": "b", "stage_rows": 3, "valid_rows": 1, "invalid_rows": 1, "missing_rows": 1
    }
    assert tuple(audit.key_range(spark.range(0), "id").first()) == (None, None)
    assert tuple(audit.key_range(spark.range(0), "id", empty=0).first()) == (0, 0)
    assert ids.min_key(spark.range(3, 9), "id") == 3 and ids.min_key(spark.range(0), "id") is None


def test_open_work_order_and_limit(spark):
    t = datetime.datetime
    log = spark.createDataFrame(
        [("b", "o", "f2", "SUCCESS", 1, t(2024, 1, 2)), ("b", "o", "f1", "SUCCESS", 1, t(2024, 1, 2)),
         ("b", "o", "f0", "SUCCESS", 1, t(2024, 1, 3)), ("b", "o", "f9", "FAILED", 1, t(2024, 1, 1)),
         ("b", "other", "f8", "SUCCESS", 1, t(2024, 1, 1))],
        "batch_id string, table_name string, file_name string, status string, rows_loaded long,"
        " updated_at timestamp",
    )
    done = log.limit(0).withColumn("stage_table", F.lit("s"))
    work = worklist.open_work(log, done, "o", "s", limit=2).collect()
    assert [r.file_name for r in work] == ["f1", "f2"]


@pytest.mark.parametrize("block", [2, 7, 1 << 16])
def test_numbers_of_sparse_values(spark, block):
    rng = random.Random(block)
    values = [rng.randrange(-(2**52), 2**52) for _ in range(150)] + list(range(40)) + [2**60, -(2**60)]
    rows = [(g, v) for g in "ab" for v in rng.sample(values, 120)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    found = ids.number_rows(df, ["g"], "v", "place", total="all", start=10, block=block, dense=False)
    expected = []
    for k, (g, v) in enumerate(sorted(rows)):
        expected.append((g, v, k % 120 + 1, k + 11))
    assert sorted(tuple(r) for r in found.select("g", "v", "place", "all").collect()) == expected
