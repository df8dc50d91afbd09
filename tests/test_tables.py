"""Versions of tables: what breaks off leaves no trace, and what is in use is named by the log."""

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.sources.tables import ConcurrentWrite, Tables

SCHEMA = schemas._schema("batch_id kind n:l")
ROWS = [("a", "x", 1), ("a", "y", 2), ("b:1/[2]", "x", 3), (None, "x", 4)]


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(tables, **options):
    return sorted((tuple(r) for r in tables.read("t", SCHEMA, **options).collect()), key=repr)


def test_append_replace_and_empty(spark, tables):
    assert rows_of(tables) == [] and tables.partitions("t") == [] and tables.versions("t", "a") == []
    counts = tables.append(frame(spark, ROWS), "t", "batch_id", top=F.max("n"))
    assert counts == {"rows": 4, "top": 4}
    assert rows_of(tables) == sorted(ROWS, key=repr)
    assert tables.partitions("t") == [("a",), ("b:1/[2]",), (None,)]
    before = tables.versions("t", "a"), tables.versions("t", "b:1/[2]")
    tables.append(frame(spark, [("a", "z", 9)]), "t", "batch_id")
    assert rows_of(tables, only=lambda b: b == "a") == [("a", "x", 1), ("a", "y", 2), ("a", "z", 9)]
    assert tables.versions("t", "a") != before[0] and tables.versions("t", "b:1/[2]") == before[1]
    # A plan that reads the table is written to the same table.
    twice = tables.read("t", SCHEMA).where("batch_id = 'a'").withColumn("n", F.col("n") * 2)
    tables.replace_partitions(twice, "t", "batch_id")
    assert rows_of(tables, only=lambda b: b == "a") == [("a", "x", 2), ("a", "y", 4), ("a", "z", 18)]
    tables.empty_partition("t", "a")
    tables.empty_partition("t", "not there")
    assert rows_of(tables) == sorted(ROWS[2:], key=repr)
    assert tables.append(frame(spark, []), "t", "batch_id")["rows"] == 0
    assert rows_of(tables) == sorted(ROWS[2:], key=repr)


def test_several_partition_columns(spark, tables):
    tables.append(frame(spark, ROWS), "t", ["batch_id", "kind"])
    assert rows_of(tables, only=lambda b, k: k == "x") == sorted((r for r in ROWS if r[1] == "x"), key=repr)
    version = tables.write(frame(spark, [("a", "x", 7)]), "t", ["batch_id", "kind"])
    tables.publish(version, replace=True, gone=lambda b, k: b is None)
    assert rows_of(tables) == [("a", "x", 7), ("a", "y", 2), ("b:1/[2]", "x", 3)]


def test_broken_writes_leave_the_table(spark, tables, monkeypatch):
    tables.append(frame(spark, ROWS), "t", "batch_id")
    before = rows_of(tables)
    bad = frame(spark, [("a", "x", 0)]).withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_partitions(bad, "t", "batch_id")
    assert rows_of(tables) == before
    # Written, but never published.
    tables.write(frame(spark, [("a", "x", 5)]), "t", "batch_id")
    assert rows_of(tables) == before
    # Two runs that start from one entry: the second one is told.
    entries = Tables._entries
    tables.append(frame(spark, [("c", "x", 5)]), "t", "batch_id")
    monkeypatch.setattr(Tables, "_entries", lambda self, name: entries(self, name)[:1])
    with pytest.raises(ConcurrentWrite):
        tables.append(frame(spark, [("c", "x", 6)]), "t", "batch_id")
    monkeypatch.undo()
    assert rows_of(tables) == sorted([*before, ("c", "x", 5)], key=repr)


def test_old_versions_go(spark, tables, tmp_path):
    for n in range(4):
        tables.replace_partitions(frame(spark, [("a", "x", n), ("b" + str(n), "x", n)]), "t", "batch_id")
    open_read = tables.read("t", SCHEMA)
    unpublished = tables.write(frame(spark, [("z", "x", 5)]), "t", "batch_id")
    tables.replace_partitions(frame(spark, [("a", "x", 4)]), "t", "batch_id")
    tables.remove_old(["t", "no such table"])
    folders = list((tmp_path / "tables/t").glob("v=*/batch_id=a"))
    assert len(folders) == 2  # the current one and the one before
    assert open_read.count() == 5
    assert rows_of(tables) == [("a", "x", 4)] + [(f"b{n}", "x", n) for n in range(4)]
    tables.publish(unpublished)
    assert ("z", "x", 5) in rows_of(tables)
