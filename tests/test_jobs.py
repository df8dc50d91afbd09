import os
from dataclasses import replace
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.params import Params
from ledgerline.plans import ingest as ingest_module, jobs
from ledgerline.plans.ingest import ingest, isolate_failures
from ledgerline.queries.inputs import dictionaries
from ledgerline.sources import csv_files, scratch
from ledgerline.sources.dictionaries import Dictionaries
from ledgerline.sources.scratch import written
from ledgerline.sources.tables import Tables

HEADER = ",".join(schemas.RAW_COLUMNS)


def line(patent_id, title="t", hasfulltext="1", country="CN", tail="", path="A01^x>y"):
    values = dict.fromkeys(schemas.RAW_COLUMNS, "")
    values.update(
        id=patent_id, title=title, hasfulltext=hasfulltext, publish_file="files/1.pdf",
        countryorganization=country, applicationdate="20240105", legalstatus="授权",
        language="zho", mainclassname=path, pdf_url=tail,
    )
    return ",".join(values.values())


def put(folder, name, *lines, end="\n", header_end="\n"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
        f.write(HEADER + header_end + "".join(text + end for text in lines))


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"))


@pytest.fixture
def params():
    return Params(table_id="a", batch_id="batch_1", data_source="A")


def later(params, hours=1):
    return replace(params, run_ts=params.run_ts + timedelta(hours=hours))


def log_of(tables, params):
    rows = tables.read(params.file_log, schemas.FILE_LOG).collect()
    return {r.file_name: (r.status, r.rows_loaded) for r in rows}


def ids_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# ---- CSV ----


def test_read_csv_edges(spark, tmp_path):
    folder = str(tmp_path / "csv")
    quoted = line("P2", title='"a ""q"", b"')
    spread = line("P3", title='"two\nlines"')
    put(folder, "f.csv", line("P1", tail="u"), quoted, spread, "P4,short", header_end="\r\n")
    put(folder, "g 1.csv", line("P5", tail="url"), end="\r\n", header_end="\r\n")
    put(folder, "~$f.csv", line("P9"))
    put(folder, "f.txt", line("P9"))
    rows = csv_files.with_row_numbers(csv_files.read_csv(spark, folder))
    found = {r.id: r for r in rows.collect()}
    assert set(found) == {"P1", "P2", "P3", "P4", "P5"}
    assert found["P2"].title == 'a "q", b' and found["P3"].title == "two\nlines"
    assert found["P4"].title == "short" and found["P4"].type == "" and found["P4"].pdf_url == ""
    assert found["P5"].pdf_url == "url" and found["P5"]._source_file == "g 1.csv"
    assert [found[f"P{i}"]._row_num for i in range(1, 6)] == [1, 2, 3, 4, 1]


def test_large_files_are_split_where_exact(spark, tmp_path):
    folder = str(tmp_path / "csv")
    put(folder, "plain.csv", *[line(f"P{i:04}", title='"x, y"') for i in range(300)])
    put(folder, "multi.csv", *[line(f"Q{i:04}", title='"x\ny"') for i in range(300)])
    files = csv_files.list_files(spark, folder).collect()
    sizes = {f.file_path: f.file_size for f in files}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096b")
    try:
        rows, bad = csv_files.read_files(spark, sizes)
        numbered = rows.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert bad == {} and {r.title for r in numbered} == {"x, y", "x\ny"}
    assert len(numbered) == 600
    assert all(int(r.id[1:]) + 1 == r._row_num for r in numbered)


ODD_NAMES = ("a1.csv", "a[1].csv", "b{x}.csv", "c?d.csv", "e f.csv", "g%20h.csv", "i+j.csv", "_u.csv", ".x.csv")


def test_odd_names_and_blank_lines_at_any_split_size(spark, tables, params, tmp_path):
    folder, found = str(tmp_path / "csv"), {}
    for k, name in enumerate(ODD_NAMES):
        put(folder, name, line(f"P{k}"), "", line(f"Q{k}", title='"x, y"'), "  ", line(f"R{k}", tail="u"), end="\r\n" if k % 2 else "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "256b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            own = replace(params, ods_table=f"ods_{size}")
            ingest(tables, own, folder, "full")
            rows = tables.read(own.ods_table, schemas.ODS)
            found[size] = ids_of(rows, "_source_file", "_row_num", *schemas.RAW_COLUMNS)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found["128m"] == found["256b"]
    places = {(r[2], r[0], r[1]) for r in found["128m"] if r[2].strip()}
    assert places == {
        (f"{c}{k}", name, n) for k, name in enumerate(ODD_NAMES) for c, n in (("P", 1), ("Q", 3), ("R", 5))
    }
    log = log_of(tables, replace(params, ods_table="ods_128m"))
    assert log == {name: ("SUCCESS", 5) for name in ODD_NAMES}


@pytest.mark.parametrize("text,closed", [
    ("a,b,c", True), ('"a","b ""q"" c",d', True), ("", True), (',,"x"\r', True),
    ('a,"open', False), ('a,"x""', False), ('5" pipe,b', True), ('"a"b,c', True), ("a,", True),
])
def test_closed_lines(spark, text, closed):
    row = spark.createDataFrame([(text,)], "v string")
    assert row.select(F.col("v").rlike(csv_files.CLOSED_LINE)).first()[0] is closed


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", ' "q", x ', "line\nend", None), ("", "\\", "；", " pad ")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    csv_files.write_csv(df, str(tmp_path / "out"), single_file=True)
    text = next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8")
    assert text.startswith("a,b,c,d\n")
    back = spark.read.options(header=True, multiLine=True, escape='"', lineSep="\n",
                              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    found = back.csv(str(tmp_path / "out")).fillna("").collect()
    assert sorted(map(tuple, found)) == sorted(tuple(v or "" for v in r) for r in rows)


# ---- ingest ----


def test_ingest_modes(spark, tables, params, tmp_path):
    folder = str(tmp_path / "csv")
    put(folder, "f1.csv", line("P1"), line("P2"))
    put(folder, "f2.csv", line("P3"))
    ingest(tables, params, folder, "full")
    assert log_of(tables, params) == {"f1.csv": ("SUCCESS", 2), "f2.csv": ("SUCCESS", 1)}
    put(folder, "f2.csv", line("P3"), line("P4"))
    put(folder, "f3.csv")
    ingest(tables, later(params), folder, "resume")
    assert log_of(tables, params) == {
        "f1.csv": ("SUCCESS", 2), "f2.csv": ("SUCCESS", 2), "f3.csv": ("SUCCESS", 0)
    }
    ods = tables.read(params.ods_table, schemas.ODS)
    assert ids_of(ods, "id", "_source_file", "_row_num") == [
        ("P1", "f1.csv", 1), ("P2", "f1.csv", 2), ("P3", "f2.csv", 1), ("P4", "f2.csv", 2)
    ]
    log = {r.file_name: r for r in tables.read(params.file_log, schemas.FILE_LOG).collect()}
    assert log["f2.csv"].created_at < log["f2.csv"].updated_at
    assert log["f1.csv"].created_at == log["f1.csv"].updated_at
    assert log["f1.csv"].file_size == os.path.getsize(f"{folder}/f1.csv")
    with pytest.raises(ValueError):
        ingest(tables, params, folder, "again")


def test_unreadable_file_is_logged_and_rerun(spark, tables, params, tmp_path, monkeypatch):
    folder = str(tmp_path / "csv")
    for name in ("a.csv", "b.csv", "c.csv"):
        put(folder, name, line(name))
    read = ingest_module.read_files

    def failing(spark, sizes, encoding):
        if any(p.endswith("b.csv") for p in sizes):
            return spark.read.schema("v string").text(f"{folder}/gone")
        return read(spark, sizes, encoding)

    monkeypatch.setattr(ingest_module, "read_files", failing)
    ingest(tables, params, folder, "full")
    log = log_of(tables, params)
    assert log == {
        "a.csv": ("SUCCESS", 1), "b.csv": ("FAILED", None), "c.csv": ("SUCCESS", 1)
    }
    row = tables.read(params.file_log, schemas.FILE_LOG).where("status = 'FAILED'").first()
    assert "PATH_NOT_FOUND" in row.error_message and len(row.error_message) <= 2000
    monkeypatch.setattr(ingest_module, "read_files", read)
    ingest(tables, later(params), folder, "rerun_failed")
    assert log_of(tables, params)["b.csv"] == ("SUCCESS", 1)
    ods = tables.read(params.ods_table, schemas.ODS)
    assert ids_of(ods, "id", "_row_num") == [("a.csv", 1), ("b.csv", 1), ("c.csv", 1)]


def test_isolate_failures():
    from pyspark.errors import PySparkException

    done = []

    def run(items):
        if 3 in items or 6 in items:
            raise PySparkException("bad")
        done.extend(items)

    failed = isolate_failures(range(8), run)
    assert [item for item, _ in failed] == [3, 6] and sorted(done) == [0, 1, 2, 4, 5, 7]
    assert isolate_failures([], run) == []


def test_failed_file_list(spark, tables, tmp_path):
    log = spark.createDataFrame(
        [("p1", "FAILED", "e1"), ("p2", "SUCCESS", None)],
        "file_path string, status string, error_message string",
    )
    assert csv_files.write_failed_list(log, str(tmp_path / "failed"))
    assert [r.value for r in spark.read.text(str(tmp_path / "failed")).collect()] == ["p1\te1"]
    assert not csv_files.write_failed_list(log.where("false"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_files_are_not_searched_for_every_file(spark, tables, params, monkeypatch):
    """Files that need the second encoding are told apart by name, not by a list of all of them."""
    from pyspark.sql import Row

    compared = []

    def equal(self, other):
        compared.append(1)
        return tuple.__eq__(self, other)

    def undecodable(spark, sizes, encoding):
        return ingest_module.Loaded(None, {os.path.basename(p): f"1 {ingest_module.UNDECODABLE} {encoding}" for p in sizes})

    names = [(f"/in/f{n}.csv", f"f{n}.csv", 1, datetime(2024, 1, 1)) for n in range(500)]
    files = spark.createDataFrame(names, "file_path string, file_name string, file_size long, file_mtime timestamp")
    monkeypatch.setattr(ingest_module, "read_files", undecodable)
    monkeypatch.setattr(Row, "__eq__", equal, raising=False)
    ingest(tables, params, "/in", files=files, encodings=("UTF-8", "GB18030"))
    monkeypatch.undo()
    assert len(compared) < 5000
    log = tables.read(params.file_log, schemas.FILE_LOG)
    assert {r.status for r in log.collect()} == {"FAILED"} and log.count() == 500


def test_many_files_are_looked_up_by_few_tasks(spark, tmp_path):
    os.makedirs(tmp_path / "csv")
    sizes = {}
    for n in range(120):
        path = tmp_path / "csv" / f"f{n:03d}.csv"
        path.write_text(f"{HEADER}\n{line(f'P{n}')}\n", encoding="utf-8")
        sizes[str(path)] = path.stat().st_size
    sc = spark.sparkContext
    sc.setJobGroup("many-files", "many-files")
    try:
        assert csv_files.read_files(spark, sizes).rows.count() == 120
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("many-files") for s in tracker.getJobInfo(j).stageIds]
    infos = [tracker.getStageInfo(s) for s in stages]
    assert max(i.numTasks for i in infos if i) < 100


def test_second_encoding(spark, tables, params, tmp_path):
    folder = str(tmp_path / "csv")
    put(folder, "u.csv", line("P1", title="专利"))
    with open(f"{folder}/l.csv", "w", encoding="latin-1", newline="") as f:
        f.write(HEADER + "\n" + line("P2", title="café").replace("授权", "") + "\n")
    ingest(tables, params, folder, encodings=("UTF-8", "ISO-8859-1"))
    log = tables.read(params.file_log, schemas.FILE_LOG).collect()
    assert {r.file_name: r.encoding for r in log} == {"u.csv": "UTF-8", "l.csv": "ISO-8859-1"}
    ods = tables.read(params.ods_table, schemas.ODS)
    assert ids_of(ods, "id", "title") == [("P1", "专利"), ("P2", "café")]


SPANS = [
    line("P1", title='"two\n\nlines, and ""quotes"""'), "", line("P2", title='5" pipe'), line("P3", tail='"a\nb"'),
    line('"P\n4"', title='"x"y'), line("P5", title='"' + "\n".join(map(str, range(40))) + '"', path='"a ""\n"" b"'),
    "  ", line("P6", title='"a" b,"'.rstrip(',"')), "only,three,fields", line("P7") + ",more", line("P8"),
]


@pytest.mark.parametrize("size", ["128m", "64b"])
def test_records_over_lines_at_any_split_size(spark, tables, params, tmp_path, size):
    folder = str(tmp_path / "csv")
    put(folder, "spans.csv", *SPANS)
    put(folder, "plain.csv", *[x for x in SPANS if "\n" not in x], end="\r\n")
    put(folder, "[s].csv", *SPANS[:3])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        ingest(tables, params, folder, "full")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = tables.read(params.ods_table, schemas.ODS)
    found = {(r._source_file, r._row_num): r for r in rows.collect()}
    ids = ["P1", "", "P2", "P3", "P\n4", "P5", "  ", "P6", "only", "P7", "P8"]
    assert [found["spans.csv", n + 1].id for n in range(11)] == ids
    assert [found["plain.csv", n + 1].id for n in range(7)] == ["", "P2", "  ", "P6", "only", "P7", "P8"]
    assert [found["[s].csv", n + 1].id for n in range(3)] == ids[:3] and len(found) == 21
    first = found["spans.csv", 1]
    assert first.title == 'two\n\nlines, and "quotes"' and first.pdf_url == ""
    assert found["spans.csv", 3].title == '5" pipe' and found["spans.csv", 4].pdf_url == "a\nb"
    assert found["spans.csv", 5].title == '"x"y' and found["spans.csv", 6].title.endswith("38\n39")
    assert found["spans.csv", 6].mainclassname == 'a "\n" b' and found["spans.csv", 9].publish_file == ""
    log = tables.read(params.file_log, schemas.FILE_LOG).collect()
    assert {r.file_name: (r.status, r.rows_loaded, r.error_message) for r in log} == {
        "spans.csv": ("SUCCESS", 11, "2 records have other than 30 fields"),
        "plain.csv": ("SUCCESS", 7, "2 records have other than 30 fields"), "[s].csv": ("SUCCESS", 3, None),
    }
    odd = tables.read(params.bad_records, schemas.BAD_RECORDS)
    assert ids_of(odd, "file_name", "row_num", "record") == [
        ("plain.csv", 5, SPANS[8]), ("plain.csv", 6, SPANS[9]), ("spans.csv", 9, SPANS[8]), ("spans.csv", 10, SPANS[9])
    ]


@pytest.mark.parametrize("size", ["128m", "512b"])
def test_other_encodings_are_read_as_utf_8_is(spark, tmp_path, size):
    rows = [*SPANS, line("P9", title='"专利\n\n, ""利"""'), "", "专,利"]
    sizes = {}
    for encoding in ("UTF-8", "gb18030", "Big5"):
        os.makedirs(tmp_path / encoding)
        path = tmp_path / encoding / "x.csv"
        # A character of two bytes, the second of which is a backslash in Big5.
        body = "\n".join([HEADER, *rows, "功", ""]).replace("授权", "中").replace("专利", "文").replace("专", "文")
        path.write_bytes(body.encode(encoding))
        sizes[encoding] = {str(path): path.stat().st_size}
    bytes_key, charsets_key = "spark.sql.files.maxPartitionBytes", "spark.sql.legacy.javaCharsets"
    old, charsets = spark.conf.get(bytes_key), spark.conf.get(charsets_key, None)
    spark.conf.set(bytes_key, size)
    try:
        found = {e: csv_files.read_files(spark, s, e) for e, s in sizes.items()}
        assert spark.conf.get(charsets_key, None) == charsets
        rows_of = {e: sorted(map(str, x.rows.collect())) for e, x in found.items()}
        ascii_only = csv_files.read_files(spark, sizes["Big5"], "US-ASCII").bad_files
    finally:
        spark.conf.set(bytes_key, old)
    assert len(rows_of["UTF-8"]) == 15 and all(x.bad_files == {} for x in found.values())
    assert all(x == rows_of["UTF-8"] for x in rows_of.values())
    assert ascii_only["x.csv"].endswith("lines that are not valid in US-ASCII")


def test_utf_16_is_read_by_whole_files(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_bytes("\n".join([HEADER, line("P1", title='"专\n利"'), line("P2")]).encode("utf-16"))
    found = csv_files.read_files(spark, {str(path): path.stat().st_size}, "UTF-16")
    assert ids_of(found.rows, "_row_num", "id", "title") == [(1, "P1", "专\n利"), (2, "P2", "t")]
    assert found.bad_files == {}


def test_bad_files_fail_and_are_listed(spark, tables, params, tmp_path):
    folder = str(tmp_path / "csv")
    put(folder, "good.csv", line("P1"), "a,b")
    put(folder, "open.csv", line("P2"), line("P3", title='"open'), line("P4"))
    put(folder, "short.csv", "a,b", "c,d,e")
    with open(f"{folder}/gbk.csv", "wb") as f:
        f.write(f"{HEADER}\n{line('P5', title='专利')}\n{line('P6')}\n".encode("gbk"))
    ingest(tables, params, folder, "full")
    log = {r.file_name: r for r in tables.read(params.file_log, schemas.FILE_LOG).collect()}
    assert {k: (r.status, r.rows_loaded, r.error_message) for k, r in log.items()} == {
        "good.csv": ("SUCCESS", 2, "1 records have other than 30 fields"),
        "open.csv": ("FAILED", None, "a quote is never closed"),
        "gbk.csv": ("FAILED", None, "2 lines that are not valid in UTF-8"),
        "short.csv": ("SUCCESS", 2, "2 records have other than 30 fields"),
    }
    listed = spark.read.text(f"{tables.path('failed_files')}/{params.batch_id}").collect()
    assert sorted(r.value.split("\t")[1] for r in listed) == sorted(
        r.error_message for r in log.values() if r.status == "FAILED"
    )
    ods = tables.read(params.ods_table, schemas.ODS)
    assert {i for i, in ids_of(ods, "id")} == {"P1", "a", "c"}
    # Mended files land with the next run, and their odd records give way.
    put(folder, "open.csv", line("P2"), line("P3", title='"closed"'), line("P4"))
    put(folder, "short.csv", line("P9"), "x,y")
    ingest(tables, later(params), folder, "resume")
    ods = tables.read(params.ods_table, schemas.ODS)
    assert ids_of(ods, "_source_file", "id") == [
        ("good.csv", "P1"), ("good.csv", "a"), ("open.csv", "P2"), ("open.csv", "P3"), ("open.csv", "P4"),
        ("short.csv", "P9"), ("short.csv", "x"),
    ]
    odd = tables.read(params.bad_records, schemas.BAD_RECORDS)
    assert ids_of(odd, "file_name", "row_num", "record") == [("good.csv", 2, "a,b"), ("short.csv", 2, "x,y")]
    assert log_of(tables, params)["gbk.csv"] == ("FAILED", None)


# ---- steps ----


@pytest.fixture
def loaded(spark, tables, params, tmp_path):
    folder = str(tmp_path / "csv")
    put(folder, "f1.csv", line("P1", path="A>b$$$A"), line("p1"), line("", country="HK"))
    put(folder, "f2.csv", line("P2", country="us"), line("P3", hasfulltext="0"))
    ingest(tables, params, folder)
    return folder


ALL = "ods2stage,stage_clean,stage_split,final_instock,final_unqualified"


def state(tables, params):
    return {
        name: sorted(map(str, tables.read(name, schema).collect()))
        for name, schema in (
            (params.stage_table, schemas.STAGE), (params.valid_table, schemas.PART),
            (params.invalid_table, schemas.PART),
            (params.final_valid_table, schemas.FINAL_VALID),
            (params.final_invalid_table, schemas.FINAL_INVALID),
        )
    }


def test_all_steps_and_a_second_run(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert ids_of(stage, "stage_id", "patent_id", "is_valid", "invalid_reason") == [
        (1, "P1", 1, ""), (2, "p1", 0, "重复patent_id"), (3, "", 0, "patent_id为空"),
        (4, "P2", 1, ""), (5, "P3", 0, "hasfulltext为0或为空"),
    ]
    valid = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(valid, "id", "intci_main_name", "appl_province", "application_origin") == [
        (1, "A>b", None, "境内专利"), (4, "A01^x>y", "美国", "境外专利"),
    ]
    invalid = tables.read(params.final_invalid_table, schemas.FINAL_INVALID)
    assert ids_of(invalid, "id", "reason", "data_source") == [
        (2, "重复patent_id", "A"), (3, "patent_id为空", "A"), (5, "hasfulltext为0或为空", "A"),
    ]
    done = tables.read(params.done_log, schemas.DONE_LOG).collect()
    assert sorted((r.file_name, r.status, r.rows_loaded, r.rows_inserted) for r in done) == [
        ("f1.csv", "SUCCESS", 3, 3), ("f2.csv", "SUCCESS", 2, 2)
    ]
    before = state(tables, params)
    jobs.run_steps(tables, dicts, later(params), ALL)
    jobs.clean_stage(tables, dicts, later(params, 2), again=True)
    jobs.split_stage(tables, later(params, 2), again=True)
    assert state(tables, params) == before


def test_new_files_get_the_next_ids(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.ods_to_stage(tables, dicts, replace(params, max_files=1))
    put(loaded, "f0.csv", line("P0"))
    ingest(tables, later(params), loaded, "resume")
    jobs.ods_to_stage(tables, dicts, later(params))
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert [i for i, in ids_of(stage, "stage_id")] == [1, 2, 3, 4, 5, 6]
    assert ids_of(stage, "patent_id", "_source_file")[-1] == ("p1", "f1.csv")


def test_leftovers_of_a_broken_run_are_replaced(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.ods_to_stage(tables, dicts, params)
    # The log is lost after the rows were written.
    failed = tables.read(params.done_log, schemas.DONE_LOG).withColumn("status", F.lit("FAILED"))
    tables.upsert(failed, params.done_log, schemas.DONE_LOG, schemas.DONE_LOG_KEY)
    jobs.ods_to_stage(tables, dicts, later(params))
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert stage.count() == 5
    done = tables.read(params.done_log, schemas.DONE_LOG)
    assert done.where("status = 'SUCCESS'").count() == 2
    retry = replace(params, mode="retry_failed")
    jobs.ods_to_stage(tables, dicts, retry)
    assert tables.read(params.stage_table, schemas.STAGE).count() == 5


def test_repeated_dictionary_entries_multiply_rows_with_own_ids(spark, tables, params, loaded):
    base = dictionaries(spark)
    twice = Dictionaries(base.mapping.unionByName(base.mapping.where("source_value = '授权'")
                         .withColumn("standard_value", F.lit("zz"))),
                         base.language, base.store, base.country)
    assert twice.multiplies_rows() and not base.multiplies_rows()
    jobs.ods_to_stage(tables, twice, params)
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert [i for i, in ids_of(stage, "stage_id")] == list(range(1, 11))
    assert ids_of(stage, "stage_id", "_source_file", "_row_num", "legal_status")[:2] == [
        (1, "f1.csv", 1, "zz"), (2, "f1.csv", 1, "有效")
    ]


def test_store_entry_must_be_single(spark, params):
    base = dictionaries(spark)
    with pytest.raises(ValueError, match="no store entry"):
        base.store_of("q")
    twice = Dictionaries(base.mapping, base.language, base.store.unionByName(base.store),
                         base.country)
    with pytest.raises(ValueError, match="more than one"):
        twice.store_of("a")


def test_file_check_results_go_to_the_invalid_tables(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params)
    rows = tables.read(params.valid_table, schemas.PART)
    failed = rows.withColumns({
        "is_valid": F.when(F.col("id") == 4, 0).otherwise(F.col("is_valid")),
        "invalid_reason": F.when(F.col("id") == 4, "文件损坏").otherwise(F.col("invalid_reason")),
    })
    tables.replace_partitions(failed, params.valid_table, "batch_id")
    for _ in range(2):
        jobs.run_steps(tables, dicts, params, "final_instock,final_unqualified")
    valid = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    invalid = tables.read(params.final_invalid_table, schemas.FINAL_INVALID)
    assert ids_of(valid, "id") == [(1,)]
    assert ids_of(invalid, "id", "reason")[2] == (4, "文件损坏")
    assert tables.read(params.valid_table, schemas.PART).count() == 2


def test_partition_behind_another(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params)
    other = replace(params, stage_table="stage_d", valid_table="in_stock_d",
                    invalid_table="unqualified_d", data_source="D", table_id="d")
    jobs.run_steps(tables, dicts, other)
    for _ in range(2):
        jobs.place_behind(tables, other, params.stage_table)
        stage = tables.read("stage_d", schemas.STAGE)
        assert [i for i, in ids_of(stage, "stage_id")] == [6, 7, 8, 9, 10]
        assert ids_of(tables.read("in_stock_d", schemas.PART), "id") == [(6,), (9,)]
        assert ids_of(tables.read("unqualified_d", schemas.PART), "id") == [(7,), (8,), (10,)]
    third = replace(other, stage_table="stage_e", start_after=("stage_d",))
    jobs.ods_to_stage(tables, dicts, third)
    assert ids_of(tables.read("stage_e", schemas.STAGE), "stage_id")[0] == (11,)


def test_restore_and_refresh(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params)
    jobs.restore_raw_names(tables, params)
    names = ids_of(tables.read(params.stage_table, schemas.STAGE), "stage_id", "intci_main_name")
    assert names[0] == (1, "A>b$$$A")
    valid = tables.read(params.valid_table, schemas.PART)
    assert ids_of(valid, "id", "intci_main_name")[0] == (1, "A>b")
    jobs.refresh_valid_names(tables, params)
    valid = tables.read(params.valid_table, schemas.PART)
    assert ids_of(valid, "id", "intci_main_name")[0] == (1, "A>b$$$A")


def test_split_after_a_key(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params)
    before = state(tables, params)
    jobs.split_stage(tables, replace(params, min_key=2), again=True)
    assert state(tables, params) == before


def test_rows_added_to_a_finished_batch(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    checked = tables.read(params.valid_table, schemas.PART).withColumn(
        "is_valid", F.when(F.col("id") == 4, 0).otherwise(F.col("is_valid"))
    )
    tables.replace_partitions(written(checked, "checked"), params.valid_table, "batch_id")
    put(loaded, "f3.csv", line("P7"), line("P1"))
    ingest(tables, later(params), loaded, "resume")
    jobs.run_steps(tables, dicts, later(params), ALL)
    valid = tables.read(params.valid_table, schemas.PART)
    assert ids_of(valid, "id", "patent_id", "is_valid") == [
        (1, "P1", 1), (4, "P2", 0), (6, "P7", 1)
    ]
    final = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(final, "id") == [(1,), (4,), (6,)]
    final = tables.read(params.final_invalid_table, schemas.FINAL_INVALID)
    assert ids_of(final, "id") == [(2,), (3,), (4,), (5,), (7,)]
    before = state(tables, params)
    jobs.run_steps(tables, dicts, later(params, 2), ALL)
    assert state(tables, params) == before


def test_a_replaced_file_goes_through(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    put(loaded, "f2.csv", line("P8"), line("P9"), line("P10"))
    ingest(tables, later(params), loaded, "resume")
    jobs.run_steps(tables, dicts, later(params), ALL)
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert ids_of(stage, "stage_id", "patent_id")[3:] == [(6, "P8"), (7, "P9"), (8, "P10")]
    final = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(final, "id") == [(1,), (6,), (7,), (8,)]
    final = tables.read(params.final_invalid_table, schemas.FINAL_INVALID)
    assert ids_of(final, "id") == [(2,), (3,)]


def test_clashing_ids_in_final_tables(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    other = replace(params, stage_table="stage_d", valid_table="in_stock_d",
                    invalid_table="unqualified_d", data_source="D", table_id="d")
    jobs.run_steps(tables, dicts, other)
    before = state(tables, params)
    for step in ("final_instock", "final_unqualified"):
        with pytest.raises(ValueError, match="ids of final"):
            jobs.run_steps(tables, dicts, other, step)
    assert state(tables, params) == before
    jobs.place_behind(tables, other, params.stage_table)
    jobs.run_steps(tables, dicts, other, "final_instock,final_unqualified")
    final = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(final, "id", "data_source") == [(1, "A"), (4, "A"), (6, "D"), (9, "D")]


def test_a_larger_partition_moves_and_goes_on_after_a_break(
    spark, tables, params, loaded, monkeypatch
):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params)
    first = spark.createDataFrame(
        tables.read(params.stage_table, schemas.STAGE).limit(2).collect(), schemas.STAGE
    ).withColumn("stage_id", F.col("stage_id") % 2 + 1)
    tables.append(first, "stage_front", "batch_id")
    swaps = []

    def broken(tables_, name, rows, swap=jobs._swap_batch):
        swap(tables_, name, rows)
        swaps.append(name)
        if len(swaps) == 2:
            raise RuntimeError("lost driver")

    monkeypatch.setattr(jobs, "_swap_batch", broken)
    with pytest.raises(RuntimeError):
        jobs.place_behind(tables, params, "stage_front")
    for _ in range(2):
        jobs.place_behind(tables, later(params), "stage_front")
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert [i for i, in ids_of(stage, "stage_id")] == [3, 4, 5, 6, 7]
    assert ids_of(tables.read(params.valid_table, schemas.PART), "id") == [(3,), (6,)]
    assert ids_of(tables.read(params.invalid_table, schemas.PART), "id") == [(4,), (5,), (7,)]


def test_scratch_folder_needs_a_shared_one(spark, monkeypatch):
    settings = {"spark.checkpoint.dir": None, "spark.master": "spark://host:7077"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: settings[k]))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_folder(session, "x")
    settings["spark.master"] = "local[2]"
    assert scratch.scratch_folder(session, "x")


def test_unknown_step_and_mode(spark, tables, params):
    with pytest.raises(ValueError, match="unknown steps"):
        jobs.run_steps(tables, dictionaries(spark), params, "ods2stage,nothing")
    with pytest.raises(ValueError):
        Params(mode="sometimes")
    with pytest.raises(ValueError):
        Params(rules=("path", "other"))


# ---- versions, origins and audits ----


def other_partition(params, **changed):
    return replace(
        params, batch_id="batch_2", ods_table="ods_d", stage_table="stage_d", valid_table="in_stock_d",
        invalid_table="unqualified_d", start_after=(params.stage_table,), **changed,
    )


def test_two_partitions_of_one_source(spark, tables, params, loaded, tmp_path):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    before = state(tables, params)
    other = other_partition(params)
    folder = str(tmp_path / "csv_d")
    put(folder, "d1.csv", line("Q1"), line("", country="HK"))
    ingest(tables, other, folder)
    jobs.run_steps(tables, dicts, other, ALL)
    after = state(tables, params)
    for name in (params.final_valid_table, params.final_invalid_table):
        assert set(before[name]) < set(after[name])
    valid = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(valid, "id", "data_source") == [(1, "A"), (4, "A"), (6, "A")]
    # A replaced file of one partition takes its own rows along, and no others.
    put(folder, "d1.csv", line("Q2"))
    ingest(tables, later(other), folder, "resume")
    jobs.run_steps(tables, dicts, later(other), ALL)
    valid = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(valid, "id", "patent_id") == [(1, "P1"), (4, "P2"), (8, "Q2")]
    invalid = tables.read(params.final_invalid_table, schemas.FINAL_INVALID)
    assert ids_of(invalid, "id") == [(2,), (3,), (5,)]


def test_a_grown_batch_reads_new_rows_only(spark, tables, params, loaded, monkeypatch):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    old = tables.versions(params.stage_table, params.batch_id)
    put(loaded, "f3.csv", line("p1 "), line("P7"), line("P7"), line("P2", hasfulltext="0"))
    ingest(tables, later(params), loaded, "resume")
    seen = []
    clean = jobs.rules.clean

    def watched(rows, *args):
        seen.append(rows.count())
        return clean(rows, *args)

    monkeypatch.setattr(jobs.rules, "clean", watched)
    jobs.run_steps(tables, dicts, later(params), ALL)
    assert seen == [4]
    assert tables.versions(params.stage_table, params.batch_id)[: len(old)] == old
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert ids_of(stage, "stage_id", "patent_id", "is_valid")[5:] == [
        (6, "p1 ", 0), (7, "P7", 1), (8, "P7", 0), (9, "P2", 0)
    ]
    row = stage.where("stage_id = 6").first()
    assert row.invalid_reason == "重复patent_id"
    log = tables.read(params.run_log, schemas.RUN_LOG).where("job_name = 'clean_stage_a_v1'").first()
    assert (log.scanned_rows, log.last_key) == (4, 9)
    final = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(final, "id") == [(1,), (4,), (7,)]


def test_rows_that_go_nowhere_stop_the_split(spark, tables, params, loaded):
    dicts = dictionaries(spark)
    jobs.run_steps(tables, dicts, params, ALL)
    before = state(tables, params)
    rows = tables.read(params.stage_table, schemas.STAGE)
    lost = rows.withColumn("is_valid", F.when(F.col("stage_id") == 1, None).otherwise(F.col("is_valid")))
    tables.replace_partitions(lost, params.stage_table, "batch_id")
    with pytest.raises(jobs.AuditError, match="1 of 5 rows"):
        jobs.split_stage(tables, later(params))
    log = tables.read(params.run_log, schemas.RUN_LOG).where("status = 'FAILED'")
    assert ids_of(log, "target_table", "scanned_rows", "inserted_rows") == [("in_stock_a", 5, 4), ("unqualified_a", 5, 4)]
    after = state(tables, params)
    assert {k: v for k, v in after.items() if k != params.stage_table} == {
        k: v for k, v in before.items() if k != params.stage_table
    }


def test_a_run_that_breaks_off_anywhere_goes_on(spark, tables, params, loaded, monkeypatch):
    dicts = dictionaries(spark)
    commit, calls = Tables._commit, []

    def breaking(at):
        def run(self, name, number, new):
            calls.append(name)
            if len(calls) == at:
                raise RuntimeError("lost driver")
            commit(self, name, number, new)
        return run

    for at in (1, 2, 4, 8, 13):
        calls.clear()
        before = state(tables, params)
        monkeypatch.setattr(Tables, "_commit", breaking(at))
        try:
            jobs.run_steps(tables, dicts, params, ALL)
            break
        except RuntimeError:
            pass
        finally:
            monkeypatch.undo()
        if at == 1:
            assert state(tables, params) == before
    jobs.run_steps(tables, dicts, params, ALL)
    stage = tables.read(params.stage_table, schemas.STAGE)
    assert ids_of(stage, "patent_id", "is_valid") == [("", 0), ("P1", 1), ("P2", 1), ("P3", 0), ("p1", 0)]
    final = tables.read(params.final_valid_table, schemas.FINAL_VALID)
    assert ids_of(final, "patent_id") == [("P1",), ("P2",)]
    assert tables.read(params.final_invalid_table, schemas.FINAL_INVALID).count() == 3


def test_a_replaced_file_rewrites_only_its_version(spark, tables, params, loaded):
    put(loaded, "f3.csv", line("P7"))
    ingest(tables, later(params), loaded, "resume")
    first, second = tables.versions(params.ods_table, params.batch_id)
    put(loaded, "f3.csv", line("P8"), line("P9"))
    ingest(tables, later(params, 2), loaded, "resume")
    versions = tables.versions(params.ods_table, params.batch_id)
    assert first in versions and second not in versions
    ods = tables.read(params.ods_table, schemas.ODS)
    assert ids_of(ods.where("_source_file = 'f3.csv'"), "id", "_row_num") == [("P8", 1), ("P9", 2)]
    assert ods.count() == 7
