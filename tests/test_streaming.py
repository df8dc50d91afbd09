import pytest

from ledgerline import schemas
from ledgerline.params import Params
from ledgerline.queries.inputs import dictionaries
from ledgerline.sources.tables import Tables
from ledgerline.streaming import ingest as streaming
from ledgerline.streaming.ingest import start_ingest
from test_jobs import ids_of, line, put


def test_stream_loads_new_files_once(spark, tmp_path):
    tables, params = Tables(spark, str(tmp_path / "tables")), Params(batch_id="s")
    folder, checkpoint = str(tmp_path / "csv"), str(tmp_path / "checkpoint")

    def run():
        start_ingest(tables, dictionaries(spark), params, folder, checkpoint).awaitTermination()
        rows = tables.read(params.stage_table, schemas.STAGE)
        return ids_of(rows, "stage_id", "patent_id", "_source_file", "_row_num")

    put(folder, "f1.csv", line("P1"), line("P2"))
    first = [(1, "P1", "f1.csv", 1), (2, "P2", "f1.csv", 2)]
    assert run() == first
    assert run() == first
    put(folder, "f0.csv", line("P3"))
    assert run() == [*first, (3, "P3", "f0.csv", 1)]


def test_bad_files_and_a_repeated_micro_batch(spark, tmp_path, monkeypatch):
    tables, params = Tables(spark, str(tmp_path / "tables")), Params(batch_id="s")
    folder, checkpoint = str(tmp_path / "csv"), str(tmp_path / "checkpoint")
    put(folder, "f1.csv", line("P1"), line("P2", title='"two\nlines"'))
    put(folder, "open.csv", line("P3", title='"open'))
    stage = streaming.ods_to_stage

    def broken(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(streaming, "ods_to_stage", broken)
    for run in (broken, stage):
        monkeypatch.setattr(streaming, "ods_to_stage", run)
        query = start_ingest(tables, dictionaries(spark), params, folder, checkpoint)
        if run is broken:
            with pytest.raises(Exception, match="lost driver"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    log = tables.read(params.file_log, schemas.FILE_LOG)
    assert ids_of(log, "file_name", "status", "rows_loaded") == [("f1.csv", "SUCCESS", 2), ("open.csv", "FAILED", None)]
    rows = tables.read(params.stage_table, schemas.STAGE)
    assert ids_of(rows, "stage_id", "patent_id", "_row_num") == [(1, "P1", 1), (2, "P2", 2)]
    assert tables.read(params.ods_table, schemas.ODS).count() == 2
    done = tables.read(params.done_log, schemas.DONE_LOG)
    assert ids_of(done, "file_name", "rows_loaded", "rows_inserted") == [("f1.csv", 2, 2)]
