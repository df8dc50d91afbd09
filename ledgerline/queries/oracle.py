"""The same results in plain SQL, for a comparison engine over the same tables."""

from __future__ import annotations

from .. import constants as C, schemas
from .inputs import DICTIONARY_ROWS, RAW_TEMPLATE, ROWS_TEMPLATE

_CTES: dict[str, str] = {}


def _is_blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}, ' ') = '')"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _date(c: str) -> str:
    t = f"trim({c}, ' ')"
    p = f"replace(replace({t}, '/', '-'), 'T', ' ')"
    day = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
    clock = "([01]?[0-9]|2[0-3])(:|:[0-5]?[0-9]:?|:[0-5]?[0-9]:[0-5]?[0-9].*)?"
    loose = f"[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}([ ]*|[ ]+{clock})"
    return f"""CASE
      WHEN {_is_blank(c)} OR {t} IN ('0000-00-00', '0000-00-00 00:00:00') THEN NULL
      WHEN regexp_full_match({t}, '[0-9]{{8}}') THEN CAST(try_strptime({t}, '%Y%m%d') AS DATE)
      WHEN regexp_full_match(left({p}, 10), '{day}')
        THEN CAST(try_strptime(left({p}, 10), '%Y-%m-%d') AS DATE)
      WHEN regexp_full_match({p}, '{loose}')
        THEN CAST(try_strptime(split_part({p}, ' ', 1), '%Y-%m-%d') AS DATE)
      WHEN regexp_full_match({t}, '[0-9]{{10}}')
        THEN CAST(make_timestamp(TRY_CAST({t} AS BIGINT) * 1000000) AS DATE)
      WHEN regexp_full_match({t}, '[0-9]{{13}}')
        THEN CAST(make_timestamp((TRY_CAST({t} AS BIGINT) // 1000) * 1000000) AS DATE)
      END"""


def _multi(c: str, also: bool = False) -> str:
    text = f"replace(trim({c}, ' '), ',', ';')"
    if also:
        text = f"replace({text}, '%', ';')"
    return rf"nullif(regexp_replace({text}, '[\s\p{{Z}}]*;[\s\p{{Z}}]*', ';', 'g'), '')"


def _append(c: str, message: str) -> str:
    return (
        f"CASE WHEN {_is_blank(c)} THEN '{message}' WHEN contains({c}, '{message}') THEN {c} "
        f"ELSE {c} || ';{message}' END"
    )


def _cte(name: str, sql: str) -> None:
    _CTES[name] = sql


_cte("rows", ROWS_TEMPLATE.format(orders="orders", customer="customer", nation="nation"))
_cte(
    "raw",
    RAW_TEMPLATE.replace(
        "{numbers}",
        "CAST(row_number() OVER (PARTITION BY file ORDER BY k) AS BIGINT) AS _row_num",
    ).format(rows="rows"),
)
for _name, (_columns, _rows) in DICTIONARY_ROWS.items():
    _cte(_name, f"SELECT * FROM (VALUES {_rows}) t({_columns})")

_VALID = f"""CASE WHEN {_is_blank('id')} THEN 0 WHEN hasfulltext IS NULL OR hasfulltext = '0' THEN 0
  WHEN publish_file IS NULL THEN 0 ELSE 1 END"""
_REASON = f"""trim(concat(
  CASE WHEN {_is_blank('id')} THEN '{C.REASON_ID_BLANK};' ELSE '' END,
  CASE WHEN {_is_blank('hasfulltext')} OR trim(hasfulltext, ' ') = '0'
    THEN '{C.REASON_NO_FULLTEXT};' ELSE '' END,
  CASE WHEN trim(hasfulltext, ' ') = '1' AND {_is_blank('publish_file')}
    THEN '{C.REASON_NO_FILE};' ELSE '' END), ';')"""
_NUMBER = "nullif(regexp_replace(upper(trim(patentcode, ' ')), '^CN', ''), '')"
_PUBLICATION = "nullif(upper(trim(publicationno, ' ')), '')"
_FULLTEXT = "CASE trim(hasfulltext, ' ') WHEN '1' THEN 1 WHEN '0' THEN 0 END"
_ZIP = "regexp_matches(applicantaddress, '^[0-9]{6}')"
_ADDRESS = f"""CASE WHEN {_ZIP} THEN trim(substring(applicantaddress, 7), ' ')
  ELSE applicantaddress END"""
_ZIPCODE = f"CASE WHEN {_ZIP} THEN left(applicantaddress, 6) ELSE '' END"
_PROVINCE = f"""CASE WHEN {_is_blank('applicantarea')} THEN NULL
  ELSE split_part(applicantarea, ';', 1) END"""


def _design(c: str) -> str:
    return f"CASE WHEN patenttype = '外观设计' THEN '无' ELSE {c} END"


def _path(base: str, strip_prefix: bool) -> str:
    name = "regexp_replace(publish_file, '^files/', '', 'i')" if strip_prefix else "publish_file"
    return f"CASE WHEN {_is_blank('publish_file')} THEN NULL ELSE concat({base}, {name}) END"


_STATUS_JOIN = """LEFT JOIN dict_mapping s ON r.legalstatus = s.source_value
    AND s.dict_code = 'legal_status' AND s.is_valid = 1"""
_LANGUAGE_JOIN = """LEFT JOIN dict_language u1 ON r.language = u1.iso639_2
  LEFT JOIN dict_language u2 ON r.language = u2.iso639_2_b"""

_cte("stage", f"""SELECT
  row_number() OVER (ORDER BY r._source_file, r._row_num) AS stage_id,
  r.batch_id, 'ods_patents' AS src_table, r._source_file, r._row_num,
  {_VALID} AS is_valid, {_REASON} AS invalid_reason,
  id AS patent_id, trim(title, ' ') AS patent_name, patenttype AS patent_type,
  s.standard_value AS legal_status, legalstatus AS legal_detail_status,
  coalesce(u1.iso639_1, u2.iso639_1) AS language, {_NUMBER} AS patent_no,
  {_date('applicationdate')} AS application_date, left(applicationyear, 4) AS application_year,
  {_multi('applicant')} AS applicant, {_PUBLICATION} AS publication_no,
  {_date('publicationdate')} AS publication_date, left(publishyear, 4) AS publication_year,
  {_design(_multi('classcodelist'))} AS intci_code, {_design('mainclasscode')} AS intci_main_code,
  {_design('mainclassname')} AS intci_main_name, agency, {_multi('agent', True)} AS agent,
  {_multi('inventor')} AS inventor, {_FULLTEXT} AS is_fulltext, publish_file,
  CAST(m.pid AS BIGINT) AS pid, {_path('m.s3_path_base', True)} AS s3_path,
  CAST(NULL AS DOUBLE) AS file_size, m.s3_type, m.bucket_name,
  {_ADDRESS} AS applicant_address, {_ZIPCODE} AS applicant_zipcode,
  CAST(NULL AS VARCHAR) AS application_origin, countryorganization AS appl_country,
  {_PROVINCE} AS appl_province, abstract, signoryitem AS signory_item, validity AS valid_status,
  created_by, updated_by, applicationdate AS application_date_raw,
  publicationdate AS publication_date_raw, mainclassname AS intci_name_raw,
  patenttype AS patent_type_raw, legalstatus AS legal_status_raw, r.language AS language_raw
FROM raw r {_STATUS_JOIN} {_LANGUAGE_JOIN} JOIN dict_pid_s3_map m ON m.table_id = 'a'""")

_cte("path_parts", f"""SELECT name, pos, {_strip('part')} AS part FROM (
  SELECT name, unnest(string_split(name, '$$$')) AS part,
    unnest(range(1, len(string_split(name, '$$$')) + 1)) AS pos
  FROM (SELECT DISTINCT intci_main_name AS name FROM stage
        WHERE is_valid = 1 AND (contains(intci_main_name, '$$$')
          OR contains(intci_main_name, '>'))) n) p""")
_cte("path_sections", f"""SELECT name, pos, part, length(part) AS len,
    length(part) - length(replace(part, '>', '')) + 1 AS depth,
    CASE WHEN code <> '' THEN left(code, 1) WHEN head <> '' THEN head ELSE part END AS section
  FROM (SELECT *, {_strip("split_part(head, '^', 1)")} AS code FROM (
    SELECT *, {_strip("split_part(part, '>', 1)")} AS head
    FROM path_parts WHERE part <> '') h) c""")
_cte("pruned", """SELECT name, string_agg(part, '$$$' ORDER BY seen) AS pruned FROM (
    SELECT *, min(pos) OVER (PARTITION BY name, section) AS seen,
      row_number() OVER (PARTITION BY name, section ORDER BY depth DESC, len DESC, pos) AS place
    FROM path_sections) r WHERE place = 1 GROUP BY name""")
_cte("pathed", f"""SELECT g.* REPLACE (CASE WHEN g.is_valid = 1 AND p.pruned <> ''
    AND p.pruned <> {_strip('p.name')} THEN p.pruned ELSE g.intci_main_name END
    AS intci_main_name)
  FROM stage g LEFT JOIN pruned p ON p.name = g.intci_main_name""")
_REPEATED = f"""SELECT batch_id, upper(rtrim(patent_id, ' ')) AS k, min(stage_id) AS keep_id,
    count(*) AS cnt
  FROM stage WHERE is_valid = 1 AND NOT {_is_blank('patent_id')}
  GROUP BY 1, 2 HAVING count(*) > 1"""
_cte("repeated", _REPEATED)


def _flagged(source: str) -> str:
    return f"""SELECT x.* EXCLUDE (rep) REPLACE (
      CASE WHEN rep THEN 0 ELSE is_valid END AS is_valid,
      CASE WHEN rep THEN {_append('invalid_reason', C.REASON_DUPLICATE)} ELSE invalid_reason END
        AS invalid_reason)
    FROM (SELECT g.*, coalesce(g.is_valid = 1 AND g.stage_id <> d.keep_id, false) AS rep
      FROM {source} g LEFT JOIN repeated d ON d.batch_id = g.batch_id
        AND d.k = upper(rtrim(g.patent_id, ' '))) x"""


def _region(source: str) -> str:
    country = "CASE WHEN appl_country IN ('HK','TW','MO') THEN 'CN' ELSE appl_country END"
    return f"""SELECT x.* EXCLUDE (country_name_cn, hit) REPLACE (
      CASE WHEN is_valid <> 1 THEN appl_province WHEN appl_country = 'WO' THEN NULL
        WHEN hit AND upper(appl_country) <> 'CN' AND {_is_blank('appl_province')}
        THEN country_name_cn ELSE appl_province END AS appl_province,
      CASE WHEN is_valid = 1 THEN {country} ELSE appl_country END AS appl_country,
      CASE WHEN is_valid = 1 AND regexp_full_match(trim(signory_item, ' '), '[0-9]+\\.0+')
        THEN CAST(CAST(CAST(trim(signory_item, ' ') AS DECIMAL(30,10)) AS BIGINT) AS VARCHAR)
        ELSE signory_item END AS signory_item,
      CASE WHEN is_valid <> 1 THEN application_origin
        WHEN {country} = 'WO' THEN 'PCT国际申请' WHEN {country} = 'CN' THEN '境内专利'
        WHEN {_is_blank(country)} THEN NULL ELSE '境外专利' END AS application_origin)
    FROM (SELECT g.*, d.country_name_cn, d.country_code IS NOT NULL AS hit FROM {source} g
      LEFT JOIN dict_country d ON upper(d.country_code) = upper(g.appl_country)) x"""


_cte("flagged", _flagged("pathed"))
_cte("cleaned", _region("flagged"))
_cte("sized", """SELECT * REPLACE (CAST(length(publish_file) * 98765 AS DOUBLE) AS file_size)
  FROM cleaned""")

_PART = [n for n in schemas.PART.fieldNames() if n not in ("id", "created_date", "updated_date")]


def _branch(size: str, where: str) -> str:
    changed = {
        "patent_name": "coalesce(nullif(trim(patent_name, ' '), ''), '')",
        "patent_type": "nullif(trim(patent_type, ' '), '')",
        "legal_status": "nullif(trim(legal_status, ' '), '')",
        "legal_detail_status": "nullif(trim(legal_detail_status, ' '), '')",
        "file_size": size,
    }
    columns = ", ".join(f"{changed.get(n, n)} AS {n}" for n in _PART)
    return f"SELECT stage_id AS id, {columns} FROM sized WHERE {where}"


_cte("valid", _branch("round(file_size / 1024 / 1024, 3)",
                      f"is_valid = 1 AND NOT {_is_blank('patent_id')}"))
_cte("invalid", _branch("file_size", "is_valid = 0"))
_cte("checked", f"""SELECT x.* EXCLUDE (missing) REPLACE (
    CASE WHEN missing THEN 0 ELSE is_valid END AS is_valid,
    CASE WHEN missing THEN {_append('invalid_reason', '文件不存在')} ELSE invalid_reason END
      AS invalid_reason)
  FROM (SELECT *, coalesce(NOT starts_with(publish_file, 'files/'), false) AS missing
    FROM valid) x""")
_USERS = {n: f"coalesce({n}, 'etl')" for n in ("created_by", "updated_by")}


def _final(schema, changed: dict, source: str) -> str:
    changed = {"data_source": "'A'", "publish_year": "publication_year", **_USERS, **changed}
    columns = ", ".join(f"{changed.get(n, n)} AS {n}" for n in schema.fieldNames())
    return f"SELECT {columns} FROM {source}"


_cte("every_invalid", """SELECT * FROM invalid UNION ALL BY NAME SELECT * REPLACE (
    coalesce(created_by, 'etl') AS created_by, coalesce(updated_by, 'etl') AS updated_by)
  FROM checked c WHERE is_valid = 0 AND NOT EXISTS (SELECT 1 FROM invalid i WHERE i.id = c.id)""")
_cte("files", "SELECT batch_id, _source_file, count(*) AS rows_loaded FROM raw GROUP BY 1, 2")
_cte("file_log", """SELECT batch_id, 'ods_patents' AS table_name, _source_file AS file_name,
    CASE WHEN _source_file IN ('f3.csv', 'f9.csv') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    rows_loaded, make_timestamp((1704067200 + rows_loaded % 7 * 3600) * 1000000) AS created_at,
    make_timestamp((1704067200 + rows_loaded % 7 * 3600) * 1000000) AS updated_at
  FROM files""")
_cte("done_log", """SELECT table_name, 'stage_patents' AS stage_table, batch_id, file_name,
    CASE WHEN substring(file_name, 2, 1) = '7' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    rows_loaded, updated_at
  FROM file_log WHERE CAST(substring(file_name, 2, 1) AS INT) % 2 = 0 OR file_name = 'f7.csv'""")
_cte("numbered", """SELECT batch_id, patent_id, patent_name, is_valid, _source_file, _row_num,
    row_number() OVER (PARTITION BY batch_id ORDER BY stage_id) AS stage_id FROM stage""")
_cte("front", "SELECT max(stage_id) AS top FROM numbered WHERE batch_id = 'batch_1'")

_SHIFTED = """SELECT batch_id, patent_id, patent_name, is_valid, _source_file, _row_num,
  stage_id + top AS stage_id{tag} FROM numbered, front WHERE batch_id = 'batch_2'"""
_cte("keyed", RAW_TEMPLATE.replace("{numbers}", "k").format(rows="rows"))
_cte("odd_rows", """SELECT * REPLACE (CASE k % 5 WHEN 0 THEN title || '"' || k || '"' || chr(10) || chr(10)
      || ', and more' || chr(10) WHEN 1 THEN '5" ' || title ELSE title END AS title),
    'k' || lpad(CAST(k // 250 AS VARCHAR), 6, '0') || '.csv' AS file FROM keyed""")
_cte("odd_log", """SELECT file, (min(k) // 250) % 6 AS kind, count(*) AS n,
    count(*) FILTER (k % 50 = 0) AS n50, count(*) FILTER (k % 100 = 0) AS n100, count(*) FILTER (k % 125 = 0) AS n125,
    count(*) FILTER (k % 250 = 249) AS n_open FROM odd_rows GROUP BY file""")
_cte("odd_verdicts", """SELECT file, n, CASE kind WHEN 3 THEN n100 WHEN 4 THEN n125 ELSE 0 END AS odd,
    CASE WHEN kind = 1 AND n_open > 0 THEN 'a quote is never closed'
      WHEN kind = 2 AND n50 > 0 THEN n50 || ' lines that are not valid in UTF-8' END AS bad FROM odd_log""")
_WITHOUT_SIZES = "SELECT * REPLACE (CAST(NULL AS DOUBLE) AS file_size) FROM {}"
_VALID_LOG = "SELECT batch_id, max(id) AS top, count(*) AS n FROM {} GROUP BY 1"
_TEXT_COLUMNS = ", ".join(f"coalesce({n}, '') AS {n}" for n in schemas.RAW_COLUMNS)

_QUERIES = {
    "raw_lineage": "SELECT * FROM raw",
    "validity_flags": f"""SELECT id, hasfulltext, publish_file, {_VALID} AS is_valid,
      {_REASON} AS invalid_reason FROM raw""",
    "date_normalize": f"""SELECT applicationdate, publicationdate,
      {_date('applicationdate')} AS application_date,
      {_date('publicationdate')} AS publication_date,
      left(applicationyear, 4) AS application_year, left(publishyear, 4) AS publication_year
      FROM raw""",
    "multi_value": f"""SELECT patenttype, {_multi('applicant')} AS applicant,
      {_multi('inventor')} AS inventor, {_multi('agent', True)} AS agent,
      {_design(_multi('classcodelist'))} AS intci_code,
      {_design('mainclasscode')} AS intci_main_code,
      {_design('mainclassname')} AS intci_main_name FROM raw""",
    "id_numbers": f"""SELECT patentcode, {_NUMBER} AS patent_no,
      {_PUBLICATION} AS publication_no, {_FULLTEXT} AS is_fulltext FROM raw""",
    "address_split": f"""SELECT applicantaddress, applicantarea, {_ADDRESS} AS applicant_address,
      {_ZIPCODE} AS applicant_zipcode, {_PROVINCE} AS appl_province FROM raw""",
    "object_path": f"""SELECT publish_file, a.pid AS pid_a,
      {_path('a.s3_path_base', True)} AS s3_path_a, d.pid AS pid_d,
      {_path('d.s3_path_base', False)} AS s3_path_d
      FROM raw JOIN dict_pid_s3_map a ON a.table_id = 'a'
      JOIN dict_pid_s3_map d ON d.table_id = 'd'""",
    "legal_status_map": f"""SELECT r.id, r.legalstatus, s.standard_value AS legal_status
      FROM raw r {_STATUS_JOIN}""",
    "language_map": f"""SELECT r.id, r.language AS source_language,
      coalesce(u1.iso639_1, u2.iso639_1) AS language FROM raw r {_LANGUAGE_JOIN}""",
    "standardize_full": "SELECT * FROM stage",
    "assign_ids": """SELECT batch_id, _source_file, _row_num,
      row_number() OVER (ORDER BY _source_file, _row_num) AS stage_id FROM raw""",
    "sparse_numbers": """SELECT *, row_number() OVER (PARTITION BY _source_file ORDER BY seq) AS place,
        row_number() OVER (ORDER BY _source_file, seq) AS place_in_all
      FROM (SELECT batch_id, _source_file, _row_num, _row_num * 7919 % 1000003 * 1000000007 - _row_num AS seq FROM raw) x""",
    "path_prune": """SELECT p.stage_id, p.is_valid, p.intci_main_name,
      g.intci_main_name AS before FROM pathed p JOIN stage g ON g.stage_id = p.stage_id""",
    "dedup_flag": f"""SELECT stage_id, batch_id, patent_id, is_valid, invalid_reason
      FROM ({_flagged('stage')}) f""",
    "dup_keys": "SELECT batch_id, keep_id, cnt FROM repeated",
    "region_fix": f"""SELECT stage_id, is_valid, appl_country, appl_province, signory_item,
      application_origin FROM ({_region('stage')}) f""",
    "clean_full": "SELECT * FROM cleaned",
    "restore_raw": """SELECT stage_id, is_valid, CASE WHEN is_valid = 1 AND intci_name_raw <> ''
      THEN intci_name_raw ELSE intci_main_name END AS intci_main_name, intci_name_raw
      FROM pathed""",
    "top_candidates": """SELECT stage_id, intci_main_name FROM stage WHERE is_valid = 1
      AND (contains(intci_main_name, '$$$') OR contains(intci_main_name, '>'))
      ORDER BY stage_id LIMIT 100""",
    "split_valid": "SELECT * FROM valid",
    "split_invalid": "SELECT * FROM invalid",
    "final_valid": _final(
        schemas.FINAL_VALID,
        {
            "inti_main_type_code":
                "coalesce(nullif(left(trim(intci_main_code, ' '), 3), ''), 'UNK')",
        },
        "checked WHERE is_valid = 1",
    ),
    "final_invalid": _final(
        schemas.FINAL_INVALID,
        {
            "patent_id": "coalesce(patent_id, '')",
            "reason": "invalid_reason",
            "patent_name": "left(patent_name, 767)",
            "intci_code": "left(intci_code, 255)",
            "agent": "left(agent, 50)",
            "inventor": "left(inventor, 255)",
            "appl_province": "left(appl_province, 10)",
        },
        "every_invalid",
    ),
    "shift_ids_rerun": _SHIFTED.format(tag=""),
    "merge_partitions": f"""SELECT *, 'A' AS data_source FROM numbered
      WHERE batch_id = 'batch_1' UNION ALL BY NAME {_SHIFTED.format(tag=", 'D' AS data_source")}""",
    "refresh_in_stock": f"""SELECT g.stage_id AS id, g.batch_id, g.patent_id,
      CASE WHEN g.batch_id = 'batch_1' THEN p.intci_main_name ELSE g.intci_main_name END
        AS intci_main_name
      FROM stage g JOIN pathed p ON p.stage_id = g.stage_id
      WHERE g.is_valid = 1 AND NOT {_is_blank('g.patent_id')}""",
    "open_work": """SELECT 'all_not_success' AS mode, * FROM (
        SELECT l.file_name, l.batch_id, l.rows_loaded FROM file_log l
        LEFT JOIN done_log d ON d.batch_id = l.batch_id AND d.file_name = l.file_name
          AND d.status = 'SUCCESS'
        WHERE l.status = 'SUCCESS' AND d.file_name IS NULL
        ORDER BY l.updated_at, l.file_name LIMIT 50) a
      UNION ALL SELECT 'retry_failed' AS mode, * FROM (
        SELECT file_name, batch_id, rows_loaded FROM done_log WHERE status = 'FAILED'
        ORDER BY updated_at, file_name LIMIT 50) b""",
    "upsert_ledger": """SELECT batch_id, table_name, file_name, 'SUCCESS' AS status, rows_loaded,
      strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
      strftime(CASE WHEN status = 'FAILED' THEN updated_at + INTERVAL 1 DAY ELSE updated_at END,
        '%Y-%m-%d %H:%M:%S') AS updated_at
      FROM (SELECT * FROM file_log UNION ALL SELECT * REPLACE ('f10.csv' AS file_name)
        FROM file_log WHERE file_name = 'f0.csv') l""",
    "delete_files": """SELECT batch_id, _source_file, _row_num, id FROM raw r
      WHERE NOT EXISTS (SELECT 1 FROM file_log l WHERE l.status = 'FAILED'
        AND l.batch_id = r.batch_id AND l.file_name = r._source_file)""",
    "file_audit": """SELECT l.batch_id, l.file_name, l.rows_loaded,
      coalesce(c.n, 0) AS rows_inserted, l.rows_loaded - coalesce(c.n, 0) AS diff
      FROM file_log l LEFT JOIN (SELECT batch_id, _source_file, count(*) AS n FROM stage
        WHERE is_valid = 1 GROUP BY 1, 2) c
      ON c.batch_id = l.batch_id AND c._source_file = l.file_name""",
    "conservation": """SELECT s.batch_id, stage_rows, valid_rows, invalid_rows,
      stage_rows - valid_rows - invalid_rows AS missing_rows
      FROM (SELECT batch_id, count(*) AS stage_rows FROM cleaned GROUP BY 1) s
      JOIN (SELECT batch_id, count(*) AS valid_rows FROM valid GROUP BY 1) v
        ON v.batch_id = s.batch_id
      JOIN (SELECT batch_id, count(*) AS invalid_rows FROM invalid GROUP BY 1) i
        ON i.batch_id = s.batch_id""",
    "key_ranges": """SELECT batch_id, is_valid, min(stage_id) AS min_key,
      max(stage_id) AS max_key FROM stage GROUP BY 1, 2""",
    "run_totals": """SELECT batch_id, count(*) FILTER (status = 'SUCCESS') AS files_ok,
      count(*) FILTER (status = 'FAILED') AS files_failed,
      CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded FROM file_log GROUP BY 1""",
    "ingest_resume": """SELECT 'batch_1' AS batch_id, 'SUCCESS' AS status,
      count(*) AS rows_loaded, 0 AS loaded_twice FROM raw""",
    # A file holds no NULL: empty texts pass the tests for NULL. One batch holds all rows.
    "default_steps": f"""SELECT t.table_name, t.is_valid,
        CASE t.is_valid WHEN 1 THEN c.valid ELSE c.total - c.valid END AS rows
      FROM (SELECT count(*) AS total, count(DISTINCT upper(rtrim(id, ' '))) FILTER (
          NOT {_is_blank('id')} AND coalesce(hasfulltext, '') <> '0') AS valid FROM raw) c,
        (VALUES ('stage_a', 0), ('stage_a', 1), ('in_stock_a', 1), ('unqualified_a', 0),
          ('final_valid', 1), ('final_invalid', 0)) t(table_name, is_valid)""",
    "csv_round_trip": f"SELECT {_TEXT_COLUMNS} FROM raw",
    # A blank line behind every seventh record is a row with empty fields.
    "odd_files": f"""SELECT * EXCLUDE (k, place), row_number() OVER (PARTITION BY _source_file ORDER BY k, place)
        AS _row_num
      FROM (SELECT {_TEXT_COLUMNS}, file AS _source_file, k, 0 AS place FROM odd_rows
        UNION ALL SELECT {", ".join(f"'' AS {n}" for n in schemas.RAW_COLUMNS)}, file, k, 1
        FROM odd_rows WHERE k % 7 = 0) x""",
    "bad_files": """SELECT file AS file_name, CASE WHEN bad IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status,
        CASE WHEN bad IS NULL THEN n END AS rows_loaded, CASE WHEN bad IS NULL THEN n END AS stored,
        nullif(odd, 0) AS odd,
        CASE WHEN bad IS NOT NULL THEN bad WHEN odd > 0 THEN odd || ' records have other than 30 fields' END AS error_message
      FROM odd_verdicts""",
    "two_sources_final": _final(
        schemas.FINAL_VALID,
        {
            "data_source": "'E'",
            "inti_main_type_code":
                "coalesce(nullif(left(trim(intci_main_code, ' '), 3), ''), 'UNK')",
        },
        f"({_WITHOUT_SIZES.format('valid')}) v",
    ),
    "two_sources_invalid": _final(
        schemas.FINAL_INVALID,
        {
            "data_source": "'E'", "patent_id": "coalesce(patent_id, '')", "reason": "invalid_reason",
            **{n: f"left({n}, {size})" for n, size in C.INVALID_LENGTHS.items()},
        },
        f"({_WITHOUT_SIZES.format('invalid')}) v",
    ),
    "run_log": f"""SELECT * FROM (WITH v AS ({_VALID_LOG.format("valid")}), i AS ({_VALID_LOG.format("invalid")}),
        t AS (SELECT * FROM (VALUES ('batch_1', 'a'), ('batch_2', 'd')) x(batch_id, part)),
        e AS (SELECT 'split_in_stock' AS job, 'in_stock_' || part AS target_table, v.* FROM v JOIN t USING (batch_id)
          UNION ALL SELECT 'split_unqualified', 'unqualified_' || part, i.* FROM i JOIN t USING (batch_id)
          UNION ALL SELECT 'failed_checks', 'unqualified_' || part, batch_id, 0, 0 FROM t
          UNION ALL SELECT 'finalize_in_stock_' || part, 'final_valid', v.* FROM v JOIN t USING (batch_id)
          UNION ALL SELECT 'finalize_unqualified_' || part, 'final_invalid', i.* FROM i JOIN t USING (batch_id))
      SELECT batch_id, target_table, 'SUCCESS' AS status, top AS last_key, n AS inserted_rows,
        regexp_replace(job, '_a$', '') AS job FROM e) q""",
    "touched_rows": """SELECT s.stage_id, s.intci_main_name IS DISTINCT FROM c.intci_main_name
        OR s.is_valid <> c.is_valid OR s.invalid_reason IS DISTINCT FROM c.invalid_reason
        OR s.appl_province IS DISTINCT FROM c.appl_province OR s.appl_country IS DISTINCT FROM c.appl_country
        OR s.signory_item IS DISTINCT FROM c.signory_item
        OR s.application_origin IS DISTINCT FROM c.application_origin AS touched
      FROM stage s JOIN cleaned c USING (stage_id)""",
    "key_slice": """SELECT stage_id, _source_file FROM stage WHERE stage_id BETWEEN
      (SELECT min(stage_id) FROM stage WHERE _source_file IN ('f2.csv', 'f4.csv')) AND
      (SELECT max(stage_id) FROM stage WHERE _source_file IN ('f2.csv', 'f4.csv'))""",
    "lowest_open_key": """SELECT batch_id, min(stage_id) AS open_key FROM stage
      WHERE (batch_id, _source_file) NOT IN (SELECT batch_id, file_name FROM done_log WHERE status = 'SUCCESS')
      GROUP BY 1""",
    "resumed_batch": "SELECT * FROM cleaned WHERE batch_id = 'batch_1'",
}


def _complete(sql: str) -> str:
    """The query behind the steps before it; steps that are not used cost nothing."""
    steps = ",\n".join(f"{name} AS ({body})" for name, body in _CTES.items())
    return f"WITH {steps}\n{sql}"


# The encoding makes no difference to the rows.
_QUERIES["encoded_files"] = _QUERIES["odd_files"]

ORACLE = {key: _complete(sql) for key, sql in _QUERIES.items()}
