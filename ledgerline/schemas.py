"""Table schemas. Column names and order are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "l": T.LongType(),
    "i": T.IntegerType(),
    "d": T.DateType(),
    "t": T.TimestampType(),
    "f": T.DoubleType(),
}


def _schema(text: str) -> T.StructType:
    """Build a schema from ``name:type`` words; a word without a type is a string column."""
    fields = []
    for word in text.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "s"], True))
    return T.StructType(fields)


# The 30 CSV columns, by position.
RAW = _schema("""
    id title type patenttype legalstatus hasfulltext publish_file applicant applicantaddress
    countryorganization applicantarea patentcode applicationdate applicationyear publicationno
    publicationdate publishyear classcodelist mainclasscode mainclassname agency agent inventor
    abstract signoryitem validity language prioritylist citedcount pdf_url
""")
RAW_COLUMNS = RAW.fieldNames()

# Raw rows with their lineage, as stored.
ODS = _schema(" ".join(RAW_COLUMNS) + " created_by updated_by batch_id _source_file _row_num:l")

# Stage.
STAGE = _schema("""
    stage_id:l batch_id src_table _source_file _row_num:l is_valid:i invalid_reason
    patent_id patent_name patent_type legal_status legal_detail_status language patent_no
    application_date:d application_year applicant publication_no publication_date:d
    publication_year intci_code intci_main_code intci_main_name agency agent inventor
    is_fulltext:i publish_file pid:l s3_path file_size:f s3_type bucket_name applicant_address
    applicant_zipcode application_origin appl_country appl_province abstract signory_item
    valid_status created_by created_date:t updated_by updated_date:t
    application_date_raw publication_date_raw intci_name_raw patent_type_raw legal_status_raw
    language_raw
""")
RAW_COPIES = [c for c in STAGE.fieldNames() if c.endswith("_raw")]

# Partition tables, valid and invalid: Stage without the raw copies, keyed by id.
PART = T.StructType(
    [T.StructField("id", T.LongType())]
    + [f for f in STAGE.fields if f.name not in RAW_COPIES and f.name != "stage_id"]
)

# Final table of valid rows.
FINAL_VALID = _schema("""
    id:l patent_id patent_name patent_type legal_status legal_detail_status language
    application_origin patent_no application_date:d application_year applicant publication_no
    publication_date:d publish_year intci_code intci_main_code inti_main_type_code
    intci_main_name agency agent inventor publish_file pid:l s3_path file_size:f s3_type
    bucket_name applicant_address applicant_zipcode appl_country appl_province abstract
    signory_item valid_status data_source created_by updated_by
""")

# Final table of invalid rows.
FINAL_INVALID = _schema("""
    id:l patent_id patent_name patent_type legal_status legal_detail_status language
    patent_no application_date:d application_year applicant publication_no
    publication_date:d publish_year intci_code intci_main_code intci_main_name agency agent
    inventor is_fulltext:i publish_file pid:l s3_path file_size:f s3_type bucket_name
    applicant_address applicant_zipcode appl_country appl_province reason abstract signory_item
    valid_status data_source created_by updated_by
""")

# Dictionaries.
DICT_MAPPING = _schema("source_value standard_value dict_code is_valid:i")
DICT_LANGUAGE = _schema("iso639_1 iso639_2 iso639_2_b")
DICT_STORE = _schema("table_id pid:l s3_path_base s3_type bucket_name")
DICT_COUNTRY = _schema("country_code country_name_cn")

# Control tables.
FILE_LOG = _schema("""
    batch_id table_name file_name file_path file_size:l file_mtime:t status encoding
    rows_loaded:l error_message created_at:t updated_at:t
""")
FILE_LOG_KEY = ["batch_id", "table_name", "file_name"]

# Records with a number of fields other than that of the columns.
BAD_RECORDS = _schema("batch_id table_name file_name row_num:l record")

DONE_LOG = _schema("""
    table_name stage_table batch_id file_name status rows_loaded:l rows_inserted:l err_msg
    created_at:t updated_at:t
""")
DONE_LOG_KEY = ["table_name", "stage_table", "batch_id", "file_name"]

# Ids of the valid rows of Stage, per load of a batch: key, lowest Stage id, rows.
STAGE_KEYS = _schema("batch_id _key keep_id:l cnt:l")

RUN_LOG = _schema("""
    job_name batch_id target_table status source_version last_key:l scanned_rows:l updated_rows:l
    inserted_rows:l created_at:t updated_at:t
""")
RUN_LOG_KEY = ["job_name", "batch_id", "target_table"]
