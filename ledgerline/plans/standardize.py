"""Raw rows to Stage: one projection and map-side dictionary joins, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import functions as G, schemas
from ..params import Params
from ..sources.dictionaries import Dictionaries


def standardize(ods: DataFrame, dicts: Dictionaries, params: Params) -> DataFrame:
    """Stage rows without id. Bad rows are flagged with reasons, none is dropped."""
    store = dicts.store_of(params.table_id)
    rows = dicts.with_legal_status(ods, "legalstatus", "_legal_status")
    rows = dicts.with_language(rows, "language", "_language")
    c = F.col

    def classified(value):
        return G.unclassified_if_design(c("patenttype"), value)

    stage = {
        "batch_id": c("batch_id"),
        "src_table": F.lit(params.ods_table),
        "_source_file": c("_source_file"),
        "_row_num": c("_row_num"),
        "is_valid": G.validity_flag(c("id"), c("hasfulltext"), c("publish_file")),
        "invalid_reason": G.validity_reason(c("id"), c("hasfulltext"), c("publish_file")),
        "patent_id": c("id"),
        "patent_name": F.trim("title"),
        "patent_type": c("patenttype"),
        "legal_status": c("_legal_status"),
        "legal_detail_status": c("legalstatus"),
        "language": c("_language"),
        "patent_no": G.number_without_country(c("patentcode")),
        "application_date": G.normalize_date(c("applicationdate")),
        "application_year": G.year_of(c("applicationyear")),
        "applicant": G.multi_value(c("applicant")),
        "publication_no": G.upper_or_null(c("publicationno")),
        "publication_date": G.normalize_date(c("publicationdate")),
        "publication_year": G.year_of(c("publishyear")),
        "intci_code": classified(G.multi_value(c("classcodelist"))),
        "intci_main_code": classified(c("mainclasscode")),
        "intci_main_name": classified(c("mainclassname")),
        "agency": c("agency"),
        "agent": G.multi_value(c("agent"), also="%"),
        "inventor": G.multi_value(c("inventor")),
        "is_fulltext": G.fulltext_flag(c("hasfulltext")),
        "publish_file": c("publish_file"),
        "pid": F.lit(store.pid).cast("bigint"),
        "s3_path": G.object_path(
            F.lit(store.s3_path_base), c("publish_file"), params.table_id
        ),
        "file_size": F.lit(None).cast("double"),
        "s3_type": F.lit(store.s3_type).cast("string"),
        "bucket_name": F.lit(store.bucket_name).cast("string"),
        "applicant_address": G.address_without_zip(c("applicantaddress")),
        "applicant_zipcode": G.zip_of_address(c("applicantaddress")),
        "application_origin": F.lit(None).cast("string"),
        "appl_country": c("countryorganization"),
        "appl_province": G.first_of_list(c("applicantarea")),
        "abstract": c("abstract"),
        "signory_item": c("signoryitem"),
        "valid_status": c("validity"),
        "created_by": c("created_by"),
        "created_date": F.lit(params.run_ts),
        "updated_by": c("updated_by"),
        "updated_date": F.lit(params.run_ts),
        "application_date_raw": c("applicationdate"),
        "publication_date_raw": c("publicationdate"),
        "intci_name_raw": c("mainclassname"),
        "patent_type_raw": c("patenttype"),
        "legal_status_raw": c("legalstatus"),
        "language_raw": c("language"),
    }
    kept = [c(n) for n in rows.columns if n == "stage_id"]
    names = [n for n in schemas.STAGE.fieldNames() if n in stage]
    return G.in_small_methods(rows.select(*kept, *[stage[n].alias(n) for n in names]), "patent_name")
