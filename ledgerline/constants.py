"""Texts, codes and limits that results must carry exactly."""

# Messages and labels written into rows.
REASON_ID_BLANK = "patent_id为空"
REASON_NO_FULLTEXT = "hasfulltext为0或为空"
REASON_NO_FILE = "hasfulltext是1但publish_file为空"
REASON_DUPLICATE = "重复patent_id"
DESIGN_PATENT = "外观设计"
NOT_CLASSIFIED = "无"
ORIGIN_PCT = "PCT国际申请"
ORIGIN_DOMESTIC = "境内专利"
ORIGIN_FOREIGN = "境外专利"
TYPE_CODE_UNKNOWN = "UNK"
DEFAULT_USER = "etl"

# Codes tested by the rules.
LEGAL_STATUS_DICT = "legal_status"
COUNTRY_PCT = "WO"
COUNTRY_HOME = "CN"
COUNTRIES_MERGED_HOME = ("HK", "TW", "MO")
STRIPPED_PREFIX_TABLE = "a"
STRIPPED_PREFIX = "files/"
ZERO_DATES = ("0000-00-00", "0000-00-00 00:00:00")

# Separators of classification paths.
PATH_SEPARATOR = "$$$"
LEVEL_SEPARATOR = ">"
CODE_SEPARATOR = "^"

# Column lengths of the final invalid table.
INVALID_LENGTHS = {
    "patent_name": 767,
    "intci_code": 255,
    "agent": 50,
    "inventor": 255,
    "appl_province": 10,
}
ERROR_TEXT_LENGTH = 2000
ODD_RECORDS = "have other than 30 fields"

# Collations that stand for the key comparisons (case and accents ignored;
# the first also ignores trailing spaces).
KEY_COLLATION = "UNICODE_CI_AI_RTRIM"
COUNTRY_COLLATION = "UNICODE_CI_AI"

STATUS_OK = "SUCCESS"
STATUS_FAILED = "FAILED"
STATUS_STARTED = "STARTED"
