"""Names, patterns and formats that results depend on."""

from types import MappingProxyType

# Row metadata columns.
PATH = "path"
INGESTION = "ingestionDateTime"
EXTRACT = "extractDateTime"
METADATA_COLUMNS = (PATH, INGESTION, EXTRACT)
RECENCY = (INGESTION, EXTRACT)

# Where a raw path carries its times.
INGESTION_PATTERN = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/hour=(\d{2})/minute=(\d{2})"
EXTRACT_PATTERN = r"(\d{8}-\d{6})"
EXTRACT_FORMAT = "yyyyMMdd-HHmmss"
TIME_UNIT_FORMATS = MappingProxyType(
    {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH", "minute": "mm", "second": "ss"}
)
EARLIEST_MARK = "1900-01-01 00:00:00"

# Characters removed from column names.
NAME_PUNCTUATION = "!\"#$%&'*+,.:;<=>@[\\]^`{|}~"
NAME_PUNCTUATION_WITH_SLASH = "!\"#$%&'*+,./:;<=>@[\\]^`{|}~"

# Partition columns and key format of each date scheme.
PARTITION_KEY = "PartitionKey"
PARTITION_DATE = "PartitionDate"
STRING_PARTITION = "Part"
SCHEME_COLUMNS = MappingProxyType(
    {"YYYY": ("Year",), "YYYYMM": ("Year", "Month"), "YYYYMMDD": ("Year", "Month", "Day")}
)
SCHEME_FORMATS = MappingProxyType({"YYYY": "yyyy", "YYYYMM": "yyyyMM", "YYYYMMDD": "yyyyMMdd"})
DATE_LEVELS = ("Year", "Month", "Week", "day_of_year")
OVERWRITE_ROLES = ("History", "Full")
UPSERT_ROLE = "Recent"
LEGACY_EXTRA_KEYS = ("question_name", "question_value")

# Type conversions; every other type becomes a string.
TYPE_MAP = MappingProxyType(
    {
        "timestamp": "date",
        "timestamp_ntz": "date",
        "bigint": "bigint",
        "int": "int",
        "double": "float",
    }
)

# Form answers.
USER_QUESTIONS = ("H_SupervisingFE", "H_BillingFE", "H_ClientPartner")
USER_ANSWER_PATTERN = r"(\D+)\s(\d+)$"
MATTER_QUESTION = "AM_AssocMatters"
MATTER_ANSWER_PATTERN = r"(\d+\.\d+)"
WORK_TYPE_MARK = "WorkType"
WORK_TYPE_PATTERN = r"MT_WorkType_(.*)"
CAMEL_CASE_BOUNDARY = r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"

# Tables that need an extra step while loading.
COARSE_KEY_TABLES = ("fact_cost",)
SANITISED_TABLES = ("dim_matter_udfs",)
FORM_ANSWER_TABLES = ("formanswers",)
FORM_ANSWER_HTML_COLUMNS = ("AnswerValue", "AnswerDisplayValue")

# Configuration columns that make up one load, and a dataset's header.
GROUP_COLUMNS = (
    "CuratedTableName",
    "ReadRawFileMethod",
    "DataLakePath",
    "DestinationDBExternalSchema",
    "DestinationDBExternalTable",
    "EnrichedBusinessKeyColumnList",
    "DestinationDB",
    "FlatFileRole",
    "DataLakePartition",
)
# Optional columns of a table's configuration, and the columns that JSON tables are configured by.
SEPARATOR, ENCODING, HTML_COLUMNS = "Separator", "Encoding", "HtmlColumnList"
FORM_ANSWERS, COARSEN_KEY, SANITISE_NAMES = "FormAnswers", "CoarsenKey", "SanitiseNames"
OPTIONAL_COLUMNS = (SEPARATOR, ENCODING, HTML_COLUMNS, FORM_ANSWERS, COARSEN_KEY, SANITISE_NAMES)
JSON_COLUMNS = ("JsonTableName", "DataLakePathRaw")
HEADER_COLUMNS = ("DatasetName", "MaxIngestionDateTime", "FlatFileExtension", "SchemaName")

# Rendering.
METADATA_TIME_LENGTH = len("yyyy-MM-dd HH:mm:ss")
SUMMARY_DATE_FORMAT = "dd MMMM yyyy"
EXPORT_DESTINATION = "ConfigDB"
EXTERNAL_SCHEMA_PREFIX = "ext_"
