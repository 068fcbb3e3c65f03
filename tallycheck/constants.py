"""Fixed values that results must reproduce exactly.

Everything below is stated plainly because downstream readers of the audit
table, and the tests, compare these strings and formats byte for byte.
"""

# --- fixed values -----------------------------------------------------------
# Check names written to the audit table.
CHECK_COVERAGE = "source_coverage"
CHECK_DUPLICATES = "duplicate_check"
CHECK_SCHEMA = "schema_check"
# Order of the checks within a run (gate messages list failures in this order).
CHECK_ORDER = (CHECK_COVERAGE, CHECK_DUPLICATES, CHECK_SCHEMA)

# Check statuses.
PASS = "PASS"
WARN = "WARN"
FAIL = "FAIL"

# Layer written for Bronze checks.
LAYER_BRONZE = "bronze"

# Audit row texts.
COVERAGE_DETAILS_PREFIX = "Missing article/date combinations: "
DUPLICATE_DETAILS_PREFIX = "Duplicate article/timestamp combinations: "
DUPLICATE_EXPECTED_VALUE = "0"
SCHEMA_EXPECTED_VALUE = "Expected schema"
SCHEMA_MATCH = "MATCH"
SCHEMA_MISMATCH = "MISMATCH"
SCHEMA_OK_DETAILS = "Schema matches expected schema."

# Schema mismatch messages (Python format strings).
MSG_MISSING_COLUMN = "Missing column: {column}"
MSG_TYPE_MISMATCH = "Type mismatch on {column}: expected {expected}, got {actual}"
MSG_UNEXPECTED_COLUMN = "Unexpected column: {column}"

# Separators for string aggregation.
MISMATCH_SEPARATOR = "; "
FAILED_CHECKS_SEPARATOR = ", "

# Gate message.
GATE_MESSAGE = "Bronze DQ check(s) failed: {checks} (check_run_id={run_id})"

# Day stamp: a string YYYYMMDD followed by a literal "00"; date bounds YYYYMMDD.
DAY_STAMP_PATTERN = "yyyyMMdd'00'"
DATE_BOUND_PATTERN = "yyyyMMdd"

# Pageviews request URL: base, then
# /per-article/{project}/{access}/{agent}/{title}/{granularity}/{start}/{end}
PAGEVIEWS_BASE_URL = "https://wikimedia.org/api/rest_v1/metrics/pageviews"
DEFAULT_PROJECT = "en.wikipedia.org"
DEFAULT_ACCESS = "all-access"
DEFAULT_AGENT = "user"
DEFAULT_GRANULARITY = "daily"

# Default run configuration: ten article titles and January 2026.
DEFAULT_TITLES = (
    "The_Legend_of_Zelda",
    "Super_Mario_Bros.",
    "Minecraft",
    "Fortnite_(video_game)",
    "Grand_Theft_Auto_V",
    "Call_of_Duty:_Modern_Warfare_(2019_video_game)",
    "Among_Us_(video_game)",
    "Cyberpunk_2077",
    "The_Witcher_3:_Wild_Hunt",
    "Red_Dead_Redemption_2",
)
DEFAULT_START = "20260101"
DEFAULT_END = "20260131"

# Expected Bronze schema: column -> simpleString type.
EXPECTED_BRONZE_SCHEMA = {
    "article": "string",
    "granularity": "string",
    "project": "string",
    "timestamp": "string",
    "views": "bigint",
    "_ingested_at": "timestamp",
    "_ingestion_job_run_id": "string",
}
# --- end of fixed values ----------------------------------------------------

# Business key of a Bronze row.
BUSINESS_KEYS = ("article", "timestamp")
