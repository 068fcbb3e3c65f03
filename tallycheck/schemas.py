"""Explicit schemas. Nothing in the engine relies on schema inference."""

from pyspark.sql import types as T

ITEM_SCHEMA = T.StructType(
    [
        T.StructField("project", T.StringType()),
        T.StructField("article", T.StringType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("views", T.LongType()),
    ]
)

# One flat record per article and day.
RECORD_SCHEMA = ITEM_SCHEMA

RECORD_COLUMNS = tuple(f.name for f in RECORD_SCHEMA.fields)

LINEAGE_COLUMNS = ("_ingested_at", "_ingestion_job_run_id")

BRONZE_SCHEMA = T.StructType(
    RECORD_SCHEMA.fields
    + [
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_ingestion_job_run_id", T.StringType()),
    ]
)

# Parse schemas of a response body and of one item. ``_corrupt_record`` is filled
# by from_json when the text is not an object or a value does not fit its type.
CORRUPT_COLUMN = "_corrupt_record"
_CORRUPT = T.StructField(CORRUPT_COLUMN, T.StringType())
RESPONSE_BODY_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.StringType())), _CORRUPT])
PARSED_ITEM_SCHEMA = T.StructType([*ITEM_SCHEMA.fields, _CORRUPT])

# A landed fetch attempt: the request (title and date window, optionally a
# page), its attempt number, and what came back.
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("attempt_no", T.LongType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("body", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("check_run_id", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("check_status", T.StringType(), False),
        T.StructField("expected_value", T.StringType(), True),
        T.StructField("actual_value", T.StringType(), True),
        T.StructField("details", T.StringType(), True),
        T.StructField("checked_at", T.TimestampType(), False),
    ]
)

AUDIT_COLUMNS = tuple(f.name for f in AUDIT_SCHEMA.fields)
AUDIT_REQUIRED = tuple(f.name for f in AUDIT_SCHEMA.fields if not f.nullable)

# Columns shown by the latest-run report (no layer, no table_name).
REPORT_COLUMNS = (
    "check_run_id",
    "check_name",
    "check_status",
    "expected_value",
    "actual_value",
    "details",
    "checked_at",
)

# Column catalog rows used by the schema check.
COLUMN_ROW_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
    ]
)


def ddl(schema: T.StructType) -> str:
    """Column list of a schema as DDL text, NOT NULL kept."""
    parts = []
    for f in schema.fields:
        parts.append(
            f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        )
    return ", ".join(parts)
