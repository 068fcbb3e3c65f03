"""Schema drift check."""

from pyspark.sql import types as T

from tallycheck.constants import EXPECTED_BRONZE_SCHEMA
from tallycheck.operators.schema_drift import (
    check_schema,
    column_rows,
    expected_rows,
    schema_compare,
    schema_mismatches,
    schema_result,
)
from tallycheck.schemas import BRONZE_SCHEMA


def check(spark, actual_schema, expected):
    a = column_rows(spark, actual_schema, "t")
    e = expected_rows(spark, expected, "t")
    res = schema_result(a, e).collect()[0]
    msgs = [r["mismatch"] for r in sorted(schema_mismatches(a, e).collect(), key=lambda r: (r["section"], r["ordinal"]))]
    # the run's form over literal arrays says the same
    assert schema_compare(spark, actual_schema, expected, "t").first()["mismatches"] == msgs
    return res, msgs


def test_wrong_type(spark):
    schema = T.StructType([T.StructField("views", T.StringType())])
    res, msgs = check(spark, schema, {"views": "bigint"})
    assert msgs == ["Type mismatch on views: expected bigint, got string"]
    assert (res["status"], res["mismatch_count"]) == ("WARN", 1)


def test_bronze_schema_matches(spark):
    res, msgs = check(spark, BRONZE_SCHEMA, EXPECTED_BRONZE_SCHEMA)
    assert msgs == []
    assert (res["status"], res["mismatch_count"], res["details"]) == ("PASS", 0, None)


def test_order_is_ignored_and_case_matters(spark):
    reordered = T.StructType(list(reversed(BRONZE_SCHEMA.fields)))
    assert check(spark, reordered, EXPECTED_BRONZE_SCHEMA)[1] == []
    renamed = T.StructType(
        [T.StructField("Article", T.StringType())] + [f for f in BRONZE_SCHEMA.fields if f.name != "article"]
    )
    res, msgs = check(spark, renamed, EXPECTED_BRONZE_SCHEMA)
    assert msgs == ["Missing column: article", "Unexpected column: Article"]


def test_message_order_and_details(spark):
    schema = T.StructType(
        [
            T.StructField("z_extra", T.IntegerType()),
            T.StructField("b", T.StringType()),
            T.StructField("a", T.LongType()),
            T.StructField("y_extra", T.DoubleType()),
        ]
    )
    expected = {"a": "bigint", "b": "int", "c": "string"}
    res, msgs = check(spark, schema, expected)
    assert msgs == [
        "Type mismatch on b: expected int, got string",
        "Missing column: c",
        "Unexpected column: z_extra",
        "Unexpected column: y_extra",
    ]
    assert res["details"] == "; ".join(msgs)
    assert res["mismatch_count"] == 4


def test_nested_and_decimal_types(spark):
    schema = T.StructType(
        [
            T.StructField("arr", T.ArrayType(T.IntegerType())),
            T.StructField("dec", T.DecimalType(10, 2)),
            T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        ]
    )
    res, msgs = check(spark, schema, {"arr": "array<int>", "dec": "decimal(10,2)", "m": "map<string,bigint>"})
    assert msgs == [] and res["status"] == "PASS"


def test_nullability_is_ignored(spark):
    schema = T.StructType([T.StructField("a", T.LongType(), False)])
    assert check(spark, schema, {"a": "bigint"})[1] == []


def test_repeated_column_name_keeps_last_type(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("a", T.StringType())])
    assert check(spark, schema, {"a": "string"})[1] == []
    assert check(spark, schema, {"a": "int"})[1] == ["Type mismatch on a: expected int, got string"]


def test_many_tables_in_one_job(spark):
    a = column_rows(spark, T.StructType([T.StructField("x", T.LongType())]), "t1").unionByName(
        column_rows(spark, T.StructType([T.StructField("y", T.LongType())]), "t2")
    )
    e = expected_rows(spark, {"x": "bigint"}, "t1").unionByName(expected_rows(spark, {"y": "string"}, "t2"))
    res = {r["table_name"]: (r["status"], r["mismatch_count"]) for r in schema_result(a, e).collect()}
    assert res == {"t1": ("PASS", 0), "t2": ("WARN", 1)}


def test_check_schema_on_a_dataframe(spark):
    df = spark.createDataFrame([("a", "7")], "article string, views string")
    out = check_schema(df, {"article": "string", "views": "bigint"}, "bronze")
    r = out.result.collect()[0]
    assert (r["table_name"], r["check_name"], r["status"], r["mismatch_count"]) == ("bronze", "schema_check", "WARN", 1)
    assert [m["mismatch"] for m in out.failing.collect()] == ["Type mismatch on views: expected bigint, got string"]
