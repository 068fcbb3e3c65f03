"""Schema drift: expected columns and types vs. what a table has.

A run compares two schemas that the driver knows: one expression over two
literal arrays (``schema_compare``), with no join and no exchange. For types
found in data, or many tables, both sides are column-catalog rows ``(table_name, ordinal, column_name,
data_type)`` with the type as ``simpleString`` (``bigint``, ``array<int>``,
``decimal(10,2)``). A full outer join on (table, column) finds missing,
unexpected and retyped columns for any number of tables in one job.
Nullability and column order are ignored; names are case-sensitive.
Messages come out in the order: expected columns as declared, then
unexpected columns as they appear in the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycheck.constants import (
    CHECK_SCHEMA,
    MISMATCH_SEPARATOR,
    MSG_MISSING_COLUMN,
    MSG_TYPE_MISMATCH,
    MSG_UNEXPECTED_COLUMN,
    WARN,
)
from tallycheck.functions.status import status_from_count
from tallycheck.operators.coverage import CheckOutput
from tallycheck.schemas import COLUMN_ROW_SCHEMA

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def fill(template: str, **values: Column) -> Column:
    """Fill a ``{name}`` template with columns (``concat`` of its pieces)."""
    parts: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        parts.append(values[m.group(1)])
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def catalog_frame(spark: SparkSession, rows: list[tuple[str, int, str, str]]) -> DataFrame:
    """Catalog rows as an inline literal: built in the JVM, with size
    statistics, so joins against it can be broadcast."""
    if not rows:
        return spark.createDataFrame([], COLUMN_ROW_SCHEMA)
    structs = [
        F.struct(
            F.lit(t).alias("table_name"),
            F.lit(o).cast("int").alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.lit(d).alias("data_type"),
        )
        for t, o, c, d in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def column_rows(
    spark: SparkSession, source: DataFrame | T.StructType, table_name: str
) -> DataFrame:
    """Column catalog rows of a DataFrame's (or a schema's) top-level fields."""
    schema = source.schema if isinstance(source, DataFrame) else source
    rows = [(table_name, i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return catalog_frame(spark, rows)


def expected_rows(
    spark: SparkSession,
    expected: Mapping[str, str] | Iterable[tuple[str, str]],
    table_name: str,
) -> DataFrame:
    """Catalog rows of an expected ``{column: type}`` mapping, in declared order."""
    items = list(expected.items()) if isinstance(expected, Mapping) else list(expected)
    rows = [(table_name, i, name, typ) for i, (name, typ) in enumerate(items)]
    return catalog_frame(spark, rows)


def _compare(actual: DataFrame, expected: DataFrame) -> DataFrame:
    # A table with a repeated column name keeps the first position and the
    # last type for it; rows of one position are types of one column.
    act = actual.groupBy("table_name", "column_name").agg(
        F.min("ordinal").alias("a_ord"),
        F.max("ordinal").alias("a_last"),
        F.collect_set(F.when(F.col("data_type").isNotNull(), F.struct("ordinal", "data_type"))).alias("a_seen"),
    )
    exp = expected.select(
        "table_name", "column_name", F.col("ordinal").alias("e_ord"), F.col("data_type").alias("e_type")
    )
    both = exp.join(act, ["table_name", "column_name"], "full_outer")
    name = F.col("column_name")
    missing = F.col("a_ord").isNull()
    unexpected = F.col("e_type").isNull()
    retyped = F.filter("a_seen", lambda s: (s["ordinal"] == F.col("a_last")) & (s["data_type"] != F.col("e_type")))
    messages = (
        F.when(missing, F.array(fill(MSG_MISSING_COLUMN, column=name)))
        .when(unexpected, F.array(fill(MSG_UNEXPECTED_COLUMN, column=name)))
        .otherwise(
            F.transform(
                retyped,
                lambda s: fill(MSG_TYPE_MISMATCH, column=name, expected=F.col("e_type"), actual=s["data_type"]),
            )
        )
    )
    return both.select(
        "table_name",
        F.when(unexpected, F.lit(1)).otherwise(F.lit(0)).alias("section"),
        F.when(unexpected, F.col("a_ord")).otherwise(F.col("e_ord")).alias("ordinal"),
        F.explode_outer(messages).alias("mismatch"),
    )


def schema_mismatches(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per mismatch: ``table_name, section, ordinal, mismatch``."""
    return _compare(actual, expected).filter(F.col("mismatch").isNotNull())


def schema_tally(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Per table: ``mismatch_count`` and the ordered messages joined with ``"; "``.

    Each group is one table's columns, so its size is bounded by the schema.
    """
    cmp = _compare(actual, expected)
    entry = F.when(F.col("mismatch").isNotNull(), F.struct("section", "ordinal", "mismatch"))
    return cmp.groupBy("table_name").agg(
        F.count("mismatch").alias("mismatch_count"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["mismatch"]),
            MISMATCH_SEPARATOR,
        ).alias("_joined"),
    ).select(
        "table_name",
        "mismatch_count",
        F.when(F.col("mismatch_count") > 0, F.col("_joined")).alias("details"),
    )


def schema_result(actual: DataFrame, expected: DataFrame, severity: str = WARN) -> DataFrame:
    """Per table: ``table_name, check_name, status, mismatch_count, details``."""
    return schema_tally(actual, expected).select(
        "table_name",
        F.lit(CHECK_SCHEMA).alias("check_name"),
        status_from_count("mismatch_count", severity).alias("status"),
        "mismatch_count",
        "details",
    )


def _literal_columns(columns: Iterable[tuple[str, str]]) -> Column:
    """Array of (ordinal, column_name, data_type); of a repeated name the first position with the last type."""
    merged: dict[str, tuple[int, str]] = {}
    for k, (name, kind) in enumerate(columns):
        merged[name] = (merged[name][0] if name in merged else k, kind)
    kind = "array<struct<ordinal:int,column_name:string,data_type:string>>"
    rows = [
        F.struct(F.lit(k).alias("ordinal"), F.lit(n).alias("column_name"), F.lit(t).alias("data_type"))
        for n, (k, t) in merged.items()
    ]
    return F.array(*rows).cast(kind)


def schema_compare(
    spark: SparkSession,
    source: DataFrame | T.StructType,
    expected: Mapping[str, str] | Iterable[tuple[str, str]],
    table_name: str,
) -> DataFrame:
    """One row: ``table_name``, ``mismatches`` (messages in order). A projection over one row."""
    schema = source.schema if isinstance(source, DataFrame) else source
    items = list(expected.items()) if isinstance(expected, Mapping) else list(expected)
    sides = spark.range(0, 1, 1, 1).select(
        F.lit(table_name).alias("table_name"),
        _literal_columns((f.name, f.dataType.simpleString()) for f in schema.fields).alias("actual"),
        _literal_columns(items).alias("expected"),
    )

    def of(side: str, name: Column) -> Column:
        return F.get(F.filter(F.col(side), lambda c: c["column_name"] == name), F.lit(0))["data_type"]

    def declared(e: Column) -> Column:
        found = of("actual", e["column_name"])
        return F.when(found.isNull(), fill(MSG_MISSING_COLUMN, column=e["column_name"])).when(
            found != e["data_type"], fill(MSG_TYPE_MISMATCH, column=e["column_name"], expected=e["data_type"], actual=found)
        )

    def extra(a: Column) -> Column:
        return F.when(of("expected", a["column_name"]).isNull(), fill(MSG_UNEXPECTED_COLUMN, column=a["column_name"]))

    messages = F.concat(F.transform("expected", declared), F.transform("actual", extra))
    return sides.select("table_name", F.filter(messages, lambda m: m.isNotNull()).alias("mismatches"))


def check_schema(
    df: DataFrame,
    expected: Mapping[str, str] | Iterable[tuple[str, str]],
    table_name: str = "table",
    severity: str = WARN,
) -> CheckOutput:
    """Schema check of one DataFrame against ``{column: simpleString type}``.

    ``result`` is one row (``table_name, check_name, status, mismatch_count,
    details``); ``failing`` has one row per mismatch message, in order
    (``section``, ``ordinal``).
    """
    spark = df.sparkSession
    actual, exp = column_rows(spark, df, table_name), expected_rows(spark, expected, table_name)
    return CheckOutput(
        result=schema_result(actual, exp, severity), failing=schema_mismatches(actual, exp)
    )
