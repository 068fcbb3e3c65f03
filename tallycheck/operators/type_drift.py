"""Type drift over data: the types of JSON values in all rows against a declared schema.

A value has a family (number, string, boolean, array, object) and a place in a lattice: whole numbers lie below the decimals that
hold them, decimals below ``double``; JSON nulls lie below everything. The least type of a family's values is known from
counts, least and greatest values, and most digits, so it merges by plain aggregates: one map-side step, one exchange of one row per (path,
family), never a row per distinct type. Values of two families have no common type and stay apart, each with its rows.

Declared types may be nested. Their fields are checked under paths (``pos.x``; ``list[]`` for elements), which come from the
declaration, so their number has a bound; names that nobody declared are reported one by one (``failing``) or counted (``result``).

Rules: ``double`` and ``float`` hold every number; ``decimal(p,s)`` those with p - s digits before and s after the point; integer types the
whole numbers in their range; ``map<string,t>`` an object whose values all fit t; ``variant`` anything. A null text has no keys. A text that is not one JSON
object (broken, another value, a repeated key) is an unparsable row; these are counted. Names are case-sensitive.
"""

from __future__ import annotations

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
from tallycheck.operators.schema_drift import fill

MSG_UNPARSABLE = "Unparsable rows: {count}"
MSG_UNEXPECTED_COUNT = "Unexpected columns: {count}"

NUMBER, STRING, BOOLEAN, ARRAY, OBJECT, NULL, UNPARSABLE = "number", "string", "boolean", "array", "object", "null", "unparsable"

_INTEGERS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
#: Digits that a decimal can have.
_DIGITS = 38


def declared_paths(expected: Mapping[str, str] | Iterable[tuple[str, str]]) -> list[tuple[str, T.DataType]]:
    """Every declared path with its type, parents before their fields, in declared order."""
    items = expected.items() if isinstance(expected, Mapping) else expected
    out: list[tuple[str, T.DataType]] = []

    def add(path: str, kind: T.DataType) -> None:
        out.append((path, kind))
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                add(f"{path}.{f.name}", f.dataType)
        elif isinstance(kind, T.ArrayType):
            add(f"{path}[]", kind.elementType)
        elif isinstance(kind, T.MapType):
            add(f"{path}{{}}", kind.valueType)

    for name, text in items:
        add(name, T.DataType.fromDDL(text))
    return out


def _entry(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"))


def _members(value: Column) -> Column:
    """Names and values of an object; NULL for any other value."""
    return F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))


def _with_nested(path: str, value: Column, kind: T.DataType) -> Column:
    """Entries of a value of a declared path and of all it holds under declared containers."""
    own = F.array(_entry(F.lit(path), value))
    none = F.array().cast("array<struct<path:string,value:variant>>")
    if isinstance(kind, T.StructType):
        def member(m: Column) -> Column:
            found = F.array(_entry(F.concat(F.lit(f"{path}."), m["key"]), m["value"]))
            for f in kind.fields:
                found = F.when(m["key"] == f.name, _with_nested(f"{path}.{f.name}", m["value"], f.dataType)).otherwise(found)
            return found

        inner = F.flatten(F.transform(_members(value), member))
    elif isinstance(kind, T.ArrayType):
        elements = F.try_variant_get(value, "$", "array<variant>")
        inner = F.flatten(F.transform(elements, lambda x: _with_nested(f"{path}[]", x, kind.elementType)))
    elif isinstance(kind, T.MapType):
        inner = F.flatten(F.transform(_members(value), lambda m: _with_nested(f"{path}{{}}", m["value"], kind.valueType)))
    else:
        return own
    return F.concat(own, F.coalesce(inner, none))


def _entries(text: Column, expected: list[tuple[str, T.DataType]]) -> Column:
    """Entries of a row: one per key, and those inside declared containers; a NULL path for a text that is no object."""
    top = [(p, t) for p, t in expected if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) and not any(p.startswith((f"{q}.", f"{q}[", f"{q}{{")) for q, _ in expected)]

    def member(m: Column) -> Column:
        found = F.array(_entry(m["key"], m["value"]))
        for path, kind in top:
            found = F.when(m["key"] == path, _with_nested(path, m["value"], kind)).otherwise(found)
        return found

    broken = F.array(_entry(F.lit(None).cast("string"), F.lit(None).cast("variant")))
    members = _members(F.try_parse_json(text))
    # an object without keys gives nothing; a text that is no object gives the NULL path
    return F.when(text.isNotNull(), F.coalesce(F.flatten(F.transform(members, member)), broken))


def type_profile(df: DataFrame, json_column: str, expected: Mapping[str, str] | Iterable[tuple[str, str]] = ()) -> DataFrame:
    """One row per (path, family) of the values in ``json_column``: the least type that holds them, and how many there are.

    Columns: path (NULL for unparsable rows), family, data_type, rows, and what the type was made of: whole (no value has a fraction),
    exact (no value is a double), lo and hi (of whole numbers), before and after (most digits around the point).
    """
    paths = declared_paths(expected)
    values = df.select(F.explode(_entries(F.col(json_column), paths)).alias("e")).select("e.path", "e.value")
    # one reading of each value's type, then numbers and flags only
    typed = values.select("path", "value", F.schema_of_variant("value").alias("kind"))
    kind = F.col("kind")
    digits = F.when(kind.startswith("DECIMAL"), F.split_part(F.substring_index(kind, "(", -1), F.lit(","), F.lit(1)).cast("int"))
    scale = F.when(kind.startswith("DECIMAL"), F.rtrim(F.substring_index(kind, ",", -1), F.lit(")")).cast("int"))
    whole = F.when(kind == "BIGINT", F.try_variant_get("value", "$", "bigint"))
    family = (
        F.when(F.col("path").isNull(), UNPARSABLE)
        .when(kind.isNull() | (kind == "VOID"), NULL)
        .when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), NUMBER)
        .when(kind.startswith("ARRAY"), ARRAY)
        .when(kind.startswith("OBJECT"), OBJECT)
        .otherwise(F.lower(kind))
    )
    facts = typed.select(
        "path",
        family.alias("family"),
        kind.isin("DOUBLE", "FLOAT").alias("_double"),
        kind.startswith("DECIMAL").alias("_decimal"),
        whole.alias("_whole"),
        F.coalesce(digits - scale, F.length(F.ltrim(whole.cast("string"), F.lit("-")))).alias("_before"),
        scale.alias("_after"),
    )
    merged = facts.groupBy("path", "family").agg(
        F.count(F.lit(1)).alias("rows"),
        (~F.coalesce(F.bool_or(F.col("_double") | F.col("_decimal")), F.lit(False))).alias("whole"),
        (~F.coalesce(F.bool_or("_double"), F.lit(False))).alias("exact"),
        F.min("_whole").alias("lo"),
        F.max("_whole").alias("hi"),
        F.coalesce(F.max("_before"), F.lit(0)).alias("before"),
        F.coalesce(F.max("_after"), F.lit(0)).alias("after"),
    )
    total = F.col("before") + F.col("after")
    decimal = F.concat(F.lit("decimal("), total.cast("string"), F.lit(","), F.col("after").cast("string"), F.lit(")"))
    number = F.when(F.col("whole"), "bigint").when(F.col("exact") & (total <= _DIGITS), decimal).otherwise("double")
    data_type = F.when(F.col("family") == NUMBER, number).otherwise(F.col("family"))
    return merged.select("path", "family", data_type.alias("data_type"), "rows", "whole", "exact", "lo", "hi", "before", "after")


def fits(kind: T.DataType) -> Column:
    """Whether a row of :func:`type_profile` fits a declared type (containers: themselves, not what they hold)."""
    family, text = F.col("family"), kind.simpleString()
    number = family == NUMBER
    if isinstance(kind, T.VariantType):
        found = F.lit(True)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        found = number
    elif isinstance(kind, T.DecimalType):
        found = number & F.col("exact") & (F.col("before") <= kind.precision - kind.scale) & (F.col("after") <= kind.scale)
    elif text in _INTEGERS:
        most = 2 ** (_INTEGERS[text] - 1)
        found = number & F.col("whole") & (F.col("lo") >= -most) & (F.col("hi") <= most - 1)
    elif isinstance(kind, (T.StructType, T.MapType)):
        found = family == OBJECT
    elif isinstance(kind, T.ArrayType):
        found = family == ARRAY
    else:
        found = family == text
    return found | (family == NULL)


def drift_rows(profile: DataFrame, expected: Mapping[str, str] | Iterable[tuple[str, str]]) -> DataFrame:
    """What is wrong with a profile: section, ordinal, path, mismatch, rows.

    Section 0: declared paths, in their order (missing, or a family that does not fit, with its rows); 1: names that are
    not declared, ordinal NULL; 2: unparsable rows. A declared field inside a container that never came is missing only if the container came.
    """
    paths = declared_paths(expected)
    spark = profile.sparkSession
    path = F.col("path")
    judged = F.lit(None).cast("boolean")
    for p, kind in paths:
        judged = F.when(path == p, fits(kind)).otherwise(judged)
    texts = F.create_map(*[F.lit(x) for p, t in paths for x in (p, t.simpleString())]) if paths else F.create_map().cast("map<string,string>")
    places = F.create_map(*[F.lit(x) for k, (p, _) in enumerate(paths) for x in (p, k)]) if paths else F.create_map().cast("map<string,int>")
    expected_text, place = F.try_element_at(texts, path), F.try_element_at(places, path)
    wrong = profile.select(
        F.when(path.isNull(), 2).when(place.isNull(), 1).otherwise(0).alias("section"),
        place.alias("ordinal"),
        "path",
        F.when(path.isNull(), fill(MSG_UNPARSABLE, count=F.col("rows").cast("string")))
        .when(place.isNull(), fill(MSG_UNEXPECTED_COLUMN, column=path))
        .when(~judged, fill(MSG_TYPE_MISMATCH, column=path, expected=expected_text, actual=F.col("data_type")))
        .alias("mismatch"),
        "rows",
    ).filter(F.col("mismatch").isNotNull())
    # a name that nobody declared is one row, however many families it has
    unexpected = wrong.filter("section = 1").groupBy("section", "ordinal", "path", "mismatch").agg(F.sum("rows").alias("rows"))
    known = wrong.filter("section <> 1")
    if not paths:
        return known.unionByName(unexpected)
    parents = {p: next((q for q, _ in reversed(paths[:k]) if p.startswith((f"{q}.", f"{q}[", f"{q}{{"))), None) for k, (p, _) in enumerate(paths)}
    wanted = [F.struct(F.lit(p).alias("path"), F.lit(k).alias("ordinal"), F.lit(parents[p]).cast("string").alias("parent")) for k, (p, _) in enumerate(paths) if not p.endswith(("[]", "{}"))]
    declared = spark.range(0, 1, 1, 1).select(F.inline(F.array(*wanted)))
    seen = profile.filter(path.isin([p for p, _ in paths])).groupBy("path").agg(F.max(F.col("family").isin(OBJECT, ARRAY)).alias("held"))
    came = seen.select(F.col("path").alias("_parent"), "held")
    absent = declared.join(seen.select(F.col("path").alias("_path")), declared["path"] == F.col("_path"), "left").filter("_path is null")
    absent = absent.join(came, absent["parent"] == came["_parent"], "left").filter("parent is null or held")
    missing = absent.select(
        F.lit(0).alias("section"), "ordinal", "path", fill(MSG_MISSING_COLUMN, column=F.col("path")).alias("mismatch"), F.lit(0).cast("long").alias("rows")
    )
    return known.unionByName(unexpected).unionByName(missing)


def drift_result(failing: DataFrame, table_name: str, severity: str = WARN) -> DataFrame:
    """One row: table_name, check_name, status, mismatch_count, unparsable_rows, details.

    ``details`` lists what is wrong with declared paths, in their order (their number bounds it), then the count of undeclared
    names and of unparsable rows.
    """
    listed = F.when(F.col("section") == 0, F.struct("ordinal", "mismatch"))
    found = failing.agg(
        F.count(F.lit(1)).alias("mismatch_count"),
        F.count_if(F.col("section") == 1).alias("_unexpected"),
        F.coalesce(F.sum(F.when(F.col("section") == 2, F.col("rows"))), F.lit(0)).cast("long").alias("unparsable_rows"),
        F.array_sort(F.collect_list(listed)).alias("_listed"),
    )
    tail = F.array_compact(
        F.array(
            F.when(F.col("_unexpected") > 0, fill(MSG_UNEXPECTED_COUNT, count=F.col("_unexpected").cast("string"))),
            F.when(F.col("unparsable_rows") > 0, fill(MSG_UNPARSABLE, count=F.col("unparsable_rows").cast("string"))),
        )
    )
    details = F.array_join(F.concat(F.transform("_listed", lambda x: x["mismatch"]), tail), MISMATCH_SEPARATOR)
    return found.select(
        F.lit(table_name).alias("table_name"),
        F.lit(CHECK_SCHEMA).alias("check_name"),
        status_from_count("mismatch_count", severity).alias("status"),
        "mismatch_count",
        "unparsable_rows",
        F.when(F.col("mismatch_count") > 0, details).alias("details"),
    )


def check_json_schema(
    df: DataFrame,
    json_column: str,
    expected: Mapping[str, str] | Iterable[tuple[str, str]],
    table_name: str = "table",
    severity: str = WARN,
) -> CheckOutput:
    """Check the values of a JSON column, over all rows, against ``{key: type}``; see :func:`drift_rows` and :func:`drift_result`."""
    expected = list(expected.items()) if isinstance(expected, Mapping) else list(expected)
    failing = drift_rows(type_profile(df, json_column, expected), expected)
    return CheckOutput(result=drift_result(failing, table_name, severity), failing=failing)


def observed_schema(spark: SparkSession, profile: DataFrame) -> DataFrame:
    """One row per path: the type that holds all its values: the family's, or ``variant`` where families meet."""
    kinds = profile.filter(F.col("path").isNotNull() & (F.col("family") != NULL))
    return kinds.groupBy("path").agg(
        F.when(F.min("family") == F.max("family"), F.max("data_type")).otherwise("variant").alias("data_type"), F.sum("rows").alias("rows")
    )
