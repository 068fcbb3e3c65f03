"""Types seen in JSON values against declared ones."""

import json
import random

import pytest

from tallycheck.operators.type_drift import check_json_schema, declared_paths, observed_schema, type_profile


def frame(spark, texts, parts=3):
    return spark.createDataFrame([(t,) for t in texts], "props string").repartition(parts)


def messages(out):
    rows = sorted(out.failing.collect(), key=lambda r: (r["section"], r["ordinal"] is None, r["ordinal"], r["mismatch"]))
    return [r["mismatch"] for r in rows]


def check(spark, texts, expected, **kw):
    out = check_json_schema(frame(spark, texts), "props", expected, "t", **kw)
    return messages(out), out.result.first()


def test_numbers_of_any_precision_fit_double(spark):
    texts = ['{"a":1.5}', '{"a":10.25}', '{"a":1e300}', '{"a":3}', '{"a":null}', '{"a":-7}', '{"a":0.000000001}']
    msgs, result = check(spark, texts, {"a": "double"})
    assert msgs == [] and (result["status"], result["mismatch_count"], result["details"]) == ("PASS", 0, None)


def test_mixed_string_and_number(spark):
    msgs, result = check(spark, ['{"k":"x"}', '{"k":1}', '{"k":2}', '{"k":true}'], {"k": "string"})
    assert msgs == ["Type mismatch on k: expected string, got bigint", "Type mismatch on k: expected string, got boolean"]
    assert result["mismatch_count"] == 2
    rows = {r["mismatch"]: r["rows"] for r in check_json_schema(frame(spark, ['{"k":1}', '{"k":2}']), "props", {"k": "string"}).failing.collect()}
    assert rows == {"Type mismatch on k: expected string, got bigint": 2}


@pytest.mark.parametrize(
    "values, held, not_held",
    [
        (["1", "2"], ["bigint", "tinyint", "decimal(1,0)", "double", "float", "variant"], ["string", "boolean", "array<int>"]),
        (["1", "128"], ["smallint", "decimal(3,0)"], ["tinyint", "decimal(2,0)"]),
        (["-32769"], ["int"], ["smallint"]),
        (["9223372036854775807"], ["bigint", "decimal(19,0)", "double"], ["int", "decimal(18,0)"]),
        (["92233720368547758070"], ["decimal(20,0)", "double"], ["decimal(19,0)"]),
        (["1.5", "100", "0.25"], ["decimal(5,2)", "double"], ["decimal(4,2)", "bigint", "decimal(5,1)"]),
        (["1.5", "1e300"], ["double"], ["decimal(38,10)", "bigint"]),
        (["null"], ["bigint", "string", "array<int>"], []),
        (['"2024-01-01"', '""'], ["string"], ["bigint", "boolean"]),
        (["[]", "{}"], ["variant"], ["array<int>", "map<string,int>"]),
    ],
)
def test_lattice(spark, values, held, not_held):
    texts = [f'{{"a":{v}}}' for v in values]
    for kind in held:
        assert check(spark, texts, {"a": kind})[0] == [], kind
    for kind in not_held:
        assert check(spark, texts, {"a": kind})[0], kind


def test_observed_types(spark):
    texts = ['{"a":1,"b":1,"c":1.5,"d":"x","e":[1],"f":null}', '{"a":2,"b":2.25,"c":1e9,"d":1,"e":[]}']
    got = {r["path"]: r["data_type"] for r in observed_schema(spark, type_profile(frame(spark, texts), "props")).collect()}
    assert got["a"] == "bigint" and got["b"] == "decimal(3,2)" and got["d"] == "variant" and got["e"] == "array" and "f" not in got


def test_nested(spark):
    expected = {"pos": "struct<x:double,y:bigint,tags:array<string>>", "m": "map<string,int>", "l": "array<struct<n:int>>"}
    assert [p for p, _ in declared_paths(expected)] == ["pos", "pos.x", "pos.y", "pos.tags", "pos.tags[]", "m", "m{}", "l", "l[]", "l[].n"]
    good = '{"pos":{"x":1,"y":2,"tags":["a"]},"m":{"q":1},"l":[{"n":1},{"n":2}]}'
    assert check(spark, [good], expected)[0] == []
    bad = '{"pos":{"x":"no","z":1,"tags":[1,"b"]},"m":{"q":1.5,"r":2},"l":[{"n":"1"},3]}'
    assert check(spark, [good, bad], expected)[0] == [
        "Type mismatch on pos.x: expected double, got string",
        "Type mismatch on pos.tags[]: expected string, got bigint",
        "Type mismatch on m{}: expected int, got decimal(2,1)",
        "Type mismatch on l[]: expected struct<n:int>, got bigint",
        "Type mismatch on l[].n: expected int, got string",
        "Unexpected column: pos.z",
    ]


def test_a_missing_container_is_one_message(spark):
    expected = {"pos": "struct<x:double>", "k": "bigint"}
    assert check(spark, ['{"k":1}'], expected)[0] == ["Missing column: pos"]
    assert check(spark, ['{"k":1,"pos":{}}'], expected)[0] == ["Missing column: pos.x"]


def test_unparsable_rows_are_counted(spark):
    texts = ["not json", '{"a":1', "[1]", "1", '{"a":1,"a":2}', None, "", '{"a":1}', "{}"]
    msgs, result = check(spark, texts, {"a": "bigint"})
    assert msgs == ["Unparsable rows: 6"]
    assert (result["unparsable_rows"], result["details"], result["status"]) == (6, "Unparsable rows: 6", "WARN")


def test_unexpected_names_are_counted_in_the_result(spark):
    texts = [json.dumps({f"id{k}": k, "a": 1}) for k in range(50)] + ['{"id1":"x"}']
    msgs, result = check(spark, texts, {"a": "bigint", "b": "string"}, severity="FAIL")
    assert len(msgs) == 51 and msgs[0] == "Missing column: b"
    assert (result["details"], result["mismatch_count"], result["status"]) == ("Missing column: b; Unexpected columns: 50", 51, "FAIL")


def test_names_with_marks(spark):
    msgs, _ = check(spark, ['{"a.b":1,"a[]":2,"é":3,"":4}'], {"é": "bigint", "a.b": "string"})
    assert msgs == ["Type mismatch on a.b: expected string, got bigint", "Unexpected column: ", "Unexpected column: a[]"]


def test_empty_table(spark):
    msgs, result = check(spark, [], {"a": "bigint"})
    assert msgs == ["Missing column: a"] and result["unparsable_rows"] == 0
    assert check(spark, [], {})[0] == []


def test_merging_does_not_depend_on_the_partitions(spark):
    rng = random.Random(1)
    texts = [json.dumps({"n": rng.choice([1, 2.5, 1e30, 10**15, "s", None]), "l": [rng.choice([1, 0.125])]}) for _ in range(300)]
    want = None
    for parts in (1, 7):
        got = sorted(map(tuple, type_profile(frame(spark, texts, parts), "props", {"l": "array<double>"}).collect()), key=repr)
        want = want or got
        assert got == want


def test_one_exchange_for_the_profile(spark):
    plan = type_profile(frame(spark, ['{"a":1}'], 3), "props", {"a": "struct<x:int>"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "collect_" not in plan
