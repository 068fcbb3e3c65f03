"""Flatten: nested response bodies to one record per item."""

import json

from pyspark.sql import functions as F

from tallycheck.operators.flatten import flatten_responses, quarantine, quarantine_items
from tallycheck.schemas import RECORD_SCHEMA
from tests.conftest import rows


def bodies(spark, *texts):
    return spark.createDataFrame([(f"t{i}", t) for i, t in enumerate(texts)], "title string, body string")


def test_two_items_flatten_to_two_records(spark):
    body = {
        "items": [
            {"project": "en.wikipedia", "article": "The_Legend_of_Zelda", "granularity": "daily",
             "timestamp": "2022010100", "views": 500},
            {"project": "en.wikipedia", "article": "The_Legend_of_Zelda", "granularity": "daily",
             "timestamp": "2022010200", "views": 620},
        ]
    }
    out = flatten_responses(bodies(spark, json.dumps(body)))
    assert out.schema == RECORD_SCHEMA
    assert [tuple(r) for r in out.collect()] == [
        ("en.wikipedia", "The_Legend_of_Zelda", "daily", "2022010100", 500),
        ("en.wikipedia", "The_Legend_of_Zelda", "daily", "2022010200", 620),
    ]


def test_success_fixture_without_views(spark):
    body = {"items": [{"project": "en.wikipedia", "article": "The_Legend_of_Zelda",
                       "granularity": "daily", "timestamp": "2022010100"}]}
    out = flatten_responses(bodies(spark, json.dumps(body))).collect()
    assert [tuple(r) for r in out] == [("en.wikipedia", "The_Legend_of_Zelda", "daily", "2022010100", None)]


def test_bodies_without_items_give_no_rows(spark):
    df = bodies(spark, '{"items":[]}', "{}", '{"items":null}', '{"items":[null]}', "null", "[1]",
                "nope", "", None)
    assert flatten_responses(df).count() == 0


def test_item_values(spark):
    df = bodies(
        spark,
        '{"items":[{"article":"a","timestamp":"2026010100"}]}',  # missing fields
        '{"items":[{"article":"b","views":3,"extra":true}]}',  # extra field
        '{"items":[{"article":"c","views":"7"}]}',
        '{"items":[{"article":"d","views":"x"}]}',
        '{"items":[{"article":"e","views":1.0}]}',
    )
    got = rows(flatten_responses(df), "article", "timestamp", "views")
    assert got == [("a", "2026010100", None), ("b", None, 3), ("c", None, None),
                   ("d", None, None), ("e", None, None)]
    # bodies with a value that did not fit go to quarantine; the others do not
    q = sorted(r["title"] for r in quarantine(df).collect())
    assert q == ["t2", "t3", "t4"]


def test_title_is_not_copied(spark):
    df = spark.createDataFrame([("Other_Title", '{"items":[{"article":"Minecraft"}]}')],
                               "title string, body string")
    out = flatten_responses(df)
    assert "title" not in out.columns
    assert out.collect()[0]["article"] == "Minecraft"


def test_row_count_equals_sum_of_item_counts(spark):
    texts = [json.dumps({"items": [{"article": f"a{i}", "views": j} for j in range(i)]}) for i in range(12)]
    df = bodies(spark, *texts)
    expected = df.select(
        F.sum(F.size(F.from_json("body", "items array<struct<views:bigint>>")["items"]))
    ).collect()[0][0]
    assert flatten_responses(df).count() == expected == sum(range(12))


def test_one_bad_element_leaves_its_siblings(spark):
    good = '{"article":"a","views":1}'
    df = bodies(
        spark,
        f'{{"items":[1,{good}]}}',
        f'{{"items":["x",[{good}],null,true,{good},{{"article":"b","views":"7"}}]}}',
        '{"items":5}',
        f'{{"items":[{good}]}}',
    )
    got = rows(flatten_responses(df), "article", "views")
    assert got == [("a", 1), ("a", 1), ("a", 1), ("b", None)]
    assert sorted(r["title"] for r in quarantine(df).collect()) == ["t0", "t1", "t2"]
    bad = sorted((r["title"], r["item_no"], r["item"]) for r in quarantine_items(df).collect() if r["title"] != "t2")
    assert bad == [
        ("t0", 0, "1"),
        ("t1", 0, "x"),
        ("t1", 1, f"[{good}]"),
        ("t1", 3, "true"),
        ("t1", 5, '{"article":"b","views":"7"}'),
    ]
    assert [(r["item_no"], r["item"]) for r in quarantine_items(df).collect() if r["title"] == "t2"] == [(None, '{"items":5}')]
