import random

import numpy as np
import pytest

from tallycheck.llm.common import is_held_out
from tallycheck.llm.rule_quality import STATISTICS, Rule, RuleEnsemble, extract_rules, fit, keep_good, lasso_logistic, score_quality, statistics, with_statistics


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 120))]
        good = rng.random() < 0.75
        if good:
            text = " ".join(words).capitalize() + "."
        else:
            text = rng.choice([lambda w: " ".join(w).upper() + "!!", lambda w: " | ".join(w), lambda w: " ".join(x + "%%%" for x in w), lambda w: " ".join(x for x in w for _ in range(9))])(words)
        rows.append((k, text))
        if k % 3:
            labels.append((k, int(good), 0))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus()
    got = {r.doc_id: r for r in score_quality(docs(rows), labelled(spark, labels)).collect()}
    assert len(got) == len(rows)
    assert all(r.held_out == is_held_out(k) for k, r in got.items())
    held = [(got[k].predicted, y) for k, y, _ in labels if is_held_out(k)]
    assert len(held) > 30 and sum(p == y for p, y in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_held_out_labels_are_not_learnt(spark, docs):
    rows, labels = corpus(200)
    flipped = [(k, 1 - y if is_held_out(k) else y, t) for k, y, t in labels]
    a = {r.doc_id: r.score for r in score_quality(docs(rows), labelled(spark, labels)).collect()}
    assert a == {r.doc_id: r.score for r in score_quality(docs(rows, parts=5), labelled(spark, flipped)).collect()}


def test_odd_rows_and_labels(spark, docs):
    rows, labels = corpus(120)
    rows += [(None, "null id"), (500, None), (501, ""), (7, rows[7][1]), (502, "word " * 100_000)]
    labels += [(3, None, None), (None, 1, 1), (7, 0, 0), (9999, 1, 0)]
    got = score_quality(docs(rows), labelled(spark, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (500, 501)}) == 1


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 0), (2, 0, 0)]])
def test_labels_of_one_kind(spark, docs, labels):
    got = score_quality(docs([(1, "a"), (2, "b")]), labelled(spark, labels)).collect()
    share = (sum(y for k, y, _ in labels if not is_held_out(k)) + 1) / (sum(not is_held_out(k) for k, _, _ in labels) + 2)
    assert [r.score for r in got] == pytest.approx([share] * 2)
    assert score_quality(docs([]), labelled(spark, labels)).count() == 0


def test_keep_good(spark, docs):
    rows, labels = corpus(200)
    rows += [(11, rows[11][1])]
    df = docs(rows)
    good = sorted(r.doc_id for r in score_quality(df, labelled(spark, labels)).filter("predicted = 1").collect())
    kept = keep_good(df, labelled(spark, labels))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == good


def test_compiled_column_equals_the_rules(spark, docs):
    rows, _ = corpus(60)
    df = with_statistics(docs(rows), ["doc_id"])
    x = np.array([statistics(t.encode()) for _, t in sorted(rows)])
    y = (x[:, STATISTICS.index("upper")] > 0.5).astype(float)
    model = fit(x, y, trees=5)
    assert model.rules and all(1 <= len(r.conditions) <= 3 for r, _ in model.rules)
    got = [r.s for r in df.select("doc_id", model.column().alias("s")).orderBy("doc_id").collect()]
    assert got == pytest.approx(model.score(x).tolist())


def test_lasso_is_sparse():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(500, 40))
    y = (z[:, 3] - z[:, 7] > 0).astype(float)
    _, w = lasso_logistic(z, y, 0.02)
    assert {3, 7} <= set(np.flatnonzero(w)) and (w != 0).sum() < 12


def test_rules_hold():
    rule = Rule(((0, True, 0.5), (1, False, 2.0)))
    assert rule.holds(np.array([[1.0, 2.0], [0.5, 1.0], [1.0, 3.0]])).tolist() == [True, False, False]
    assert RuleEnsemble(0.0).score(np.zeros((1, 2))).tolist() == [0.5]
    assert extract_rules(np.ones((50, 2)), np.arange(50) % 2 * 1.0, trees=2) == []
