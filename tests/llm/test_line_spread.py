import random

import pytest
from pyspark.sql import functions as F

from tallycheck.llm import line_spread
from tallycheck.llm.common import written
from tallycheck.llm.line_spread import remove_spread_lines


def brute(rows, sites):
    where = {}
    for _, text, source in rows:
        for line in text.split("\n") if text is not None else ():
            where.setdefault(line, set()).add(source)
    bad = {x for x, s in where.items() if len(s) >= sites and x.strip(" \t\r")}
    out = []
    for doc_id, text, _ in rows:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if x not in bad]
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sites", [2, 3, 6])
def test_against_brute_force(spark, docs, sites):
    rng = random.Random(sites)
    common = [f"common {k}" for k in range(12)] + ["", " \t", "é"]
    rows = [
        (k, "\n".join(rng.choice(common) if rng.random() < 0.5 else f"own {rng.random()}" for _ in range(rng.randint(1, 6))), rng.choice([None, *"abcdefghij"]))
        for k in range(80)
    ]
    rows += [(900, None, "a"), (901, "", "b"), (3, *rows[3][1:]), (None, "common 1\nx", "c")]
    df = remove_spread_lines(docs(rows), min_sites=sites)
    got = sorted(((r.doc_id, r.kept_text, r.n_lines, r.n_removed) for r in df.collect()), key=repr)
    assert got == brute(rows, sites)


def test_many_sites_by_sketch(spark, docs):
    rows = [(k, "everywhere\nonce %d" % k, f"site{k}") for k in range(400)]
    df = remove_spread_lines(docs(rows), min_sites=50)
    assert df.filter("n_removed = 1 and kept_text like 'once%'").count() == 400
    none = remove_spread_lines(docs(rows), min_sites=401)
    assert none.agg(F.sum("n_removed")).first()[0] == 0


def test_empty(spark, docs):
    assert remove_spread_lines(docs([])).count() == 0


def test_sketches_come_straight_from_the_lines(spark, docs, monkeypatch):
    """No aggregate or exchange stands under the sketches' but their own; exact pairs are those of lines near the limit."""
    plans = {}

    def kept(df, label):
        plans[label] = df
        return written(df, label)

    monkeypatch.setattr(line_spread, "written", kept)
    rows = [(k, "far above\nonce %d\n%s" % (k, "near" if k < 10 else "below" if k < 14 else "x"), f"site{k}") for k in range(60)]
    found = line_spread.spread_lines(docs(rows), min_sites=10)
    assert found.count() == 3  # far above, near, x
    plan = plans["line-estimates"]._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.rfind("Initial Plan") :] if "Initial Plan" in plan else plan
    assert initial.count("Exchange hashpartitioning(") == 1 and initial.count("Aggregate(") == 2
    assert plans["line-estimates"].filter("estimate <= 12").count() == 1  # of 64 lines, "near" alone is counted exactly
