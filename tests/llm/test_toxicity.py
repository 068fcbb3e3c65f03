import random

import numpy as np

from tallycheck.llm.common import is_held_out
from tallycheck.llm.toxicity import counterfactual, fit_toxicity, fit_weights, score_toxicity, words_of

CALM = "the day was long and we went to see a river with some bread in it for lunch while birds sang near trees".split()
RUDE = ["idiot", "scum", "loser"]


def corpus(n=500, seed=0):
    """Rude texts often name a group; calm ones sometimes do."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(CALM) for _ in range(rng.randint(5, 40))]
        rude = rng.random() < 0.3
        if rude:
            words.insert(rng.randrange(len(words)), rng.choice(RUDE) + rng.choice(["", "s", ","]))
        if rng.random() < (0.6 if rude else 0.05):
            words.insert(rng.randrange(len(words)), "muslims")
        rows.append((k, " ".join(words)))
        if k % 3:
            labels.append((k, 1, int(rude)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus()
    got = {r.doc_id: r for r in score_toxicity(docs(rows), labelled(spark, labels)).collect()}
    held = [(got[k].predicted, y) for k, _, y in labels if is_held_out(k)]
    assert len(held) > 40 and sum(p == y for p, y in held) / len(held) > 0.95
    assert all(r.held_out == is_held_out(k) and r.predicted == (r.score >= 0.3) for k, r in got.items())


def test_neutral_mentions_stay_clean(spark, docs):
    rows, labels = corpus()
    calm = [(1000 + k, " ".join(random.Random(k).choices(CALM, k=20)) + " muslims") for k in range(40)]
    calm += [(2000 + k, t.replace("muslims", "women")) for k, (_, t) in enumerate(calm)]
    got = score_toxicity(docs(rows + calm), labelled(spark, labels)).filter("doc_id >= 1000")
    assert got.filter("predicted = 1").count() == 0


def test_penalty_shrinks_score_changes():
    rows = [[0, 1], [0, 1], [1], [2], [2], [3]]
    swapped = [(0, [0, 3]), (1, [0, 3]), (2, [3]), (5, [1])]
    gaps = []
    for fairness in (0.0, 5.0, 50.0):
        _, w = fit_weights(rows, swapped, [1, 1, 1, 0, 0, 0], 4, fairness=fairness, steps=4000)
        gaps.append(abs(w[1] - w[3]))
    assert gaps[0] > 3 * gaps[1] > 3 * gaps[2]


def test_counterfactual():
    assert counterfactual(["the", "women", "x"], ("women", "men")) == ["the", "men", "x"]
    assert counterfactual(["the"], ("women",)) is None
    assert words_of("It's ÜBER-nice, no?") == ["it", "s", "über", "nice", "no"] and words_of(None) == []


def test_same_model_however_dealt(spark, docs):
    rows, labels = corpus(200)
    a, b = (fit_toxicity(docs(rows, parts=p), labelled(spark, labels)) for p in (1, 6))
    assert a.numbers == b.numbers and np.allclose(a.weights, b.weights)


def test_odd_rows(spark, docs):
    rows, labels = corpus(150)
    rows += [(None, "idiot"), (500, None), (501, ""), (7, rows[7][1]), (502, "calm " * 100_000)]
    labels += [(3, None, None), (None, 1, 1), (9999, 1, 1)]
    got = score_toxicity(docs(rows), labelled(spark, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (500, 501)}) == 1
    assert score_toxicity(docs([]), labelled(spark, labels)).count() == 0
    assert score_toxicity(docs([(1, "a")]), labelled(spark, [])).first().score == 0.5
