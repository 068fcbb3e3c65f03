import random
from collections import Counter

import numpy as np
import pytest

from tallycheck.llm.phrases import Hashed, Shape, parse
from tallycheck.llm.suffix_dedup import remove_repeats


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        covered = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                covered[p : p + length] = True
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((doc_id, len(t), int(covered.sum()), runs, bytes(np.frombuffer(t, np.uint8)[~covered])))
    return sorted(out, key=repr)


def run(docs, rows, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r["kept"])) for r in remove_repeats(docs(rows), **kw).collect()), key=repr)


def pieced(seed, n, low, high, parts):
    """Texts put together from few pieces, so that repeats begin and end anywhere."""
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé ") for _ in range(3000))
    rows = []
    for k in range(n):
        text = ""
        for _ in range(rng.randint(0, parts)):
            a = rng.randrange(len(base) - high)
            text += base[a : a + rng.randint(low, high)] + ("" if rng.random() < 0.3 else f"<{rng.random()}>")
        rows.append((k, text))
    return rows + [(None, None), (900, ""), (3, rows[3][1]), (901, "z" * 500), (902, "short")]


@pytest.mark.parametrize("seed,length,gram", [(1, 40, 12), (2, 60, 20), (3, 25, 25), (4, 200, 64)])
def test_against_brute_force(spark, docs, seed, length, gram):
    rows = pieced(seed, 40, length // 2, length * 3, 6)
    assert run(docs, rows, length=length, gram=gram) == brute(rows, length)


def test_periodic_texts(spark, docs):
    rows = [(1, "ab" * 300), (2, "x" * 260), (3, "abc" * 90), (4, "q" * 199), (5, "".join(f"{k:04}" for k in range(200)))]
    assert run(docs, rows) == brute(rows, 200)


def test_empty(spark, docs):
    assert run(docs, []) == []
    row = remove_repeats(docs([(1, "a")])).first()
    assert (row.score, row["_items"], row.n_removed) == (0.5, "x", 0)


def test_each_start_is_in_one_phrase():
    rng = random.Random(0)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(200, 900))).encode() for _ in range(8)]
    _, p = parse(texts, Shape(200, 64))
    for k, text in enumerate(texts):
        own = np.flatnonzero(p.text == k)
        starts = [s for j in own for s in range(p.first[j], p.first[j] + p.count[j])]
        assert starts == list(range(len(text) - 199))
        assert all(0 <= p.trigger_at[j] - (p.count[j] - 1) and p.trigger_at[j] <= 136 for j in own)


def test_hashes_depend_on_the_bytes_alone():
    a, b = Hashed([b"hello world", b"world"]), Hashed([b"xxworldyy"])
    assert a.spans(np.array([6, 11]), np.array([11, 16])).tolist() == b.spans(np.array([2, 2]), np.array([7, 7])).tolist()
