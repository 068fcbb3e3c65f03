"""Spelling variants against all pairs, the pivots' dynamic programming, odd rows."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallycheck.llm.spelling import _CELLS, index_rows, near_words, pivots, roots, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def counted(rows, min_length, min_count):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_length:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= min_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[same + (len(a) >= len(b)) :] == b[same + (len(b) >= len(a)) :]


def brute(words, ratio):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        if others and words[best := min(others, key=lambda x: (-words[x], x))] >= ratio * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def collected(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcÉéÿ×"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 11))) for _ in range(60)]
    common = rng.sample(base, 5)

    def edited(w):
        at = rng.randrange(len(w))
        return rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])

    rows = []
    for k in range(300):
        words = [rng.choice(common) if rng.random() < 0.4 else edited(rng.choice(base)) for _ in range(rng.randint(0, 20))]
        rows.append((rng.choice([k, k, 7, None]), rng.choice([" ", "-", ", ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows + [(1, None), (2, ""), (3, "ĀĀĀĀĀĀĀĀ 日本語日本語日本 x1y2z3")] + rows[:10]


@pytest.mark.parametrize("seed, min_length, min_count, ratio", [(0, 7, 2, 10), (1, 4, 1, 2), (2, 5, 2, 3)])
def test_against_brute_force(docs, seed, min_length, min_count, ratio):
    rows = corpus(seed)
    want = brute(counted(rows, min_length, min_count), ratio)
    assert collected(spelling_variants(docs(rows), min_length, min_count, ratio)) == want
    assert any(r[4] for r in want)


def test_long_words_and_repeated_bigrams(docs):
    long_word = "ab" * 40_000
    words = ["a" * 9, "a" * 10, "a" * 11, "abababab", "babababa", "ababababa", long_word, long_word + "c", long_word[1:], "x" + long_word[1:]]
    rows = [(k, " ".join(words)) for k in range(3)]
    want = brute(counted(rows, 7, 1), 2)
    assert collected(spelling_variants(docs(rows), 7, 1, 2)) == want
    assert sum(r[4] for r in want) >= 10


def test_chains_end_at_the_root(docs):
    chain = [("abcdefghij", 2000), ("abcdefghi", 150), ("abcdefgh", 12), ("abcdefg", 1)]
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    # ids whose runs lose no letter
    rows = [(next(i for i in range(1000) if zlib.crc32(f"{i}:{t.split()[0]}".encode()) % 31), t) for _, t in rows]
    got = {r[0]: (r[1], r[2]) for r in collected(spelling_variants(docs(rows), 7, 1, 10))}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij") and got["abcdefghij"] == (None, "abcdefghij")


def test_empty(docs):
    assert collected(spelling_variants(docs([]))) == []
    assert collected(spelling_variants(docs([(1, None), (2, "short words only")]))) == []
    with pytest.raises(ValueError):
        spelling_variants(docs([]), min_length=3)
    with pytest.raises(ValueError):
        spelling_variants(docs([]), ratio=1)


def test_ties_take_the_first_form(spark, docs):
    i = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in ("abcdefgh", "abcdefgx", "abcdefga")))
    rows = [(i, "abcdefgh " + "abcdefgx " * 20 + "abcdefga " * 20)]
    got = {r[0]: r[1] for r in collected(spelling_variants(docs(rows), 7, 1, 10))}
    assert got == {"abcdefgh": "abcdefga", "abcdefgx": None, "abcdefga": None}


def test_a_beginning_shared_by_a_third_of_the_words(spark):
    rng = random.Random(4)
    words = {"st" + "".join(rng.choice("abcdef") for _ in range(6)) for _ in range(700)} | {"".join(rng.choice("abcdefst") for _ in range(8)) for _ in range(900)}
    frame = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    got = {(r.a, r.b) for r in near_words(frame).collect()}
    assert got == {(a, b) for a, b in combinations(sorted(words), 2) if one_edit(a, b)}


def test_roots_of_a_long_chain(spark):
    steps = [(f"w{k:03}", f"w{k + 1:03}") for k in range(40)]
    got = {r.word: r.root for r in roots(spark.createDataFrame(steps, "word string, form string")).collect()}
    assert set(got.values()) == {"w040"} and len(got) == 40


_PRICED = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 9)), min_size=1, max_size=6, unique_by=lambda x: x[0]).map(sorted)


@given(_PRICED, _PRICED)
@settings(max_examples=200, deadline=None)
def test_pivots_are_the_cheapest_disjoint_pair(lefts, rights):
    costs = [x + y for a, x in lefts for b, y in rights if a + 2 <= b]
    i, j = pivots(lefts, rights)
    if costs:
        assert lefts[i][0] + 2 <= rights[j][0] and lefts[i][1] + rights[j][1] == min(costs)
    else:
        assert (i, j) == (-1, -1)


@given(st.text("abc", min_size=4, max_size=14), st.integers(0, 12), st.sampled_from("abc"), st.integers(0, 2), st.integers(0, 99))
@settings(max_examples=400, deadline=None)
def test_words_one_edit_apart_share_a_key(word, at, letter, kind, seed):
    at %= len(word) + (kind == 1)
    other = [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]][kind]
    if len(other) < 4 or other == word:
        return
    counts = np.random.default_rng(seed).integers(0, 5, 1 << 16)
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), counts))] = np.arange(1 << 16)
    number, role, key, ends = index_rows([word, other], rank, np.random.default_rng(seed).integers(0, 9, _CELLS))
    pivot = [{k for w, r, k in zip(number, role, key) if w == x and r == 0} for x in (0, 1)]
    prefix = [{k for w, r, k in zip(number, role, key) if w == x and r == 1} for x in (0, 1)]
    assert any(ends[x] <= ends[1 - x] and pivot[x] & prefix[1 - x] for x in (0, 1))
