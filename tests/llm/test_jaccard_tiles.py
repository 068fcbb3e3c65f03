"""Jaccard components against all pairs, bounds of the filters, odd rows, large groups."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallycheck.llm import jaccard_tiles
from tallycheck.llm.jaccard_tiles import BITS, jaccard_components, prefix_size, required, shingle_sets, signature, size_bands

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=3):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    take = min(k, len(w))
    return {" ".join(w[i : i + take]) for i in range(len(w) - take + 1)} if w else set()


def brute(rows, k=3, percent=90):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    least = {}
    for x, (doc_id, _) in enumerate(rows):
        known = [i for i in (least.get(find(x)), doc_id) if i is not None]
        least[find(x)] = min(known) if known else None
    return sorted(((i, len(s), least[find(x)]) for x, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def collected(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def corpus(seed, n=40):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "日本"]
    rows = []
    for k in range(n):
        base = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 8, 12, 40, 90, 200]))]
        rows.append((k * 3, rng.choice([" ", "\t", "\n  "]).join(base)))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                if copy:
                    at = rng.randrange(len(copy))
                    copy[at : at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
            rows.append((rng.choice([k * 3 + 1, rng.randrange(1000)]), " ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy)))
    return rows + [(None, rows[0][1]), (None, None), (None, ""), (5, None), (6, " \n"), (7, "one"), (8, "ONE"), (9, "one two"), (9, "one two"), (None, "lone null id")]


@pytest.mark.parametrize("seed, k, percent", [(0, 3, 90), (1, 3, 90), (2, 1, 80), (3, 2, 50), (4, 3, 100)])
def test_against_brute_force(docs, seed, k, percent):
    rows = corpus(seed)
    want = brute(rows, k, percent)
    assert collected(jaccard_components(docs(rows), k, percent)) == want


def test_border_of_the_similarity(docs):
    base = [f"u{k}" for k in range(21)]  # 19 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base[:-2])), (4, " ".join(base[2:] + ["x"]))]
    assert collected(jaccard_components(docs(rows))) == brute(rows)
    assert {r[2] for r in brute(rows)} == {1, 4}


def test_large_group_of_near_copies_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(jaccard_tiles, "BLOCK", 8)
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(50)]
    rows = []
    for k in range(150):  # one edit or two each: some are near the leader, some only near each other
        copy = list(passage)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(50)] = f"e{rng.randrange(6)}"
        rows.append((k, " ".join(copy)))
    rows += [(1000 + k, " ".join([*passage[:25], *(f"o{k}x{j}" for j in range(25))])) for k in range(60)]
    want = brute(rows)
    assert collected(jaccard_components(docs(rows))) == want
    assert len({r[2] for r in want}) > 2


def test_long_text(docs):
    rng = random.Random(6)
    text = " ".join(f"t{rng.randrange(10**6)}" for _ in range(200_000))
    rows = [(1, text), (2, text + " more"), (3, text[: len(text) // 2])]
    assert [r[2] for r in collected(jaccard_components(docs(rows)))] == [1, 1, 3]


def test_empty(docs):
    assert collected(jaccard_components(docs([]))) == []
    assert collected(jaccard_components(docs([(3, None), (4, " ")]))) == [(3, 0, 3), (4, 0, 4)]
    with pytest.raises(ValueError):
        jaccard_components(docs([]), percent=0)


def test_sets_of_a_batch():
    texts = [b"", b"A b  c d", None, b"a", b"x y", b"x\ty\nz", "é É é É é".encode(), b"a b a b a b"]
    got = shingle_sets(texts, 3)
    assert [len(x) for x in got] == [len(shingles(t.decode() if t else t)) for t in texts]
    assert shingle_sets([b"x y z"], 3)[0].tolist() == got[5].tolist()
    assert all((np.diff(x.astype(object)) > 0).all() for x in got)


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=300), st.integers(0, 300))
@settings(max_examples=200, deadline=None)
def test_bits_bound_the_overlap_from_above(a, b, shared):
    b = b | set(sorted(a)[:shared])
    if not b:
        return
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    apart = int(np.bitwise_count(np.frombuffer(signature(x), np.uint64) ^ np.frombuffer(signature(y), np.uint64)).sum())
    assert len(a & b) <= (len(a) + len(b) - apart) // 2
    assert len(signature(x)) * 8 == BITS


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_bands_and_prefixes_lose_nothing(percent):
    bands = size_bands(percent)
    for n in range(1, 400):
        for m in range(n, min(400, n * 100 // percent) + 1):
            assert np.searchsorted(bands, m, "right") - np.searchsorted(bands, n, "right") <= 1
            # a linked set shares more than what lies outside the prefix
            o = int(required(np.int64(n), np.int64(m), percent))
            if o <= n:
                assert o > n - prefix_size(n, percent) and o > m - prefix_size(m, percent)


def test_bitmaps_are_as_wide_as_their_sets_ask(docs):
    rows = [(n, " ".join(f"w{n}x{k}" for k in range(n + 2))) for n in (3, 486, 487, 973, 5000)]
    found = {r.n: len(r.bitmap) * 8 for r in jaccard_tiles.prints(docs(rows), 3, 90).select("n", "bitmap").collect()}
    assert found == {3: 256, 486: 256, 487: 512, 973: 1024, 5000: BITS}


def test_classes_of_bitmaps_of_two_widths_are_linked(docs):
    base = [f"u{k}" for k in range(489)]  # 487 shingles, 512 bits
    rows = [(9, " ".join(base)), (4, " ".join(base[:-30])), (2, " ".join(base[30:] + ["x"] * 3)), (1, " ".join(base[200:] + [f"y{k}" for k in range(200)]))]
    want = brute(rows)
    assert collected(jaccard_components(docs(rows))) == want
    assert {r[2] for r in want} == {1, 2}


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=300), st.integers(0, 300))
@settings(max_examples=100, deadline=None)
def test_folded_bits_bound_the_overlap_from_above(a, b, shared):
    b = b | set(sorted(a)[:shared])
    sets = [np.array(sorted(s), np.uint64) for s in (a, b, a | b)]
    widths = [256, 1024, BITS]
    both = jaccard_tiles.folded([signature(x, w) for x, w in zip(sets, widths)])
    one, two = (np.array(x) for x in zip(*combinations(range(3), 2)))
    apart = jaccard_tiles.bits_apart(both, one, two)
    for x, y, found in zip(one, two, apart):
        least = [np.frombuffer(signature(sets[k], min(widths[x], widths[y])), np.uint64) for k in (x, y)]
        assert found == np.bitwise_count(least[0] ^ least[1]).sum()
        assert len(np.intersect1d(sets[x], sets[y])) <= (len(sets[x]) + len(sets[y]) - found) // 2


@pytest.mark.parametrize("percent", [50, 80, 90, 95, 100])
def test_first_shared_shingle_is_short_for_the_smaller_set(percent):
    for n in range(1, 400):
        for m in range(n, min(400, n * 100 // percent) + 1):
            o = int(required(np.int64(n), np.int64(m), percent))
            if o <= n:  # the first of o shared shingles is at n - o or before
                assert (n - o) * (100 + percent) <= n * (100 - percent)
                assert m - o < prefix_size(m, percent)


def test_shingles_that_are_short_for_no_class_have_no_members(docs, monkeypatch):
    # the three shingles with an own word are the rarest; the fourth of the prefix is shared, but too late for the overlap
    found = []

    def written(df, label):
        out = plain(df, label)
        if label == "jaccard-members":
            found.append(out)
        return out

    plain = jaccard_tiles.written
    monkeypatch.setattr(jaccard_tiles, "written", written)
    common = [f"c{k}" for k in range(39)]
    rows = [(d, " ".join([*common[:20], f"own{d}", *common[20:]])) for d in range(30)]
    want = brute(rows)
    assert collected(jaccard_components(docs(rows))) == want
    assert {n for _, n, _ in want} == {38} and len({c for *_, c in want}) == 30
    assert [x.count() for x in found] == [0]
