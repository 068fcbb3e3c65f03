import random
import re

import numpy as np
import pytest
import xxhash

from tallycheck.llm.components import components
from tallycheck.llm.simhash import allocate, bit_pairs, group_bits, keep_one, links, near_duplicates, plan_probes
from tallycheck.llm.simhash_fp import fingerprint


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    n = min(k, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest() for i in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, ids, bits=3):
    parent = list(range(len(prints)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                parent[root(i)] = root(j)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [least.get(root(k)) for k in range(len(ids))]


def corpus(seed=1):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("the a of Übung x1 Cat dog sun") + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    texts += [t + " extra" for t in texts[:25]] + texts[:10] + ["", None, " \t\n", "A b", "a  B", "a\x0bb c"]
    return [(k if k % 17 else None, t) for k, t in enumerate(texts)] + [(3, texts[3])]


def test_fingerprint():
    for _, text in corpus():
        assert fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)
    assert fingerprint(("word " * 200_000).encode()) == slow_fingerprint("word word word")


def test_near_duplicates(spark, docs):
    rows = corpus()
    prints = [slow_fingerprint(t) for _, t in rows]
    want = sorted(zip([i for i, _ in rows], prints, classes(prints, [i for i, _ in rows])), key=repr)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in near_duplicates(docs(rows)).collect()), key=repr)
    assert got == want


def test_keep_one(spark, docs):
    rows = corpus()
    marked = near_duplicates(docs(rows), tie=True).select("root").distinct().count()
    kept = keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    assert kept.count() == marked
    assert keep_one(docs([])).count() == 0 and near_duplicates(docs([])).count() == 0


def _prints(spark, values):
    return spark.createDataFrame([(int(v),) for v in np.array(values, np.uint64).view(np.int64)], "fp long")


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 6])
def test_links_find_every_pair(spark, bits):
    rng = random.Random(bits)
    low = [rng.getrandbits(12) for _ in range(30)]  # most bits equal: correlated, skewed parts
    values = {rng.getrandbits(64) for _ in range(150)} | {(x << 40 | x) for x in low}
    for v in list(values)[:60]:
        for _ in range(4):
            w = v
            for b in rng.sample(range(64), rng.randint(1, 5)):
                w ^= 1 << b
            values.add(w)
    values = sorted(values)
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links(_prints(spark, values), bits).collect()]
    want = {frozenset((x, y)) for k, x in enumerate(values) for y in values[:k] if bin(x ^ y).count("1") <= bits}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_plan(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    n, both = bit_pairs(_prints(spark, values))
    bits = (values[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    assert n == 2000 and (both == bits.T.astype(np.int64) @ bits.astype(np.int64)).all()
    for parts in range(2, 6):
        groups = group_bits(both, n, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        plan = allocate(groups, both, n, 3)
        assert sum(plan.thresholds) == 3 - parts + 1 and min(plan.thresholds) >= -1
    assert plan_probes(_prints(spark, values), 3).cost < np.inf
    # more fingerprints: fewer, longer parts
    assert min((allocate(group_bits(both, n, m), both / n * 1e10, 10**10, 3) for m in range(2, 6)), key=lambda p: p.cost).cost < 1e16


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {
        "path": [(k, k + 1) for k in range(60)],
        "star": [(1000, k) for k in range(80)] + [(2000, 2001)],
        "random": [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(5, 5)],
        "none": [],
    }[shape]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    least = {x: x for e in real for x in e}
    for _ in least:
        for a, b in real:
            least[a] = least[b] = min(least[a], least[b])
    assert got == least
