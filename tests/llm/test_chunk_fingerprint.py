import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycheck.llm.chunk_fingerprint import Ranges, Sizes, as_string, containment, edited_neighbours, fingerprints


def texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice("abc é\n") for _ in range(rng.choice([0, 1, 5, 40, 300, 900]))) for _ in range(n)]


def slow(text):
    """Chunk by chunk, hashing anew at every byte."""
    from tallycheck.llm.chunk_fingerprint import _GEAR, WINDOW

    import xxhash

    sizes, out, at = Sizes(), {}, 0
    bits = int(round(np.log2(sizes.normal)))
    while at < len(text):
        stop = min(at + sizes.most, len(text))
        cut = stop
        for end in range(at + sizes.least, stop):
            h = 0
            for b in text[max(0, end - WINDOW) : end]:
                h = (h << 1) + int(_GEAR[b]) & 0xFFFF
            if h >> 16 - (bits + 1 if end < at + sizes.normal else bits - 1) == 0:
                cut = end
                break
        out[xxhash.xxh32_digest(text[at:cut])] = cut - at
        at = cut
    return out


def test_chunks():
    some = [t.encode() for t in texts(25)]
    assert fingerprints(some) == [slow(t) for t in some]
    assert [fingerprints([t])[0] for t in some] == fingerprints(some)


def test_shift_resistant():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 123, 20_000, dtype=np.uint8).tobytes()
    a, b = fingerprints([body, b"some words put in front " + body])
    assert containment(a, b) > 0.98
    c = fingerprints([rng.integers(97, 123, 20_000, dtype=np.uint8).tobytes()])[0]
    assert containment(a, c) == 0


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = []
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode()
        own, other, new = fingerprints([text.encode(), following.encode(), edited])
        want.append((doc_id, len(text), hashlib.sha256(edited).hexdigest(), as_string(own), as_string(new), containment(own, new), containment(own, other)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 16, 200])
def test_neighbours(spark, docs, ranges):
    rows = [(k * k - 50, t) for k, t in enumerate(texts(90, ranges))] + [(None, None)]
    check(rows, edited_neighbours(docs(rows, parts=4), ranges=ranges).collect())


def test_frequent_ids(spark, docs):
    rows = [(7, t) for t in texts(60)] + [(None, t + "n") for t in texts(60, 1)] + [(k, "x" * k) for k in range(20)]
    got = edited_neighbours(docs(rows), ranges=12).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted((i is None, i or 0, len(t)) for i, t in rows)
    # rows of one id are in the order of their texts' hashes
    tie = {r.text: r.h for r in docs(rows).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie[r[1]]))
    want = []
    for k, (doc_id, text) in enumerate(order):
        half = len(text) // 2
        edited = text[: len(text) - half] + order[(k + 1) % len(order)][1][:half]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)


def test_small(spark, docs):
    assert edited_neighbours(docs([])).count() == 0
    row = edited_neighbours(docs([(1, "abcd")])).first()
    assert (row.near_next, row.edited_sha256) == (1.0, hashlib.sha256(b"abab").hexdigest())
    row = edited_neighbours(docs([(1, "")])).first()
    assert (row.near_edited, row.near_next, row.fingerprint) == (1.0, 1.0, "")


def test_large_ids(spark, docs):
    rows = [((1 << 62) + k, t) for k, t in enumerate(texts(60))] + [(-(1 << 63) + k, t) for k, t in enumerate(texts(20, 2))]
    check(rows, edited_neighbours(docs(rows, parts=4), ranges=9).collect())


def test_ranges_split_a_frequent_key():
    r = Ranges(np.array([0, 5, 5, 9]), np.array([-5, -10, 10, 7]))
    key, tie = np.array([0, 0, 4, 5, 5, 5, 5, 6, 9, 9, 50]), np.array([-5, 1, 1, -11, -10, 3, 10, 0, 6, 7, 7])
    number = r.number(key, tie)
    assert number.tolist() == [0, 0, 0, 0, 1, 1, 2, 2, 2, 3, 3]
    assert r.begins(key, tie, number).tolist() == [0, 4, 6, 9]
