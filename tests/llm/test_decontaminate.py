"""Windows against a brute force, odd rows, full bitmaps, and passes over the documents."""

import random
import re

import pytest

from tallycheck.llm.decontaminate import contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(size, len(iw))
            windows = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if iw else set()
            for p in range(len(w) - n + 1) if n else ():
                if tuple(w[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    found.add("" if item_id is None else str(item_id))
        # windows of items with a null id are hits; the items joined leave it out
        out.append((doc_id, len(w), len(hit), ",".join(sorted(found - {""})), bool(hit)))
    return sorted(out, key=repr)


def run(docs, spark, rows, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = contaminated(docs(rows), bench, **kw)
    got = [(r.doc_id, r.n_words, r.n_hit, ",".join(i for i in r["items"] if i is not None), r.contaminated) for r in df.collect()]
    assert all(len(r["items"]) == r.n_items for r in df.collect())
    return sorted(got, key=repr)


def corpus(seed, n_docs=60, n_items=12):
    rng = random.Random(seed)
    vocab = ["a", "B", "cé", "x1", "the", "Ünd"]
    make = lambda lo, hi: " ".join(rng.choice(vocab) + rng.choice(["", ",", "."]) for _ in range(rng.randint(lo, hi)))
    items = [(k, make(0, 9)) for k in range(n_items)] + [(100, None), (None, "the the"), (3, "again another text")]
    docs = [(k, make(0, 60)) for k in range(n_docs)]
    docs += [(k + 1000, f"intro {t} outro") for k, t in items[:n_items]]
    return docs + [(2000, None), (2001, ""), (None, "a b"), (5, docs[5][1])], items


@pytest.mark.parametrize("size", [1, 3, 5])
def test_against_brute_force(spark, docs, size):
    rows, items = corpus(size)
    assert run(docs, spark, rows, items, size=size) == brute(rows, items, size)


def test_full_bitmaps_give_the_same(spark, docs):
    rows, items = corpus(9, n_docs=20, n_items=6)
    assert run(docs, spark, rows, items, size=4, filter_bits=64) == brute(rows, items, 4)


def test_items_of_many_windows(spark, docs):
    rng = random.Random(2)
    item = " ".join(f"w{rng.randint(0, 40)}" for _ in range(300))
    rows = [(k, " ".join(item.split()[k * 7 : k * 7 + 25])) for k in range(40)] + [(99, "w1 w2")]
    items = [(1, item), (2, "w1 w2"), (1, "w3 w4 w5")]
    assert run(docs, spark, rows, items, size=4, filter_bits=128) == brute(rows, items, 4)


def test_empty_tables(spark, docs):
    assert run(docs, spark, [], [(1, "a b")]) == []
    assert run(docs, spark, [(1, "a b")], []) == [(1, 2, 0, "", False)]


def test_long_text(spark, docs):
    passage = " ".join(f"w{k}" for k in range(30))
    text = "filler words here " * 50_000 + passage + " end" * 50_000
    got = run(docs, spark, [(1, text)], [(7, passage)])
    assert got == [(1, 150_000 + 30 + 50_000, 30, "7", True)]


def test_keeps_own_columns(spark, docs):
    bench = spark.createDataFrame([(1, "q")], "item_id long, text string")
    row = contaminated(docs([(1, "q r")]), bench).first()
    assert (row.score, row.kept, row["_items"], row["items"]) == (0.5, "mine", "x", ["1"])


def test_items_with_a_null_id_as_the_sql(spark, tmp_path):
    import duckdb

    from tallycheck.llm.queries import ORACLE_SQL, op1_window_decontamination

    passage = [" ".join(f"{p}{k}" for k in range(14)) for p in "uvw"]
    items = [(None, passage[0]), (None, passage[1]), (3, passage[1]), (20, passage[2]), (None, None), (None, "lone")]
    rows = [(1, f"x {passage[0]} y"), (2, f"{passage[1]} {passage[2]}"), (3, passage[2]), (4, "A Lone word"), (5, "clean"), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, op1_window_decontamination(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert got == sorted(con.sql(ORACLE_SQL["op1_window_decontamination"]).fetchall())
    assert [(r[0], r[2], r[3], r[5]) for r in got] == [(1, 14, 1, True), (2, 28, 3, True), (3, 14, 1, True), (4, 1, 1, True), (5, 0, 0, False), (6, 0, 0, False)]


@pytest.mark.parametrize("size,kw", [(1, {}), (3, {}), (5, {}), (4, {"filter_bits": 64})])
def test_items_with_a_null_id_against_brute_force(spark, docs, size, kw):
    rows, items = corpus(size)
    df = contaminated(docs(rows), spark.createDataFrame(items, "item_id long, text string"), size=size, **kw)
    # null is one item, here 999 in the brute force
    got = [(r.doc_id, r.n_words, r.n_hit, ",".join(sorted(i or "999" for i in r["items"])), r.contaminated, r.n_items) for r in df.collect()]
    want = [(*w, len(w[3].split(",")) if w[3] else 0) for w in brute(rows, [(999 if i is None else i, t) for i, t in items], size)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_passes_do_not_grow_with_the_benchmark(spark, docs, monkeypatch):
    """Counts how often the documents are handed to tasks: as often for 3 items as for 3,000 with 1.5 MB of text."""
    rng = random.Random(4)
    big = [(k, " ".join(f"v{rng.randint(0, 50_000)}" for _ in range(75))) for k in range(3_000)]
    rows = [(k, f"before {big[k * 7][1]} after") for k in range(20)] + [(50, "clean words only")]
    kind = type(docs(rows))
    passes, plain = [], kind.mapInArrow

    def noted(self, func, schema, *args, **kw):
        passes.append("item_id" not in self.columns)
        return plain(self, func, schema, *args, **kw)

    monkeypatch.setattr(kind, "mapInArrow", noted)
    runs = []
    for items in (big[:3], big):
        passes.clear()
        got = contaminated(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
        runs.append(sum(passes))
    assert runs == [4, 4]
    assert {r.doc_id: (r.n_hit, r["items"]) for r in got} == {**{k: (75, [str(k * 7)]) for k in range(20)}, 50: (0, [])}


def test_word_hashes_across_runs(monkeypatch):
    from tallycheck.llm import decontaminate

    texts = [b"one two  three", None, b"", b"..", b"Four five-six " * 20, "é".encode() * 40, b" one"]
    flat, n = decontaminate.word_hashes(texts)
    assert n.tolist() == [len(words((x or b"").decode())) for x in texts]
    monkeypatch.setattr(decontaminate, "_RUN", 7)
    again, m = decontaminate.word_hashes(texts)
    assert (flat == again).all() and (n == m).all() and flat[0] == flat[-1] and len(set(flat.tolist())) == 7
