"""Source divergence against plain Python, odd rows, small blocks and hot groups."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tallycheck.llm.source_divergence import divergence, term_frequencies, term_lists

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, value double, part string, item string, rank string, n string, term string, p string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs, top):
    """``rows``: (text, lang, source)."""
    groups, df = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(lower(text or ""))
        groups[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)
        others = {s: c for (g, s), c in groups.items() if g == lang}
        of_lang = sum((Counter(c) for c in others.values()), Counter())

        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        def apart(a, b):
            return (a - b) ** 2 // (a + b)

        p, q = share(own), share(of_lang)
        pairs = []
        for s, counts in others.items():
            if s != source:
                r = share(counts)
                pairs.append((-sum(apart(p[t], r[t]) for t in kept), s.encode()))
        terms = [(-apart(p[t], q[t]), t.encode()) for t in kept if own[t] > 0 and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows, parts=4):
        full = [(k, text, lang, source, 0.5, *["x"] * 6) for k, (text, lang, source) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


def corpus(seed, n=200):
    rng = random.Random(seed)
    vocab = ["a", "B", "the", "Zoë", "naïve", "straße", "日本", "x1y", "don't", "É", "é", "q_r", "[k]"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocab) + rng.choice(["", ",", "\n", "\t"]) for _ in range(rng.randint(0, 30))]
        # one source has a third of all rows
        source = "hot" if rng.random() < 0.34 else rng.choice(["s1", "s2", "Ünd", "", None])
        rows.append((" ".join(words), rng.choice(["en", "en", "de", None, ""]), source))
    return rows + [(None, "en", "s1"), ("", "fr", "lonely"), ("alone here", "fr", "two"), (None, None, None)] + rows[:20]


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("min_docs, top, block", [(1, 3, 7), (10, 10, 300_000), (5, 2, 50)])
def test_against_brute_force(frame, min_docs, top, block):
    rows = corpus(min_docs)
    assert collected(divergence(frame(rows), min_docs, top, block)) == brute(rows, min_docs, top)


def test_ties_are_ranked_by_item(frame):
    rows = [(f"same words {w}", "en", s) for s in ("b", "a", "c") for w in ("x", "y")] * 6
    got = collected(divergence(frame(rows), 3, 4))
    assert got == brute(rows, 3, 4)
    assert [(r[3], r[5]) for r in got if r[1] == "b" and r[2] == "pair"] == [("a", 1), ("c", 2)]


def test_no_kept_terms(frame):
    rows = [("some text", "en", "a"), ("other things", "en", "b"), (None, "en", "c")]
    got = collected(divergence(frame(rows), 10))
    assert got == brute(rows, 10, 10)
    assert {r[4] for r in got} == {0} and len(got) == 6


def test_empty_table(frame):
    assert collected(divergence(frame([]))) == []


def test_long_text_and_long_term(frame):
    long_text = "alpha beta " * 120_000 + "z" * 1_200_000 + " gamma"
    rows = [(long_text, "en", "a"), ("beta gamma", "en", "b"), ("z" * 1_200_000, "en", "b")]
    assert collected(divergence(frame(rows, 1), 2, 5)) == brute(rows, 2, 5)
    assert sum(map(len, term_lists(long_text.encode()))) == 240_002


def test_runs_of_any_block_give_the_same_frequencies(frame):
    rows = [(t or "", lang or "", s or "") for t, lang, s in corpus(3, 80)]
    whole = sorted(map(tuple, term_frequencies(frame(rows), 2, 1_000_000).collect()))
    assert whole and whole == sorted(map(tuple, term_frequencies(frame(rows), 2, 1).collect()))


def test_many_sources_share_a_term(frame):
    rows = [(f"common word{k % 7}", "en", f"s{k % 60:02}") for k in range(240)]
    assert collected(divergence(frame(rows), 4, 10)) == brute(rows, 4, 10)


def test_query_against_its_sql(spark, tmp_path):
    import duckdb

    from tallycheck.llm.queries import ORACLE_SQL, op13_source_divergence

    rows = [(k, *r) for k, r in enumerate(corpus(8, 150))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.sql(f"select lang, source, part, item, value, rank from ({ORACLE_SQL['op13_source_divergence']})").fetchall())
    assert collected(op13_source_divergence(spark, str(tmp_path))) == want
