"""The pipeline against plain Python, stage by stage, and the registered queries against their SQL."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from tallycheck.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file
from tallycheck.llm.rule_quality import score_quality

from .test_decontaminate import brute as brute_windows
from .test_mixing import targets
from .test_simhash import classes, slow_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) == set(QUERIES) and "pipeline" in E.queries()
    assert set(ORACLE_SQL) <= set(E.oracle_sql())
    assert [n.split()[0] for n, _ in C.STAGES] == ["quality", "SimHash", "benchmark", "mixing", "token-ID"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF).select(want.columns)
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline(spark):
    import tokenizers

    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    docs = {r.doc_id: r for r in read("documents").collect()}
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    stages, df = [], read("documents")
    for _, stage in C.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == read("documents").columns
        stages.append(sorted(r.doc_id for r in df.collect()))

    good = sorted(r.doc_id for r in score_quality(read("documents"), read("labels")).filter("predicted = 1").collect())
    assert stages[0] == good
    prints = [slow_fingerprint(docs[k].text) for k in good]
    single = sorted(k for k, c in zip(good, classes(prints, good)) if k == c)
    assert stages[1] == single
    clean = sorted(r[0] for r in brute_windows([(k, docs[k].text) for k in single], items, 10) if not r[-1])
    assert stages[2] == clean

    sizes = {}
    for k in clean:
        sizes[docs[k].source] = sizes.get(docs[k].source, 0) + len((docs[k].text or "").split())
    names = sorted(sizes)
    want = dict(zip(names, targets([sizes[n] for n in names], (5, 2, 1))))
    mixed = []
    for k in clean:
        rate = min(want[docs[k].source] / sizes[docs[k].source], 3)
        digest = hashlib.md5((docs[k].text or "").encode()).hexdigest()
        draw = int(hashlib.md5(f"17:{k}:{digest}".encode()).hexdigest()[:13], 16) / 2**52
        mixed += [k] * (int(rate) + (draw < rate - int(rate)))
    assert stages[3] == mixed

    t = tokenizers.Tokenizer.from_file(tokenizer_file())
    at, rows = 0, []
    for k in mixed:
        ids = [*t.encode(docs[k].text or "", add_special_tokens=False).ids, 2]
        rows.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(rows)


def test_odd_documents_pass(spark, docs, tmp_path):
    rows = [(None, None), (None, "x"), (1, ""), (1, ""), (2, "good words here. " * 30), (2, "good words here. " * 30)]
    made = docs(rows).withColumn("draw", F.lit("own"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    df = made
    for _, stage in C.STAGES[1:-1]:
        df = stage(spark, df, str(tmp_path))
        assert df.columns == made.columns
    empty = made.limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
