import os
import random
import zlib

import numpy as np
import pytest
from pyarrow import orc
from pyspark.sql import functions as F

from tallycheck.llm.common import shared_path
from tallycheck.llm.piece_encoder import PieceEncoder
from tallycheck.llm.queries import tokenizer_file
from tallycheck.llm.token_orc import read_tokens, token_index, tokenize_to_orc, write_tokens

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def plain():
    t = tokenizers.Tokenizer.from_file(tokenizer_file())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


ODD = [
    "", " ", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \nb", "a\tb", "don't we'll x's it'S", "<|endoftext|> a", "x. y, z! (w) --q-- 3.14 12a",
    "über Straße naïve", "日本語 テスト", "a b c", "é ‍ x", "½ ² Ⅷ a½.", "'s 't", "%%% a%%% b&&&", "😀 a😀.", "a\x1cb", "\n", "a.\nB", "x'.", "a_b __", "İ.",
]


def test_pieces_give_the_same_ids(plain):
    coder = PieceEncoder(tokenizer_file())
    rng = random.Random(0)
    texts = ODD + ["".join(rng.choice(ODD) + rng.choice([" ", "\n", ""]) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain(text), text


def rows_of():
    rng = random.Random(3)
    rows = [(rng.randint(-100, 10**12), " ".join(rng.choice("word other über 12 x,").strip() for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return rows + [(5_000, t) for t in ODD]


def test_round_trip(spark, docs, plain):
    rows = rows_of() + [(None, "null id"), (None, None)]
    got = {}
    for r in tokenize_to_orc(docs(rows, parts=5), tokenizer_file()).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    at = 0
    for doc_id in sorted(got, key=lambda k: (k is None, k or 0)):
        texts = [t for i, t in rows if i == doc_id]
        want = sorted((len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes())) for ids in map(plain, texts))
        assert sorted(x[1:] for x in got[doc_id]) == want
        for start, n, _ in sorted(got[doc_id]):
            assert start == at
            at += n


def test_files(spark, docs, plain):
    rows = rows_of()
    path = shared_path(spark, "test-orc")
    write_tokens(docs(rows), path, tokenizer_file(), end_id=7)
    files = read_tokens(spark, path)
    own = {r.doc_id: r.ids for r in files.collect()}
    assert all(own[i] == [*plain(t), 7] for i, t in rows[:100])
    # each file holds one range, in order
    for r in files.groupBy(F.input_file_name()).agg(F.countDistinct("range").alias("n")).collect():
        assert r.n == 1
    ordered = [r.doc_id for r in files.orderBy("range", "at").collect()]
    assert ordered == sorted(ordered)
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,5000)]" in files.filter("doc_id = 5000")._jdf.queryExecution().toString()
    assert token_index(spark, path).count() == len(rows)


def test_empty(spark, docs):
    assert tokenize_to_orc(docs([]), tokenizer_file()).count() == 0
    row = tokenize_to_orc(docs([(1, None)]), tokenizer_file()).first()
    assert tuple(row) == (1, 0, 1, zlib.crc32(b"\x02\0\0\0"))


def test_added_tokens_as_the_plain_library(spark, docs):
    t = tokenizers.Tokenizer.from_file(tokenizer_file())
    own = lambda text: t.encode(text, add_special_tokens=False).ids
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y.", "end|> <|endoftext|>\n<|endoftext|", "a |> b", "<|end oftext|>"]
    coder = PieceEncoder(tokenizer_file())
    for text in texts:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == own(text), text
    assert 50256 in own(texts[0])
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenize_to_orc(docs(list(enumerate(texts))), tokenizer_file()).collect()}
    at = 0
    for k, text in enumerate(texts):
        ids = [*own(text), 2]
        assert rows[k] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_files_hold_row_indexes(spark, docs):
    path = shared_path(spark, "test-orc")
    write_tokens(docs([(k * 7, "some words here") for k in range(30_000)], parts=2), path, tokenizer_file())
    folder = path.replace("file:", "")
    files = [os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".orc")]
    strides = {meta.row_index_stride for meta in map(orc.ORCFile, files) if meta.nrows}
    assert strides == {10_000}
    row = read_tokens(spark, path).filter("doc_id = 70007").collect()
    assert [r.doc_id for r in row] == [70_007]


def test_a_worker_forgets_and_still_gives_the_same_ids(plain, monkeypatch):
    from tallycheck.llm import piece_encoder

    monkeypatch.setattr(piece_encoder, "REMEMBERED", 8)
    coder = PieceEncoder(tokenizer_file())
    rng = random.Random(5)
    for _ in range(200):
        text = " ".join(rng.choice(["one", "two,", "three.", "four", "fünf!", "six", "seven", "eight", "nine"]) for _ in range(12))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain(text)
