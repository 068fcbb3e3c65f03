"""Operators give the same rows when the first attempt of every task that reads documents dies midway."""

import pytest
from pyspark import TaskContext

from tallycheck.llm.chunk_fingerprint import edited_neighbours
from tallycheck.llm.decontaminate import contaminated
from tallycheck.llm.queries import tokenizer_file
from tallycheck.llm.simhash import near_duplicates
from tallycheck.llm.suffix_dedup import remove_repeats
from tallycheck.llm.token_orc import tokenize_to_orc


def flaky(df):
    def fail_first(batches):
        first = TaskContext.get().attemptNumber() == 0
        for batch in batches:
            yield batch
            if first:
                raise RuntimeError("simulated executor loss")

    return df.mapInArrow(fail_first, df.schema)


OPERATORS = {
    "decontaminate": lambda spark, df: contaminated(df, spark.createDataFrame([(1, "w3 w4 w5 w6")], "item_id long, text string"), size=3),
    "simhash": lambda spark, df: near_duplicates(df),
    "suffix": lambda spark, df: remove_repeats(df, length=40, gram=12),
    "chunks": lambda spark, df: edited_neighbours(df, ranges=5),
    "tokens": lambda spark, df: tokenize_to_orc(df, tokenizer_file()),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_same_rows(spark, docs, name):
    rows = [(k, " ".join(f"w{(k % 7) + j}" for j in range(30 + k))) for k in range(40)]
    df = docs(rows, parts=4).select("doc_id", "text").persist()
    run = lambda x: sorted(map(repr, OPERATORS[name](spark, x).collect()))
    try:
        assert run(flaky(df)) == run(df)
    finally:
        df.unpersist()
