"""From raw documents to token files: quality, near-duplicates, decontamination, mixing, packing.

Each stage works on all rows its predecessor kept; all but the last return the columns of documents. Stages read the other
tables they need (labels, benchmark) from ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallycheck.llm.common import written
from tallycheck.llm.decontaminate import contaminated
from tallycheck.llm.mixing import mixed_rows
from tallycheck.llm.queries import table, tokenizer_file
from tallycheck.llm.rule_quality import keep_good
from tallycheck.llm.simhash import keep_one
from tallycheck.llm.token_orc import tokenize_to_orc


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects (score below 0.7)."""
    return keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by SimHash fingerprints of 3-word shingles at 3 or fewer differing bits."""
    return keep_one(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that have a 10-word window of a benchmark item."""
    marked = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return marked.filter("not contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources come to their target shares of the words."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token ids as ORC and return their index: doc_id, start, n_tokens, ids_crc32."""
    return tokenize_to_orc(docs, tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", tokens),
]

#: The classifier, the fingerprints and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over all of ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{k}")
    return docs
