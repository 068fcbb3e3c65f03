"""Token ids in ORC, in id order: integer run lengths, row indexes and Bloom filters on document ids.

Documents are ranged by id, each range is sorted, encoded in order and written as one ORC file per
task. A row holds its id, the number of its range, where it starts in that range, its number of ids and
the ids (ORC's run-length coded integers). Row indexes and Bloom filters on ``doc_id`` let readers skip stripes and row groups; stripes
are read in parallel. Starts over all documents come from the ranges' sums, one row each.

Defined results: a null text is empty and has the end id only. Null ids come last. Rows with equal ids are
ordered by a hash of their text; each row of the input gives one row. An empty table gives no rows.
Ranges split rows of one id by that hash, so a frequent id (or null) does not meet in one task unless its rows are
equal in full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import pieces, ranges_for, shared_path, written

FILE_SCHEMA = "doc_id long, range int, at long, n_tokens long, ids array<int>"
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "10000",
    "orc.stripe.size": str(64 << 20),
}


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .piece_encoder import encoder

        encode, number, at = encoder(path).encode, TaskContext.get().partitionId(), 0
        end = int(end_id).to_bytes(4, "little")
        for batch in pieces(batches, 2 << 20):
            coded = [(encode(x) if x else b"") + end for x in batch.column("text").to_pylist()]
            n = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            bounds = np.concatenate([[0], np.cumsum(n)])
            ids = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(coded), number, np.int32)),
                    pa.array(at + bounds[:-1]),
                    pa.array(n),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), ids),
                ],
                names=["doc_id", "range", "at", "n_tokens", "ids"],
            )
            at += int(bounds[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Write ``docs`` (doc_id, text) as ORC files of ids below ``path``. ``tokenizer``: a file of the tokenizers library, present on every executor."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("_tie").asc()]
    tied = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"))
    ranged = tied.repartitionByRange(ranges_for(docs), *order).sortWithinPartitions(*order).select("doc_id", "text")
    coded = ranged.mapInArrow(_encode(tokenizer, end_id), FILE_SCHEMA)
    coded.write.options(**OPTIONS).orc(path)


def _checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        bounds = lists.offsets.to_numpy()
        sums = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        n = np.diff(bounds).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("range"), batch.column("at"), pa.array(n), pa.array(sums, pa.int64())],
            names=["doc_id", "range", "at", "n_tokens", "ids_crc32"],
        )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows: doc_id, range, at, n_tokens, ids."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def range_starts(files: DataFrame) -> DataFrame:
    """(range, start): ids in all ranges before. One row per file."""
    sums = files.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_start"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    files = read_tokens(spark, path)
    rows = files.mapInArrow(_checksum, "doc_id long, range int, at long, n_tokens long, ids_crc32 long")
    starts = written(range_starts(files), "token-ranges")
    return rows.join(starts, "range").select("doc_id", (F.col("range_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def tokenize_to_orc(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a fresh path in the shared folder and return ``token_index`` of it."""
    path = shared_path(docs.sparkSession, "tokens-orc")
    write_tokens(docs, path, tokenizer, end_id)
    return token_index(docs.sparkSession, path)
