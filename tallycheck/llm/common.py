"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A-Z to a-z, and nothing else.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for sessions started without ``--py-files``."""
    if (app := spark.sparkContext.applicationId) in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset a temporary one, in local mode only."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one column ``own``, so that no name added beside it can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"))


def unpacked(df: DataFrame, *added: Column, names: Sequence[str] = ()) -> DataFrame:
    """The columns inside ``own`` but those called ``names``, then ``added``."""
    inner = [f.name for f in df.schema["own"].dataType if f.name not in names]
    return df.select(*[F.col("own").getField(c).alias(c) for c in inner], *added)


def own_schema(df: DataFrame, added: str) -> T.StructType:
    """``own`` of ``df`` followed by the columns that ``added`` declares."""
    return T.StructType([df.schema["own"], *T.StructType.fromDDL(added)])


def own_text(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """The UTF-8 bytes of a column inside ``own``."""
    own = batch.column("own")
    return own.field(own.type.get_field_index(column)).cast(pa.binary()).to_pylist()


def ranges_for(docs: DataFrame, rows: int = 100_000) -> int:
    """Partitions for ``docs``: those set for shuffles, and more where a partition would hold over ``rows`` rows."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // rows))


@contextmanager
def arrow_batches(spark: SparkSession, size: str) -> Iterator[None]:
    """Within it, what is run hands Python batches of ``size`` bytes at most (and the rows of a batch that Spark sets anyway)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``max_bytes``, so a task's working arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges ``first[i] .. first[i]+count[i]-1``: the index i of each element, and the elements."""
    owner = np.repeat(np.arange(len(count)), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, np.repeat(first, count) + within
